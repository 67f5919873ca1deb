"""Payments reconciliation as Spark DataFrame jobs."""

from ledgerloom.config import RunConfig

__all__ = ["RunConfig"]
