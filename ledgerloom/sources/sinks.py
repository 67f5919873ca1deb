"""Report files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def summary_order() -> list[Column]:
    return [F.col("reporting_month"), F.col("psp"), F.col("recon_scope"), F.desc("abs_usd"), F.col("recon_cause")]


def waterfall_order() -> list[Column]:
    return [F.col("reporting_month"), F.col("psp"), F.col("line_seq")]


def export_csv(report: DataFrame, folder: str, name: str, order: list[Column], period: date | None = None) -> str:
    """One ordered file with a header; a report is a few lines per provider and period, never data.

    The period, where there is one, is part of the name: ``recon_summary_2026-06.csv``. The file is written as the only
    part of a folder beside it and takes its name when the job has succeeded; what had the name before is replaced.
    """
    stamp = f"_{period:%Y-%m}" if period else ""
    path = f"{folder.rstrip('/')}/{name}{stamp}.csv"
    parts = f"{path}.parts"
    report.orderBy(*order).coalesce(1).write.mode("overwrite").options(header=True, sep=",").csv(parts)
    _take_only_part(report.sparkSession, parts, path)
    return path


def _take_only_part(spark: SparkSession, parts: str, path: str) -> None:
    """Rename the one part of ``parts`` to ``path`` in whichever file system they are in."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    folder, target = jvm_path(parts), jvm_path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    written = [status.getPath() for status in files.listStatus(folder) if status.getPath().getName().startswith("part-")]
    if len(written) != 1:
        raise OSError(f"{parts} has {len(written)} parts instead of one")
    if files.exists(target):
        files.delete(target, True)
    if not files.rename(written[0], target):
        raise OSError(f"{parts} could not be renamed to {path}")
    files.delete(folder, True)
