"""Text columns of provider exports to typed values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.config import MONEY


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def money(text: Column) -> Column:
    """A decimal written with either a point or a comma. An unreadable value fails the run."""
    return F.replace(text, F.lit(","), F.lit(".")).cast(MONEY)


def vocabulary(verb: Column, words: Mapping[str, str]) -> Column:
    """Provider verb to our word; a verb not listed becomes null and is caught by the checks."""
    mapped = F.lit(None).cast("string")
    for theirs, ours in words.items():
        mapped = F.when(verb == theirs, F.lit(ours)).otherwise(mapped)
    return mapped


def composite_key(captured_at: Column, sku: Column, country: Column) -> Column:
    """Second of capture, product and country. Null as soon as one part is, so it matches nothing."""
    # the text of a zone-less time; date_format would take it through the session time zone
    written = captured_at.cast("string")
    second = F.concat(F.substring(written, 1, 10), F.lit("T"), F.substring(written, 12, 8))
    return F.concat(second, F.lit("|"), sku, F.lit("|"), country)
