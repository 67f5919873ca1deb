"""Named sources: where an export lies and how it is written. Every column is read as text, by the
names in the file's own header, so each cast is made explicitly when the export is staged."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import normalise, records
from ledgerloom.sources.workspace import settle


@dataclass(frozen=True)
class SourceSpec:
    """``preamble`` is the number of banner lines above the header; ``declared`` the encoding the
    provider states, used only if the bytes are not UTF-8. ``line_breaks`` says that quoted fields may hold some, which
    a whole run finds out by itself."""

    name: str
    path: str
    sep: str = ","
    preamble: int = 0
    declared: str = "utf-8"
    line_breaks: bool = False


# How each export is written.
DIALECTS: dict[str, dict] = {
    "payment_engine_log": {},
    "paypal_us_activity": {},
    "paypal_eu_activity": {"sep": ";", "declared": "cp1252"},
    "adyen_payment_accounting": {},
    "dlocal_transactions": {},
    "google_play_earnings": {"preamble": 1},
    "fx_rates": {},
    "fee_schedule": {},
}


def registry(paths: Mapping[str, str]) -> dict[str, SourceSpec]:
    """Name -> path to name -> spec. A name may carry a part suffix after a colon, for a ledger that
    comes in several files: ``google_play_earnings:202606``."""
    return {name: SourceSpec(name, path, **DIALECTS[name.split(":")[0]]) for name, path in paths.items()}


def parse_files(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """Lines (``path, block, at, line``) of the files of one source to columns, stacked by name.

    Records may span lines inside quoted fields. Each file is read by its own header: banner and header are its first
    records by place, and a later line that spells the same is data. Files with the same header are parsed together.
    The heads that differ go through the driver, one line or two each; empty lines are no records.
    """
    lines = records.joined_records(lines.select("path", "block", "at", "line"), spec.sep)
    first = settle(lines.filter("block = 0").groupBy("path").agg(F.min("at").alias("first")), "first_lines")
    many = first.count() > records.MOST_BROADCAST_FILES
    placed = lines.join(first if many else F.broadcast(first), "path")
    is_head = (F.col("block") == 0) & (F.col("at") <= F.col("first") + spec.preamble)
    heads = (placed.filter(is_head).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("head"))
             .select("path", F.get("head.line", F.lit(spec.preamble)).alias("header")))
    found = sorted(r["header"] or "" for r in heads.select("header").distinct().collect())
    if not all(found):
        raise ValueError(f"{spec.name}: a file ends before its header")
    body = placed.filter(~is_head & (F.length("line") > 0)).select("path", "line")
    parsed = None
    for header in found:
        names = next(csv.reader(io.StringIO(header, newline=""), delimiter=spec.sep))
        same = heads.filter(F.col("header") == header).select("path")
        own = body if len(found) == 1 else body.join(same if many else F.broadcast(same), "path", "left_semi")
        schema = ", ".join(f"`{n}` string" for n in names)
        # Two quotes inside a quoted field stand for one.
        options = {"sep": spec.sep, "mode": "FAILFAST", "escape": '"'}
        rows = own.select(F.from_csv("line", schema, options).alias("r")).select("r.*")
        parsed = rows if parsed is None else parsed.unionByName(rows)
    if parsed is None:
        raise ValueError(f"{spec.name}: no file with a header")
    return parsed


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read one UTF-8 export as text columns. Exports of unknown encoding go through
    ``ledgerloom.sources.normalise`` first."""
    if spec.preamble == 0 and not spec.line_breaks:
        reader = spark.read.options(header=True, sep=spec.sep, mode="FAILFAST")
        text = T.StructType([T.StructField(n, T.StringType()) for n in reader.csv(spec.path).columns])
        # the header of every file in a folder is held against the first one's
        return reader.schema(text).option("enforceSchema", False).csv(spec.path)
    lines = normalise.text_lines(spark, [spec.path]).withColumn("line", F.regexp_replace("text", "\r$", ""))
    return parse_files(lines, spec)


def read_parts(spark: SparkSession, specs: Iterable[SourceSpec]) -> DataFrame:
    """Several files that are one ledger, stacked by column name before anything is counted."""
    stacked = None
    for spec in specs:
        part = read_source(spark, spec)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def register_views(spark: SparkSession, specs: Mapping[str, SourceSpec]) -> list[str]:
    """Make every source queryable by its name in Spark SQL."""
    views = []
    for name, spec in specs.items():
        view = name.replace(":", "_")
        read_source(spark, spec).createOrReplaceTempView(view)
        views.append(view)
    return views
