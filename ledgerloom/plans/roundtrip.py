"""Derived exports written the way providers write them, and read back through the source layer."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import RunConfig
from ledgerloom.operators import staging
from ledgerloom.plans import exports
from ledgerloom.plans.derived import EXPORT_DAYS, Derived
from ledgerloom.plans.reconcile import Run, reconcile
from ledgerloom.sources import normalise, registry, sinks
from ledgerloom.sources.workspace import fresh_path, settle, write_table

BANNER = "Earnings report (merchant account: play_main). All dates and times are in America/Los_Angeles."

# The month that the run over written files reports.
MONTH = date(1997, 6, 1)


def _write_csv(df: DataFrame, label: str, **options) -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.options(header=True, **options).csv(path)
    return path


def _with_header(header: str):
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [header]})
        yield from batches

    return lines


def quoted_file(x: Derived) -> DataFrame:
    """Notes with line breaks, empty lines and doubled quotes inside their quotes, beside quotes that mean themselves."""
    key = F.col("o_orderkey").cast("string")
    long = F.concat(F.lit("\"order "), key, F.lit("\n\nsaid \"\""), F.col("o_orderpriority"), F.lit("\"\", twice\n\""))
    note = F.when(F.col("o_orderkey") % 3 == 0, long).when(F.col("o_orderkey") % 3 == 1, F.lit('12" disk')).otherwise(F.lit(""))
    lines = x.table("orders").select(F.concat_ws(",", key, note, F.col("o_orderstatus")).alias("value"))
    path = fresh_path(x.spark, "quoted")
    lines.mapInPandas(_with_header("order_id,note,status"), "value string").write.text(path)
    return registry.read_source(x.spark, registry.SourceSpec("notes", path, line_breaks=True)).select(
        F.col("order_id"), F.replace(F.col("note"), F.lit("\n"), F.lit("|")).alias("note"), F.col("status"))


QUOTED_CHECK = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE o_orderkey % 3 WHEN 0 THEN 'order ' || o_orderkey || '||said \"' "
    "|| o_orderpriority || '\", twice|' WHEN 1 THEN '12\" disk' END AS note, o_orderstatus AS status FROM orders")


def _read(x: Derived, name: str, path: str) -> DataFrame:
    return registry.read_source(x.spark, registry.registry({name: path})[name])


def adyen_file(x: Derived) -> DataFrame:
    read = _read(x, "adyen_payment_accounting", _write_csv(x.adyen_raw, "adyen"))
    return read.select(
        F.col("`Merchant Reference`").alias("order_ref"), F.col("`Record Type`").alias("record_type"),
        F.col("`Creation Date`").alias("created"), F.col("`Gross Credit`").alias("credit"),
        F.col("Commission").alias("commission"))


def paypal_eu_file(x: Derived) -> DataFrame:
    account = x.paypal_raw.filter("account = 'paypal_eu'").drop("account")
    read = _read(x, "paypal_eu_activity", _write_csv(account, "paypal_eu", sep=";"))
    return read.select(F.col("`Transaction ID`").alias("psp_reference"), F.col("Date").alias("day"),
                       F.col("Gross").alias("gross"), F.col("Fee").alias("fee"))


def _with_banner(header: str):
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [BANNER, header + "\r"]})
        yield from batches

    return lines


def _write_google(df: DataFrame, label: str) -> str:
    """Files that open with a banner ended by a bare newline while every other line ends in CR LF."""
    lines = df.select(F.concat(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns])), F.lit("\r")).alias("value"))
    path = fresh_path(df.sparkSession, label)
    lines.mapInPandas(_with_banner(",".join(df.columns)), "value string").write.text(path)
    return path


def google_file(x: Derived) -> DataFrame:
    read = _read(x, "google_play_earnings", _write_google(x.google_play_raw.drop("part"), "google"))
    return read.select(
        F.col("`Transaction Date`").alias("day"), F.col("`Transaction Time`").alias("clock"),
        F.col("`Transaction Type`").alias("entry"), F.col("`Product ID`").alias("sku"),
        F.col("`Amount (Buyer Currency)`").alias("amount"))


def google_parts(x: Derived) -> DataFrame:
    """Two files that are one ledger: a fee row may lie in the other file than its charge's month."""
    paths = {
        f"google_play_earnings:{part}": _write_google(
            x.google_play_raw.filter(F.col("part") == part).drop("part"), f"google_{part}")
        for part in ("early", "late")}
    return staging.google_play(registry.read_parts(x.spark, registry.registry(paths).values()), x.config)


def paypal_accounts(x: Derived) -> DataFrame:
    exports = {}
    for account, sep in (("paypal_us", ","), ("paypal_eu", ";")):
        rows = x.paypal_raw.filter(F.col("account") == account).drop("account")
        exports[account] = _read(x, f"{account}_activity", _write_csv(rows, account, sep=sep))
    return staging.paypal(staging.tag_accounts(exports), *x.window)


# The exports that a run registers, each as it is written: its rows in SQL, and the same rows in its provider's dialect.
_REGISTERED: dict[str, tuple[str, Callable[[Derived], str]]] = {
    "payment_engine_log": ("payment_log_raw", lambda x: _write_csv(x.payment_log_raw, "payment_log")),
    "paypal_us_activity": ("(SELECT * EXCLUDE (account) FROM paypal_raw WHERE account = 'paypal_us')",
                           lambda x: _write_csv(_account(x, "paypal_us"), "paypal_us")),
    "paypal_eu_activity": ("(SELECT * EXCLUDE (account) FROM paypal_raw WHERE account = 'paypal_eu')",
                           lambda x: _write_csv(_account(x, "paypal_eu"), "paypal_eu", sep=";")),
    "adyen_payment_accounting": ("adyen_raw", lambda x: _write_csv(x.adyen_raw, "adyen")),
    "dlocal_transactions": ("dlocal_raw", lambda x: _write_csv(x.dlocal_raw, "dlocal")),
    "google_play_earnings": ("(SELECT * EXCLUDE (part) FROM google_play_raw)",
                             lambda x: _write_google(x.google_play_raw.drop("part"), "google")),
    "fx_rates": ("fx_rates_raw", lambda x: _write_csv(x.fx_rates_raw, "fx_rates")),
    "fee_schedule": (f"(SELECT * FROM (VALUES {', '.join(map(str, exports.CONTRACT_ROWS))}) AS c({', '.join(exports.CONTRACT_COLUMNS)}))",
                     lambda x: _write_csv(x.contracts_raw, "fee_schedule")),
}


def _account(x: Derived, account: str) -> DataFrame:
    return x.paypal_raw.filter(F.col("account") == account).drop("account")


def registered_views(x: Derived) -> DataFrame:
    """Every column of every registered view: rows of the view, filled cells, their bytes and range."""
    views = registry.register_views(x.spark, registry.registry({name: write(x) for name, (_, write) in _REGISTERED.items()}))
    told = None
    for view in views:
        read = x.spark.table(view)
        counted = read.agg(F.count("*").alias("n"), *[F.struct(
            F.count(F.col(f"`{c}`")).alias("filled"), F.sum(F.octet_length(F.col(f"`{c}`"))).alias("bytes"),
            F.min(F.col(f"`{c}`")).alias("least"), F.max(F.col(f"`{c}`")).alias("most")).alias(f"_{k}")
            for k, c in enumerate(read.columns)])
        cells = F.array(*[F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"_{k}.{part}") for part in ("filled", "bytes", "least", "most")]) for k, c in enumerate(read.columns)])
        rows = counted.select(F.lit(view).alias("source"), F.col("n").alias("n_rows"), F.explode(cells).alias("c")).select(
            "source", "n_rows", "c.*")
        told = rows if told is None else told.unionByName(rows)
    return told


# An empty cell of a file is null.
REGISTERED_CHECK = " UNION ALL ".join(
    f"SELECT '{name}' AS source, (SELECT count(*) FROM {rows}) AS n_rows, column_name, count(v) AS filled, "
    "sum(strlen(v)) AS bytes, min(v) AS least, max(v) AS most FROM (SELECT column_name, nullif(v, '') AS v FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) "
    f"FROM {rows}) UNPIVOT INCLUDE NULLS (v FOR column_name IN (COLUMNS(*)))) GROUP BY column_name"
    for name, (rows, _) in _REGISTERED.items())


# Names with accents; in one export they come decomposed (letter + combining mark).
_NAMES = ("Jürgen", "José", "Zoë", "Ana")
_DECOMPOSED = tuple(unicodedata.normalize("NFD", n) for n in _NAMES)


def _lines(x: Derived, names: tuple[str, ...]) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return x.table("orders").select(F.concat_ws(
        ";", F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")), name, "o_orderpriority").alias("value"))


def _encoded(df: DataFrame, label: str, encoding: str) -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.options(header=False, quote="", sep="\u0001", encoding=encoding).csv(path)
    return path


def _folders(x: Derived) -> dict[str, tuple[str, str]]:
    crlf = fresh_path(x.spark, "crlf")
    _lines(x, _DECOMPOSED).write.option("lineSep", "\r\n").text(crlf)
    return {
        "western": (_encoded(_lines(x, _NAMES), "western", "ISO-8859-1"), "cp1252"),
        "wide": (_encoded(_lines(x, _NAMES), "wide", "UTF-16"), "utf-8"),
        "crlf": (crlf, "cp1252")}


def _normalised(x: Derived, folders: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    files = settle(normalise.fingerprints(x.spark, folders), "fingerprints")
    return files, normalise.normalised_lines(x.spark, files)


def normalised_names(x: Derived) -> DataFrame:
    return _normalised(x, _folders(x))[1]


_CHECK_LINE = ("'ORD-' || o_orderkey || ';' || ['Jürgen', 'José', 'Zoë', 'Ana'][o_orderkey % 4 + 1] || ';' "
               "|| o_orderpriority")
NORMALISED_CHECK = (f"SELECT source, {_CHECK_LINE} AS line FROM orders, "
                    "(SELECT unnest(['western', 'wide', 'crlf']) AS source)")


# Files of a source whose content is known row by row, so that DuckDB can hash them too.
FILES = 15


def _whole_files(x: Derived, names: tuple[str, ...], label: str, **how) -> str:
    path = fresh_path(x.spark, label)
    rows = _lines(x, names).withColumn("key", F.regexp_extract("value", "^ORD-([0-9]+)", 1).cast("long"))
    rows = (rows.withColumn("file", F.col("key") % FILES).repartition("file").sortWithinPartitions("file", "key").drop("key"))
    kind = "text" if "lineSep" in how else "csv"
    rows.write.partitionBy("file").options(**how).format(kind).save(path)
    return path


def manifest_by_file(x: Derived) -> DataFrame:
    plain = {"header": False, "quote": "", "sep": "\u0001"}
    files = settle(normalise.fingerprints(x.spark, {
        "western": (_whole_files(x, _NAMES, "western", encoding="ISO-8859-1", **plain), "cp1252"),
        "wide": (_whole_files(x, _NAMES, "wide", encoding="UTF-16", **plain), "utf-8"),
        "crlf": (_whole_files(x, _DECOMPOSED, "crlf", lineSep="\r\n"), "cp1252")}), "fingerprints")
    lines = settle(normalise.normalised_lines(x.spark, files), "lines")
    return normalise.manifest(files, lines).select(
        "source", F.regexp_extract("path", "file=([0-9]+)/", 1).alias("file"), "declared", "encoding_used", "nfc_changed",
        "crlf_stripped", "lines", "bytes_out", "sha256_out", (F.col("dst") == lines.inputFiles()[0].rsplit("/", 1)[0]).alias("stored"),
        # DuckDB has no encoder for the other two encodings.
        F.when(F.col("source") == "crlf", F.col("sha256_in")).alias("sha256_in"))


_DECOMPOSED_LINE = _CHECK_LINE
for _composed, _apart in zip(_NAMES, _DECOMPOSED, strict=True):
    _DECOMPOSED_LINE = _DECOMPOSED_LINE.replace(f"'{_composed}'", f"'{_apart}'")
MANIFEST_CHECK = (
    f"SELECT source, CAST(o_orderkey % {FILES} AS VARCHAR) AS file, declared, encoding_used, "
    "bool_or(source = 'crlf' AND o_orderkey % 4 <> 3) AS nfc_changed, count(*) FILTER (source = 'crlf') AS crlf_stripped, "
    f"count(*) AS lines, sum(strlen({_CHECK_LINE}) + 1) AS bytes_out, "
    f"sha256(string_agg({_CHECK_LINE} || chr(10), '' ORDER BY o_orderkey)) AS sha256_out, true AS stored, "
    f"sha256(string_agg({_DECOMPOSED_LINE} || chr(13) || chr(10), '' ORDER BY o_orderkey) FILTER (source = 'crlf')) AS sha256_in "
    "FROM orders, (VALUES ('western', 'cp1252', 'cp1252'), ('wide', 'utf-8', 'utf-16'), ('crlf', 'cp1252', 'utf-8')) "
    "v(source, declared, encoding_used) GROUP BY ALL")


def gate(x: Derived) -> DataFrame:
    """What would stop a run: a source without a file, a file that does not decode as declared."""
    good = _encoded(_lines(x, _NAMES), "western", "ISO-8859-1")
    files, lines = _normalised(x, {"western": (good, "cp1252"), "mislabelled": (good, "utf-8")})
    faults = normalise.input_faults(files, ["western", "mislabelled", "absent"]).select("source", "fault").distinct()
    read = lines.groupBy("source").agg(F.count("*").alias("n_lines"))
    return faults.join(read, "source", "full_outer").select(
        "source", F.coalesce("fault", F.lit("none")).alias("fault"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


GATE_CHECK = ("SELECT 'western' AS source, 'none' AS fault, count(*) AS n_lines FROM orders "
              "UNION ALL SELECT 'mislabelled', 'undecodable', 0 UNION ALL SELECT 'absent', 'missing', 0")


def stored_summary(x: Derived) -> DataFrame:
    return write_table(x.summary, fresh_path(x.spark, "summary"), ("reporting_month",))


def exported_waterfall(x: Derived) -> DataFrame:
    path = sinks.export_csv(x.waterfall, fresh_path(x.spark, "exports"), "recon_waterfall", sinks.waterfall_order())
    return x.spark.read.option("header", True).csv(path)


def month_run(x: Derived) -> Run:
    """The product as a user runs it: every export written as its provider writes it, then one month reconciled."""
    google = x.google_play_raw
    paypal = x.paypal_raw.filter(F.col("export_month") == str(MONTH)).drop("export_month")
    paths = {
        "payment_engine_log": _write_csv(x.payment_log_raw, "payment_log"),
        "adyen_payment_accounting": _write_csv(x.adyen_raw, "adyen"),
        "dlocal_transactions": _write_csv(x.dlocal_raw, "dlocal"),
        "fx_rates": _write_csv(x.fx_rates_raw, "fx_rates"),
        "fee_schedule": _write_csv(x.contracts_raw, "fee_schedule"),
        "paypal_us_activity": _write_csv(paypal.filter("account = 'paypal_us'").drop("account"), "paypal_us"),
        "paypal_eu_activity": _write_csv(paypal.filter("account = 'paypal_eu'").drop("account"), "paypal_eu", sep=";")}
    for part in ("early", "late"):
        own = google.filter(F.col("part") == part).drop("part")
        paths[f"google_play_earnings:{part}"] = _write_google(own, f"google_{part}")
    return reconcile(x.spark, paths, RunConfig(
        reporting_month=MONTH, export_window=(MONTH, MONTH + timedelta(days=EXPORT_DAYS)),
        google_play_account=exports.GOOGLE_ACCOUNT, output_dir=fresh_path(x.spark, "month_run")))
