"""Quality rules: fixed bounds, then robust multivariate outliers.

Each text gives a vector of transformed statistics. For each language and source the minimum-covariance-determinant
estimate of centre and spread is found by concentration steps from two deterministic starts; documents far from it
by Mahalanobis distance are rejected. All documents enter the estimates. A step is two groupings over narrow rows
that combine in each task, so a source with a third of all rows is a few partial sums, never a group in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import utf8
from ledgerloom.sources.workspace import settle

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # words in repeated windows, percent
# The share of documents the estimate rests on, and the concentration steps from each start.
CORE = 0.75
STEPS = 4
# Strata with fewer documents are pooled by language; what is still fewer is measured by the whole table.
LEAST_DOCUMENTS = 200
WHOLE_TABLE = "all"
# Spread that no estimate falls below, in the features' own units: a stratum whose core never has a symbol
# doesn't make one symbol an outlier.
FLOORS = (0.5, 0.08, 0.6, 0.12, 0.12)
# Quantiles of chi-square at five degrees of freedom: the median, and 1 - 1e-6.
CHI_MEDIAN = 4.3515
CHI_CUT = 35.888
# Quantiles are read from histograms of this many bins a unit.
BINS = 256
# Strata are looked up by broadcast up to this many (under 1 kB each), by shuffle beyond.
BROADCAST_STRATA = 20_000

_CONTINUATION = bytes(range(0x80, 0xC0))
_DIMENSIONS = len(FLOORS)
_PAIRS = [(a, b) for a in range(_DIMENSIONS) for b in range(a, _DIMENSIONS)]
_STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_KEYS = ["start", "stratum"]


def statistics(text: bytes) -> tuple[int, ...]:
    """The statistics of one text, in the order of the columns; words are split at ASCII white space."""
    words = text.split()
    word_chars = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = repeated_lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            repeated_lines += line in seen
            seen.add(line)
    return len(words), word_chars, symbols, lines, repeated_lines, _repeated_words(words)


def _repeated_words(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    repeated = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= repeated
    return int(covered.sum())


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the statistics of every row; a null text has no words."""
    names = ["doc_id", "lang", "source", *_STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t) for t in utf8(batch.column(3))], np.int64).reshape(-1, len(_STATS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, found.T.copy())], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"),
                       "text").mapInArrow(
        run, "doc_id long, lang string, source string, " + ", ".join(f"{s} long" for s in _STATS))


def _features() -> Column:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return F.array(F.log1p("n_words"), F.log1p(F.col("word_chars") / words),
                   F.log1p(100 * F.col("n_symbols") / words),
                   F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_repeat_words") / words)


def _with_strata(rows: DataFrame) -> DataFrame:
    """``stratum``: language and source, the language where they have too few documents, else ``WHOLE_TABLE``."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    own = F.col("n") >= LEAST_DOCUMENTS
    pooled = F.sum(F.when(~own, F.col("n"))).over(Window.partitionBy("lang"))
    sizes = sizes.withColumn("level", F.when(own, 2).when(pooled >= LEAST_DOCUMENTS, 1).otherwise(0))
    quoted = F.to_json(F.struct("lang", "source"))
    stratum = (F.when(F.col("level") == 2, quoted).when(F.col("level") == 1, F.to_json(F.struct("lang")))
               .otherwise(F.lit(WHOLE_TABLE)))
    sizes = settle(sizes.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                                stratum.alias("stratum")), "strata")
    if sizes.count() <= BROADCAST_STRATA:
        sizes = F.broadcast(sizes)
    return rows.join(sizes, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
                     ).drop("_lang", "_source")


def _estimated_from(strata: DataFrame) -> DataFrame:
    """The rows each stratum's estimate rests on: its own, and for ``WHOLE_TABLE`` every row of the table."""
    rows, left_over = strata.select("stratum", "features"), F.col("stratum") == WHOLE_TABLE
    if strata.where(left_over).isEmpty():
        return rows
    return rows.where(~left_over).unionByName(rows.withColumn("stratum", F.lit(WHOLE_TABLE)))


def _quantile(rows: DataFrame, keys: list[str], value: Column, share: float) -> DataFrame:
    """For each key the upper edge of the histogram bin that reaches the share; exact to a bin, in any order."""
    bins = rows.groupBy(*keys, F.floor(value * BINS).alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*keys)
    below = F.sum("n").over(whole.orderBy("bin"))
    return (bins.withColumn("below", below).withColumn("n", F.sum("n").over(whole)).where(F.col("below") >= share * F.col("n"))
            .groupBy(*keys).agg(((F.min("bin") + 1) / BINS).alias("quantile")))


def _medians(rows: DataFrame) -> DataFrame:
    """``centre`` and ``scale``: the median of each feature and 1.4826 times the median distance from it."""

    def by_stratum(values: DataFrame, name: str) -> DataFrame:
        found = _quantile(values, ["stratum", "k"], F.col("value"), 0.5)
        return found.groupBy("stratum").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "quantile"))),
                                                        lambda x: x["quantile"]).alias(name))

    each = rows.select("stratum", F.posexplode("features").alias("k", "value"))
    centre = _small(by_stratum(each, "centre"))
    away = each.join(centre, "stratum").select("stratum", "k", F.abs(F.col("value") - F.get("centre", "k")).alias("value"))
    scale = by_stratum(away, "scale")
    floors = F.array(*map(F.lit, FLOORS))
    return centre.join(scale, "stratum").select(
        "stratum", "centre", F.zip_with("scale", floors, lambda s, f: F.greatest(1.4826 * s, f)).alias("scale"))


def _small(strata: DataFrame) -> DataFrame:
    strata = settle(strata, "estimates")
    return F.broadcast(strata) if strata.count() <= BROADCAST_STRATA else strata


def _moments(rows: DataFrame, vector: str) -> DataFrame:
    x = [F.get(vector, F.lit(k)) for k in range(_DIMENSIONS)]
    return rows.groupBy(*_KEYS).agg(F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("sums"),
                                    F.array(*[F.sum(x[a] * x[b]) for a, b in _PAIRS]).alias("products"))


def _inverse(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, flattened inverse covariance and log determinant, no feature's spread below its floor."""
    centre = sums / n
    covariance = np.zeros((_DIMENSIONS, _DIMENSIONS))
    for (a, b), value in zip(_PAIRS, products, strict=True):
        covariance[a, b] = covariance[b, a] = value / n - centre[a] * centre[b]
    covariance += np.diag(np.maximum(np.square(FLOORS) - np.diag(covariance), 0) + 1e-9)
    return centre, np.linalg.inv(covariance).ravel(), float(np.linalg.slogdet(covariance)[1])


def _estimates(moments: DataFrame) -> DataFrame:
    """Centre, inverse covariance and log determinant of each start and stratum; one small matrix a row."""

    @F.pandas_udf("centre array<double>, inverse array<double>, logdet double")
    def estimate(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_inverse(*row) for row in zip(n, sums, products, strict=True)],
                            columns=["centre", "inverse", "logdet"])

    return _small(moments.withColumn("found", estimate("n", "sums", "products")).select(*_KEYS, "found.*"))


def _distance() -> Column:
    away = [F.get("features", F.lit(k)) - F.get("centre", F.lit(k)) for k in range(_DIMENSIONS)]
    total = F.lit(0.0)
    for a, b in _PAIRS:
        total = total + (1.0 if a == b else 2.0) * F.get("inverse", F.lit(a * _DIMENSIONS + b)) * away[a] * away[b]
    return F.greatest(total, F.lit(1e-9))


def minimum_covariance_determinant(rows: DataFrame) -> DataFrame:
    """For each ``stratum`` of ``rows(stratum, features)``: centre, inverse covariance and the factor ``chi``.

    Distances times ``chi`` have the median of chi-square. Both starts order documents by distance from the
    medians: one by scaled axes, one by the covariance of spatial signs. Each then takes its core share of nearest
    documents, estimates anew and repeats; the smaller determinant wins.
    """
    medians = _small(_medians(rows))
    scaled = rows.join(medians, "stratum")
    unit = F.zip_with(F.zip_with("features", "centre", lambda x, c: x - c), "scale", lambda x, s: x / s)
    norm = F.sqrt(F.aggregate("unit", F.lit(0.0), lambda total, x: total + x * x))
    signs = (scaled.select("stratum", "scale", unit.alias("unit")).withColumn("norm", F.greatest(norm, F.lit(1e-6)))
             .select("stratum", F.lit(1).alias("start"), F.zip_with(
                 F.transform("unit", lambda x: x / F.col("norm")), "scale", lambda x, s: x * s * _DIMENSIONS ** 0.5)
                     .alias("sign")))
    by_signs = (_estimates(_moments(signs, "sign")).drop("centre").join(medians.select("stratum", "centre"), "stratum")
                .select(*_KEYS, "centre", "inverse"))
    axes = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_DIMENSIONS - 1)), lambda a: F.transform(
        "scale", lambda s, b: F.when(a == b, 1 / (s * s)).otherwise(0.0))))
    by_axes = medians.select(F.lit(0).alias("start"), "stratum", "centre", axes.alias("inverse"))
    estimates = _small(by_axes.unionByName(by_signs))
    for _ in range(STEPS):
        away = rows.join(estimates, "stratum").select(*_KEYS, "features", F.log(_distance()).alias("far"))
        cut = _small(_quantile(away, _KEYS, F.col("far"), CORE))
        estimates = _estimates(_moments(away.join(cut, _KEYS).where("far <= quantile"), "features"))
    away = rows.join(estimates, "stratum").select(*_KEYS, F.log(_distance()).alias("far"))
    median = _quantile(away, _KEYS, F.col("far"), 0.5)
    # The smallest determinant after scaling; a stratum whose core is a point keeps its floors.
    chosen = (estimates.join(median, _KEYS).withColumn("chi", F.least(CHI_MEDIAN / F.exp("quantile"), F.lit(1.0)))
              .groupBy("stratum").agg(F.min_by(F.struct("centre", "inverse", "chi"), F.struct("logdet", "start")).alias("best")))
    return _small(chosen.select("stratum", "best.*"))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``distance`` (in chi-square units) and ``kept`` of every row.

    The fixed rules reject texts of under 50 words and those with over half their words in repeated 3-word windows;
    only the others enter the estimates. A null text has no words and is rejected; null languages and sources are
    strata like others. Strata that are too small are pooled by language, and those still too small are measured by
    the estimate over all documents that pass the fixed rules, however few; so each of these has a ``distance``, and
    only rejected rows have none. Repeated rows count and are judged each; other columns are not read.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    stats = settle(measured(docs).withColumn("base_failed", failed), "statistics")
    passed = stats.where(~F.col("base_failed")).withColumn("features", _features())
    strata = settle(_with_strata(passed), "features")
    best = minimum_covariance_determinant(_estimated_from(strata))
    far = strata.join(best, "stratum", "left").withColumn("distance", _distance() * F.col("chi"))
    names = ["doc_id", "lang", "source", *_STATS, "base_failed"]
    verdict = far.select(*names, "distance", (F.col("distance") <= CHI_CUT).alias("kept"))
    rejected = stats.where("base_failed").select(*names, F.lit(None).cast("double").alias("distance"),
                                                 F.lit(False).alias("kept"))
    return verdict.unionByName(rejected)
