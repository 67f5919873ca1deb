"""Whitening of embeddings: directions of largest variance, scaled so that each has variance one.

Vectors are brought to whole numbers, so means and deviations are exact sums. Each task takes its centred rows block by
block into one triangular factor (QR), and the factors of the tasks, ``d x d`` numbers each, are joined in rounds of
``JOINED`` until one is left: it has the rows' covariance in it without any product of them being formed. What the
driver solves (``bidiagonal``) has the size of one factor, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bidiagonal import right_directions
from ledgerloom.sources.workspace import settle

SCALE = 256
COMPONENTS = 4
# Rows of a block, and factors that one task joins.
BLOCK_ROWS = 4096
JOINED = 64


@dataclass(frozen=True)
class Whitening:
    """``n`` different vectors, their sums, and for each component the variance and, in rows, the direction."""

    n: int
    sums: tuple[int, ...]
    total: float
    variances: np.ndarray
    directions: np.ndarray

    @property
    def known(self) -> np.ndarray:
        """Which components have a variance that is told from rounding; the others can't be brought to one."""
        return self.variances > np.finfo(float).eps * max(self.total, 0.0) * max(len(self.sums), 1)


def whole(vector: Column) -> Column:
    """The vector in steps of ``1 / SCALE``, or null if it is null or has an entry that is null or not finite."""
    exact = vector.cast("array<double>")
    odd = F.exists(exact, lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True)))
    return F.when(~odd, F.transform(exact, lambda c: F.floor(c * SCALE).cast("long")))


def vectors(rows: DataFrame, vector: str = "embedding", label: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``x`` of the rows that can be used; ``x`` has the length most of them have, of equals the greater.

    Rows of another length go like those without a vector. The lengths are a few rows.
    """
    found = settle(rows.select(F.col(f"`{label}`").cast("long").alias("vec_id"), whole(F.col(f"`{vector}`")).alias("x"))
                   .where("x is not null"), "vectors")
    size = found.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return found.where(F.size("x") == (size.d if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    """How many vectors, and the sum of each place, as whole numbers."""
    each = (fit.select(F.posexplode("x").alias("at", "value")).groupBy("at")
            .agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("sum"), F.count("*").alias("n")).collect())
    each = sorted(each)
    return (each[0].n if each else 0), tuple(int(row["sum"]) for row in each)


def _factor(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The triangular factor of all centred rows."""
    d = len(mean)
    schema = pa.schema([("part", pa.int64()), ("r", pa.list_(pa.float64()))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                rows = _matrix(batch.column(0).slice(start, BLOCK_ROWS)).astype(float) - mean
                r = np.linalg.qr(np.vstack([r, rows]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([r.ravel()], schema.field(1).type)], schema=schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for one in batch.column(1):
                r = np.linalg.qr(np.vstack([r, one.values.to_numpy().reshape(-1, d)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([r.ravel()], schema.field(1).type)], schema=schema)

    factors = settle(fit.select("x").mapInArrow(blocks, "part long, r array<double>"), "factors")
    while (count := factors.count()) > 1:
        factors = settle(factors.repartition(-(-count // JOINED)).mapInArrow(joined, "part long, r array<double>"), "factors")
    last = factors.first()
    return np.array(last.r).reshape(-1, d) if last else np.zeros((0, d))


def fit_whitening(xs: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learned from each different ``x`` of ``xs`` once; copies merge in the tasks before they are shuffled."""
    fit = settle(xs.select("x").distinct(), "fit_list")
    n, sums = _sums(fit)
    if not n:
        return Whitening(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    r = _factor(fit, np.array([s / n for s in sums]))
    squares, directions = right_directions(r, components)
    return Whitening(n, sums, float((r ** 2).sum()) / n, squares / n, directions)


def whiten(xs: DataFrame, by: Whitening) -> DataFrame:
    """``xs`` with ``deviation``, its exact squared distance from the mean times ``n`` squared, and ``whitened``.

    ``whitened`` has a number for each component, null where its variance is zero. A distance beyond 63 bits fails.
    """
    if not by.n:
        return xs.select("*", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    n, sums, names = by.n, by.sums, xs.columns
    mean = np.array([s / n for s in sums])
    known = by.known
    matrix = np.where(known[:, None], by.directions / np.sqrt(np.where(known, by.variances, 1.0))[:, None], 0.0)
    at = names.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, object)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = _matrix(part.column(at))
                # Whole numbers of any size, unless the largest that can come up fits.
                far = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0)
                wide = far * far * len(sums) >= 1 << 63
                off = n * (x.astype(object) if wide else x) - (exact if wide else np.array(sums, np.int64))
                projected = (x.astype(float) - mean) @ matrix.T
                rows = [[v if k else None for v, k in zip(row, known, strict=True)] for row in projected.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([int(v) for v in (off * off).sum(axis=1)], pa.int64()), pa.array(rows, pa.list_(pa.float64()))],
                    names=[*names, "deviation", "whitened"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in xs.schema)
    return xs.mapInArrow(run, f"{fields}, deviation long, whitened array<double>")


def identity_error(xs: DataFrame, by: Whitening) -> float:
    """The largest entry, without sign, of the whitened fit list's covariance less the identity."""
    places = [k for k, told in enumerate(by.known) if told]
    if not places:
        return 0.0
    fit = whiten(xs.select("x").distinct(), by)
    pairs = [(a, b) for a in places for b in places if a <= b]
    row = fit.agg(*[F.covar_pop(F.get("whitened", F.lit(a)), F.get("whitened", F.lit(b))) for a, b in pairs]).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(row, pairs, strict=True))


def whitened(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", label: str = "vec_id") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that can be used.

    Rows whose vector is null, has an entry that is null or not finite, or has another length than most are left out.
    Copies count once for the fit and are each returned; a null id is an id like others; equal variances have any
    directions that are orthogonal; a component without variance is returned with a null ``whitened``, and there are no
    more components than places. An empty table, or vectors without entries, give no rows. Other columns are not read,
    and texts of any length in them don't matter.
    """
    xs = vectors(rows, vector, label)
    by = fit_whitening(xs, components)
    error = identity_error(xs, by)
    explained = F.array(*[F.lit(float(v) / by.total if by.total else 0.0) for v in by.variances]).cast("array<double>")
    return (whiten(xs, by).select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
            .select("vec_id", (F.col("_at") + 1).alias("component"), F.lit(by.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(explained, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error")))
