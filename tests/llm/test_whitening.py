import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import bidiagonal, whitening
from ledgerloom.llm.queries import op13_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=4):
    """Whole numbers by hand, the rest by the library's own eigenvalues."""
    usable = {}
    for k, (_, v) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            usable[k] = [math.floor(256 * float(np.float32(c))) for c in v]
    fit = np.array(sorted(set(map(tuple, usable.values()))), float)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for k, x in usable.items():
        deviation = sum(int(Fraction(n * a - int(s))) ** 2 for a, s in zip(x, sums, strict=True))
        for c in range(min(components, len(sums))):
            out[(rows[k][0], c + 1)] = (n, deviation, (np.array(x) - sums / n) @ vectors[:, c] / np.sqrt(values[c]), values[c] / values.sum())
    return out


def check(found, expected):
    rows = found.collect()
    assert {(r.vec_id, r.component) for r in rows} == set(expected) and len(rows) == len(expected)
    signs = {}
    for r in rows:
        n, deviation, whitened, explained = expected[(r.vec_id, r.component)]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        if abs(whitened) > 1e-6:
            assert signs.setdefault(r.component, np.sign(r.whitened * whitened)) == np.sign(r.whitened * whitened)
        assert abs(r.whitened) == pytest.approx(abs(whitened), rel=1e-7, abs=1e-9)
        assert 0 <= r.identity_error < 1e-9


def vectors_of(n=300, d=12, seed=5):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, d)) * np.linspace(1, 3, d) @ np.linalg.qr(rng.standard_normal((d, d)))[0]
    return [(k, [float(x) for x in row]) for k, row in enumerate(mixed)]


def test_against_eigenvalues(spark):
    rows = vectors_of()
    rows += [(1000 + k, rows[k % 3][1]) for k in range(400)]  # copies count once
    rows += [(2000, None), (2001, [float("nan")] * 12), (2002, [None] * 12), (2003, [float("inf")] + [0.0] * 11), (2004, [0.0])]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(7))
    check(found, brute([r for r in rows if r[0] != 2004]))


def test_more_factors_than_one_task_joins(spark):
    rows = vectors_of(400, 5)
    check(whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(90)), brute(rows))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(op13_embedding_whitening(spark, folder), brute(rows))


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (None, [1.0, 2.0], "b"), (2, [1.0, 4.0], None)], SCHEMA + ", x string")
    rows = whitening.whitened(df).orderBy("vec_id", "component").collect()
    # All variance lies in the second place; the other component has none to be brought to one.
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in rows] == [
        (None, 1, 2, 512 ** 2), (None, 2, 2, 512 ** 2), (1, 1, 2, 512 ** 2), (1, 2, 2, 512 ** 2), (2, 1, 2, 512 ** 2), (2, 2, 2, 512 ** 2)]
    assert [abs(r.whitened) if r.whitened is not None else None for r in rows] == [1.0, None] * 3
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0


MATRICES = {
    "plain": lambda r: r.standard_normal((80, 20)),
    "graded": lambda r: r.standard_normal((80, 20)) * np.logspace(0, -7, 20),
    "equal columns": lambda r: (a := r.standard_normal((80, 8)))[:, [0, 1, 2, 3, 3, 4, 5, 6]],
    "zero column": lambda r: r.standard_normal((80, 6)) * np.array([1, 0, 1, 1, 1, 1]),
    "equal values": lambda r: np.linalg.qr(r.standard_normal((80, 10)))[0],
    "near values": lambda r: np.linalg.qr(r.standard_normal((60, 12)))[0] * np.array([3, 3 * (1 - 1e-9), 3 * (1 - 1e-5), 2] + [0.5] * 8),
    "few rows": lambda r: r.standard_normal((3, 8)),
    "one": lambda r: r.standard_normal((9, 1)),
}


@pytest.mark.parametrize("name", sorted(MATRICES))
def test_solver(name):
    a = MATRICES[name](np.random.default_rng(8))
    squares, rows = bidiagonal.right_directions(np.linalg.qr(a, mode="r"), a.shape[1])
    expected = np.linalg.svd(a, compute_uv=False) ** 2
    assert squares[:len(expected)] == pytest.approx(expected, abs=1e-13 * expected[0])
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-9
    for square, v in zip(squares, rows, strict=True):
        assert np.linalg.norm(a.T @ (a @ v) - square * v) < 1e-11 * expected[0]


def test_small_values_are_relatively_accurate():
    # A bidiagonal matrix whose values span twenty decades: products of its rows would lose the small ones.
    diagonal = np.logspace(0, -20, 12)
    above = diagonal[:-1] * 0.5
    found = bidiagonal.singular_squares(diagonal, above)
    assert np.prod(found / np.sort(diagonal ** 2)[::-1]) == pytest.approx(1.0, rel=1e-10)  # the determinant
