"""Singular values and right singular vectors of a small triangular matrix, by quotient-difference recurrences.

The matrix is brought to bidiagonal form by Householder reflections. The differential qd recurrence with shifts (dqds)
then finds all singular values to high relative accuracy, since it only adds, multiplies and divides positive numbers
and a shift that is too large shows as a negative one and is taken back. A twisted factorisation, stationary from the
top and progressive from the bottom and joined where they agree best, gives the vector of each value without solving a
system.
"""

from __future__ import annotations

import numpy as np

_EPS = float(np.finfo(float).eps)
# Neighbours nearer than this, relative to the larger, are made orthogonal to each other.
NEAR = 1e-3
MOST_SWEEPS = 200


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and ``p`` with ``r = u b p^T``, u and p orthogonal."""
    a, d = np.array(r, float), r.shape[1]
    p = np.eye(d)
    for k in range(d):
        v = _reflection(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            v = _reflection(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            p[:, k + 1:] -= 2 * np.outer(p[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _reflection(x: np.ndarray) -> np.ndarray:
    """The unit vector whose reflection turns ``x`` to the first axis; zero if it stands there."""
    v = x.copy()
    size = np.linalg.norm(v)
    if size == 0 or not v[1:].any():
        return np.zeros_like(v)
    v[0] += size if v[0] >= 0 else -size
    return v / np.linalg.norm(v)


def _shifted(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One dqds sweep, the least remainder met, and whether that is the last one.

    A remainder below zero says that the shift was too large; if only the last one is, it says by how much.
    """
    n = len(q)
    new_q, new_e, d = [0.0] * n, [0.0] * (n - 1), q[0] - shift
    for k in range(n - 1):
        new_q[k] = d + e[k]
        if d < 0 or new_q[k] <= 0:
            return q, e, min(d, -shift), False
        ratio = q[k + 1] / new_q[k]
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
    new_q[-1] = d
    return new_q, new_e, d, True


def _corner(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows: near the smallest of all, and never below it."""
    one, two, side = q[-2] + (e[-2] if len(q) > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = abs(one - two) / 2
    return min(one, two) - (side / (half + float(np.sqrt(half * half + side))) if side else 0.0)


def singular_squares(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squares of a bidiagonal matrix's singular values, largest first, each to high relative accuracy."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        if q[0] < q[-1]:
            # Values are found from the end, smallest first; read from the other side the matrix has the same values.
            q, e = q[::-1], e[::-1]
        for _ in range(MOST_SWEEPS * len(q)):
            split = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= _EPS * _EPS * (sigma + min(q[k], q[k + 1]))), None)
            if len(q) == 1:
                break
            if split is not None:
                todo.append((q[:split + 1], e[:split], sigma))
                q, e = q[split + 1:], e[split + 1:]
                continue
            shift = max(0.0, _corner(q, e) * (1 - 2 * _EPS))
            while True:
                new_q, new_e, least, late = _shifted(q, e, shift)
                if least >= 0 or shift == 0:
                    break
                shift = max(0.0, (shift + least) * (1 - 2 * _EPS)) if late else shift / 4
                shift = shift if shift > _EPS * _EPS * sigma else 0.0
            q, e, sigma = new_q, new_e, sigma + shift
        else:
            raise ArithmeticError("the singular values don't converge")
        found.append(sigma + q[0])
    return np.sort(np.array(found))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, square: float) -> tuple[np.ndarray, float]:
    """The unit vector of ``b^T b`` for an eigenvalue near ``square``, and by how much that is to be mended."""
    d, n = diagonal ** 2, len(diagonal)
    low = above / diagonal[:-1]
    tiny = _EPS * _EPS * max(float(d.max()), square, np.finfo(float).tiny / _EPS ** 3)
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -square
    for k in range(n - 1):
        pivot = s[k] + d[k] or tiny
        down[k] = d[k] * low[k] / pivot
        s[k + 1] = down[k] * low[k] * s[k] - square
    p[-1] = d[-1] - square
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] ** 2 + p[k + 1] or tiny
        up[k] = low[k] * d[k] / pivot
        p[k] = p[k + 1] * d[k] / pivot - square
    gamma = s + p + square
    twist = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    size = float(z @ z)
    return z / np.sqrt(size), float(gamma[twist]) / size


def _block(diagonal: np.ndarray, above: np.ndarray, wanted: int) -> list[tuple[float, np.ndarray]]:
    """The largest ``wanted`` squares and vectors of a bidiagonal matrix without a zero."""
    squares, out = singular_squares(diagonal, above), []
    normal = np.diag(diagonal) + np.diag(above, 1)
    normal = normal.T @ normal
    for k, square in enumerate(squares[:wanted]):
        value, best = float(square), (float("inf"), np.zeros(len(diagonal)))
        near = [z for (_, z), other in zip(out, squares, strict=False) if other - square <= NEAR * other]
        for _ in range(4):
            z, mend = twisted(diagonal, above, value)
            z = _orthogonal(z, near)
            error = float(np.linalg.norm(normal @ z - (z @ normal @ z) * z)) if z.any() else float("inf")
            if error < best[0]:
                best = (error, z)
            if abs(mend) <= _EPS * value:
                break
            value += mend if abs(mend) < NEAR * square else 0.0
        if near and best[0] > 1e3 * _EPS * squares[0]:
            best = min(best, _by_iteration(normal, float(square), near, k), key=lambda x: x[0])
        out.append((float(square), best[1]))
    return out


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    before = np.linalg.norm(z)
    for _ in range(2):
        for other in others:
            z = z - (other @ z) * other
    size = np.linalg.norm(z)
    return z / size if size > 1e-6 * before else np.zeros_like(z)


def _by_iteration(normal: np.ndarray, square: float, near: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """Inverse iteration kept orthogonal to the vectors of near values, for those twisted factors can't tell apart."""
    z = _orthogonal(np.random.default_rng(seed).standard_normal(len(normal)), near)
    shifted = normal - square * (1 + 4 * _EPS) * np.eye(len(normal))
    for _ in range(4):
        z = _orthogonal(np.linalg.lstsq(shifted, z, rcond=_EPS / 8)[0], near)
    return float(np.linalg.norm(normal @ z - (z @ normal @ z) * z)), z


def right_directions(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` squared singular values of ``r`` and, in rows, their right singular vectors.

    ``r`` has no more rows than columns.
    """
    square = np.zeros((r.shape[1], r.shape[1]))
    square[:len(r)] = r
    diagonal, above, p = bidiagonal(square)
    size = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(above).max(initial=0)))
    if size == 0:
        return np.zeros(min(wanted, len(diagonal))), p.T[:wanted]
    # A zero on the diagonal would divide by zero; far below rounding it changes no value that is told from zero.
    diagonal = np.where(np.abs(diagonal) < 1e-20 * size, 1e-20 * size, diagonal)
    cuts = [0, *(np.flatnonzero(np.abs(above) <= 1e-20 * size) + 1), len(diagonal)]
    found = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        for square, z in _block(diagonal[a:b], above[a:b - 1], wanted):
            found.append((square, p[:, a:b] @ z))
    found = sorted(found, key=lambda x: -x[0])[:wanted]
    return np.array([f[0] for f in found]), np.array([f[1] / (np.linalg.norm(f[1]) or 1.0) for f in found])
