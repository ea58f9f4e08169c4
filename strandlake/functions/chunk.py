"""Action chunks: arrays of steps, each an array of values; forms in which a chunk is sent.

``held`` names the dimensions (grippers) that don't move with the rest.  All
but ``resampled`` are array expressions; a null chunk stays null, an empty one
empty.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def thinned(chunk: Column, step: int = 5) -> Column:
    """Every ``step``-th step, and the last."""
    return F.filter(chunk, lambda x, i: (i % step == 0) | (i == F.size(chunk) - 1))


def _held(row: Column, of: Column, held: Sequence[int]) -> Column:
    """``row`` with the held dimensions of another step."""
    return F.transform(row, lambda x, d: F.when(d.isin(list(held)), F.get(of, d)).otherwise(x))


def moved_then_held(chunk: Column, held: Sequence[int]) -> Column:
    """All steps with the first one's held values, then the last step with the held values of each later step."""
    first, last = F.get(chunk, F.lit(0)), F.get(chunk, F.size(chunk) - 1)
    moved = F.transform(chunk, lambda x: _held(x, first, held))
    return F.concat(moved, F.transform(F.slice(chunk, 2, F.greatest(F.lit(0), F.size(chunk) - 1)), lambda x: _held(last, x, held)))


def interleaved(chunk: Column, held: Sequence[int]) -> Column:
    """Each step twice: with the held values of the step before, then with its own."""
    return F.flatten(F.transform(chunk, lambda x, i: F.array(_held(x, F.get(chunk, F.greatest(F.lit(0), i - 1)), held), x)))


def blended_head(chunk: Column, start: Column, steps: int, held: Sequence[int]) -> Column:
    """The first ``steps`` come from ``start`` by a smoothstep; held values change at its middle.

    Nothing changes without a start, or with one of another width.
    """
    n = F.least(F.lit(steps), F.size(chunk))

    def mixed(row: Column, i: Column) -> Column:
        u = F.when(n > 1, i / (n - 1)).otherwise(F.lit(1.0))
        weight = 3 * u * u - 2 * u * u * u

        def value(x: Column, d: Column) -> Column:
            s = F.get(start, d)
            return F.when(d.isin(list(held)), F.when(weight >= 0.5, x).otherwise(s)).otherwise((1 - weight) * s + weight * x)

        return F.when(i < n, F.transform(row, value)).otherwise(row)

    fits = start.isNotNull() & (F.size(start) == F.size(F.get(chunk, F.lit(0))))
    return F.when(fits, F.transform(chunk, mixed)).otherwise(chunk)


def _pchip_slopes(y: np.ndarray) -> np.ndarray:
    """Harmonic means of the differences beside a step, 0 at a turn; limited three-point slopes at the ends."""
    d = np.diff(y, axis=0)
    m = np.zeros_like(y)
    if len(d) == 1:
        return m + d[0]
    a, b = d[:-1], d[1:]
    same = a * b > 0
    m[1:-1] = np.where(same, 2 * a * b / np.where(same, a + b, 1), 0)
    for at, near, far in ((0, d[0], d[1]), (-1, d[-1], d[-2])):
        s = (3 * near - far) / 2
        s = np.where((near * far < 0) & (np.abs(s) > 3 * np.abs(near)), 3 * near, s)
        m[at] = np.where(s * near <= 0, 0, s)
    return m


def _natural_slopes(y: np.ndarray) -> np.ndarray:
    """Slopes of the twice smooth cubic without curvature at its ends: a tridiagonal system, forward and back."""
    n = len(y)
    rhs = 3 * np.vstack([y[1:2] - y[:1], y[2:] - y[:-2], y[-1:] - y[-2:-1]])
    diagonal = np.full(n, 4.0)
    diagonal[[0, -1]] = 2
    for i in range(1, n):
        diagonal[i] -= 1 / diagonal[i - 1]
        rhs[i] -= rhs[i - 1] / diagonal[i - 1]
    m = rhs / diagonal[:, None]
    for i in range(n - 2, -1, -1):
        m[i] -= m[i + 1] / diagonal[i]
    return m


def curve(y: np.ndarray, points: int, kind: str) -> np.ndarray:
    """``points`` values from the first step to the last, of a ``linear``, ``pchip`` or ``natural`` curve through the steps."""
    if kind not in ("linear", "pchip", "natural"):
        raise ValueError(f"unknown curve {kind!r}")
    if len(y) <= 1 or points == 0:
        return np.repeat(y, points, axis=0)
    u = np.linspace(0.0, 1.0, points) * (len(y) - 1)
    i = np.minimum(u.astype(int), len(y) - 2)
    t = (u - i)[:, None]
    a, b = y[i], y[i + 1]
    if kind == "linear":
        return a + (b - a) * t
    m = _pchip_slopes(y) if kind == "pchip" else _natural_slopes(y)
    return a * (1 + 2 * t) * (1 - t) ** 2 + m[i] * t * (1 - t) ** 2 + b * t * t * (3 - 2 * t) + m[i + 1] * t * t * (t - 1)


def resampled(chunk: Column, scale: float, kind: str = "pchip") -> Column:
    """``scale`` times as many steps (rounded down), along a curve through the given ones; a chunk of one step repeats it."""
    if kind not in ("linear", "pchip", "natural"):
        raise ValueError(f"unknown curve {kind!r}")

    @F.pandas_udf("array<array<double>>")
    def run(chunks: pd.Series) -> pd.Series:
        out = []
        for c in chunks:
            y = None if c is None else np.array([np.asarray(r, float) for r in c], float)
            out.append(None if y is None else [] if not len(y) else curve(y, int(scale * len(y)), kind).tolist())
        return pd.Series(out, dtype=object)

    return run(chunk)
