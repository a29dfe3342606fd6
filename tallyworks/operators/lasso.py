"""L1 regression for many strengths and folds from one read of the rows.

A squared-error fit needs only the moments of the columns, so one pass sums them up per
fold: tasks send a small matrix each, whatever their number of rows. The
training part of a fold is the sum of the others; coordinate descent on its moments gives
the coefficients of every strength, and the fold's own moments their squared error.

The fit is that of Spark's linear regression with standardised columns: half the mean squared
error plus ``strength`` times the sum of |coefficient| times the column's population deviation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Number of rows, sums, and sums of products of shifted columns (the label is the last one)."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products, self.shift)

    def means(self) -> np.ndarray:
        return self.sums / self.n

    def covariance(self) -> np.ndarray:
        m = self.means()
        return self.products / self.n - np.outer(m, m)


@dataclass
class Line:
    strength: float
    coefficients: np.ndarray
    intercept: float


def fold_moments(df: DataFrame, columns: Sequence[str], label: str, fold: Column, folds: int) -> list[Moments]:
    """Moments per fold, rows with a null left out. One read; the values of one row shift the columns, for precision."""
    names = [*columns, label]
    rows = df.select(fold.cast("int").alias("fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]).dropna()
    p = len(names)
    first = rows.first()
    shift = np.array([first[f"c{i}"] for i in range(p)]) if first else np.zeros(p)

    def summed(batches):
        total = np.zeros((folds, p + 1, p + 1))
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *[batch.column(f"c{i}").to_numpy() - shift[i] for i in range(p)]])
            of = batch.column("fold").to_numpy()
            for f in range(folds):
                some = x[of == f]
                total[f] += some.T @ some
        at = [k.ravel().astype(np.int32) for k in np.indices(total.shape)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, at), pa.array(total.ravel())], ["fold", "i", "j", "v"])
    found = rows.mapInArrow(summed, "fold int, i int, j int, v double").groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((folds, p + 1, p + 1))
    for r in found.collect():
        total[r["fold"], r["i"], r["j"]] = r["v"]
    return [Moments(t[0, 0], t[0, 1:], t[1:, 1:], shift) for t in total]


def fit_path(moments: Moments, strengths: Sequence[float], tolerance: float = 1e-12) -> list[Line]:
    """The line of each strength, in the order given; strong ones are fitted first and start the weaker ones."""
    p = len(moments.sums) - 1
    lines: dict[float, Line] = {}
    if moments.n < 2:
        return [Line(s, np.zeros(p), float(moments.shift[-1])) for s in strengths]
    cov, mean = moments.covariance(), moments.means() + moments.shift
    deviation = np.sqrt(np.maximum(np.diag(cov)[:p], 0))
    used = np.flatnonzero(deviation > 1e-12 * np.maximum(1, np.abs(mean[:p])))
    scale = deviation[used]
    gram, target = cov[np.ix_(used, used)] / np.outer(scale, scale), cov[used, p] / scale
    v = np.zeros(len(used))
    for strength in sorted(set(strengths), reverse=True):
        for _ in range(100_000):
            moved = 0.0
            for j in range(len(used)):
                pull = target[j] - gram[j] @ v + gram[j, j] * v[j]
                new = np.sign(pull) * max(abs(pull) - strength, 0.0) / gram[j, j]
                moved = max(moved, abs(new - v[j]))
                v[j] = new
            if moved <= tolerance * max(1.0, np.abs(v).max(initial=0.0)):
                break
        coefficients = np.zeros(p)
        coefficients[used] = v / scale
        lines[strength] = Line(strength, coefficients, float(mean[p] - coefficients @ mean[:p]))
    return [lines[s] for s in strengths]


def squared_error(moments: Moments, line: Line) -> float:
    """Mean squared error of a line on the rows of these moments."""
    w = np.append(-line.coefficients, 1.0)
    rest = line.intercept - moments.shift[-1] + line.coefficients @ moments.shift[:-1]
    return float((w @ moments.products @ w - 2 * rest * (w @ moments.sums)) / moments.n + rest * rest)


@dataclass
class Search:
    """``errors`` by strength: mean over the folds; ``best``: the line of the best strength on all rows."""

    errors: dict[float, float]
    best: Line

    def predicted(self, df: DataFrame, columns: Sequence[str], name: str = "prediction") -> DataFrame:
        total = F.lit(self.best.intercept)
        for c, w in zip(columns, self.best.coefficients):
            if w:
                total = total + F.col(c) * F.lit(float(w))
        return df.withColumn(name, total)


def search(df: DataFrame, columns: Sequence[str], label: str, strengths: Sequence[float], folds: int = 3) -> Search:
    """Strength with the smallest error over folds dealt by the rows' hash; equal rows share a fold."""
    fold = F.pmod(F.xxhash64(*columns, label), F.lit(folds))
    parts = fold_moments(df, columns, label, fold, folds)
    errors = dict.fromkeys(strengths, 0.0)
    for k, own in enumerate(parts):
        if not own.n:
            continue
        others = [m for i, m in enumerate(parts) if i != k]
        for line in fit_path(sum(others[1:], others[0]), strengths):
            errors[line.strength] += squared_error(own, line) / folds
    best = min(strengths, key=lambda s: (errors[s], s))
    return Search(errors, fit_path(sum(parts[1:], parts[0]), [best])[0])
