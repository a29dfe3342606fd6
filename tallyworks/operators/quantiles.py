"""Exact quantiles, box statistics, modes and outlier fences."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import lookup_join
from tallyworks.session import materialize

# The sketch holds this many samples per group at most. The brackets that it gives keep
# about 2 / 10,000 of a group's rows per wanted share; their distinct values go to the
# built-in percentile.
SKETCH_ACCURACY = 100_000
# Distance of the bracket ends from the wanted share: ten times the sketch error.
BRACKET_MARGIN = 10 / SKETCH_ACCURACY
# Smaller groups are kept whole: the margin would be only a few rows.
BRACKET_ROWS = 100_000


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(by), list(columns), "column", "value").where("value is not null")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolation quantiles, nulls left out.

    Returns ``by``, ``column``, ``n`` and ``quantiles`` (one value per share).
    """
    if by:
        return _grouped_quantiles(df, columns, probs, by)
    found = [(c, f.n, f.quantiles) for c, f in column_figures(df, columns, probs).items()]
    return df.sparkSession.createDataFrame(found, "column string, n bigint, quantiles array<double>")


@dataclass(frozen=True)
class Figures:
    """What is known of one column: values that are not null, quantiles, and moments if asked for."""

    n: int
    quantiles: list[float]
    mean: float | None = None
    std: float | None = None
    least: float | None = None
    most: float | None = None


def column_figures(df: DataFrame, columns: Sequence[str], probs: Sequence[float], moments: bool = False) -> dict[str, Figures]:
    """Exact quantiles of ungrouped columns as numbers; columns without values are left out.

    Two reads of ``df`` and nothing stored. The first one gives two values around each wanted
    position. In the second one all values are moved into that bracket, which keeps what
    stands at the position and leaves few distinct values to the built-in ``percentile``; counts
    on both sides of the bracket show whether the position lies in it, and a bracket that missed is widened.
    Values keep their type until they are interpolated.
    """
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    known, margin = {}, BRACKET_MARGIN
    asked = list(columns)
    out: dict[str, Figures] = {}
    while asked:
        ends = F.array(*[F.lit(min(max(p + side, 0.0), 1.0)) for p in probs for side in (-margin, margin)])
        first = []
        for c in asked:
            v = F.col(c)
            first.append(F.struct(F.count(v).alias("n"), F.percentile_approx(v, ends, SKETCH_ACCURACY).alias("ends"), *(
                [F.avg(v).alias("mean"), F.stddev(v).alias("std"), F.min(v).cast("double").alias("least"),
                 F.max(v).cast("double").alias("most")] if moments else [])).alias(names[c]))
        row = df.agg(*first).first()
        known = {c: row[names[c]] for c in asked if row[names[c]]["n"]}
        if not known:
            break
        second = []
        for c, k in known.items():
            v, kind = F.col(c), df.schema[c].dataType
            for i, p in enumerate(probs):
                low, high = (F.lit(k["ends"][2 * i + j]).cast(kind) for j in (0, 1))
                held = F.when(v < low, low).when(v > high, high).otherwise(v)
                second.append(F.struct(F.percentile(held, float(p)).alias("q"), F.count_if(v < low).alias("below"),
                                       F.count_if(v <= high).alias("upto")).alias(f"{names[c]}_{i}"))
        row = df.agg(*second).first()
        missed = []
        for c, k in known.items():
            met = [row[f"{names[c]}_{i}"] for i in range(len(probs))]
            places = [(k["n"] - 1) * float(p) for p in probs]
            if margin < 1 and not all(m["below"] <= math.floor(at) and math.ceil(at) < m["upto"] for m, at in zip(met, places)):
                missed.append(c)
                continue
            extra = {m: k[m] for m in ("mean", "std", "least", "most")} if moments else {}
            out[c] = Figures(k["n"], [m["q"] for m in met], **extra)
        asked, margin = missed, min(1.0, margin * 30)
    return {c: out[c] for c in columns if c in out}


def _grouped_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles per group.

    One read of ``df`` sketches all columns at once, a second one counts the values in the
    brackets. Whether each wanted position lies in its bracket is checked by those
    counts; a bracket that missed is widened and the second read repeated.
    """
    keys, margin = [*by, "column"], BRACKET_MARGIN
    while True:
        sketch = materialize(_sketch(df, columns, probs, by, margin), "sketch")
        found = materialize(_from_brackets(_long(df, columns, by), sketch, keys, probs), "quantiles")
        if margin >= 1 or found.where("NOT sure").isEmpty():
            return found.drop("sure")
        margin = min(1.0, margin * 30)


def _sketch(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str],
            margin: float) -> DataFrame:
    """Per group and column: two values around each wanted position with a
    margin far over the sketch's error. One aggregate over wide rows."""
    ends = F.array(*[F.lit(min(max(p + side, 0.0), 1.0)) for p in probs for side in (-margin, margin)])
    parts = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        parts.append(F.struct(
            F.count(v).alias("__n"), F.percentile_approx(v, ends, SKETCH_ACCURACY).alias("__ends")).alias(f"__s{i}"))
    wide = df.groupBy(*by).agg(*parts)
    named = [F.struct(F.lit(c).alias("column"), F.col(f"__s{i}.*")) for i, c in enumerate(columns)]
    return wide.select(*by, F.inline(F.array(*named))).where("__n > 0")


def _from_brackets(values: DataFrame, sketch: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles from counts per distinct value near the wanted positions.

    Values outside the brackets keep their order and count but move to the end
    of the bracket below them, so few distinct values are left.
    """
    ends = sketch.select(*keys, "__n", "__ends")
    lows, highs = ([F.col("__ends")[2 * i + k] for i in range(len(probs))] for k in (0, 1))
    inside: Column = F.col("__n") <= BRACKET_ROWS
    for low, high in zip(lows, highs):
        inside = inside | F.col("value").between(low, high)
    last_end = F.greatest(F.lit(float("-inf")), F.lit(float("-inf")),
                          *[F.when(high < F.col("value"), high) for high in highs])
    counted = lookup_join(values, ends, keys, "inner").select(
        *keys, inside.alias("__in"), F.when(inside, F.col("value")).otherwise(last_end).alias("value")).groupBy(
        *keys, "__in", "value").agg(F.count(F.lit(1)).alias("count"))
    sure = F.lit(True)
    for p, low, high in zip(probs, lows, highs):
        at = (F.max("__n") - 1) * F.lit(float(p))
        below = F.sum(F.when(F.col("value") < low, F.col("count")).otherwise(0))
        upto = F.sum(F.when((F.col("value") < high) | (F.col("__in") & (F.col("value") == high)), F.col("count"))
                     .otherwise(0))
        sure = sure & (below <= F.floor(at)) & (F.ceil(at) < upto)
    return lookup_join(counted, ends, keys, "inner").groupBy(*keys).agg(
        F.sum("count").alias("n"),
        F.percentile("value", F.array(*[F.lit(float(p)) for p in probs]), F.col("count")).alias("quantiles"),
        (sure | (F.max("__n") <= BRACKET_ROWS)).alias("sure"))


def iqr_fences(df: DataFrame, columns: Sequence[str], whis: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and the fences ``whis`` interquartile ranges outside them."""
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    return exact_quantiles(df, columns, [0.25, 0.75], by).select(
        *by, "column", q1.alias("q1"), q3.alias("q3"),
        (q1 - whis * (q3 - q1)).alias("lower"), (q3 + whis * (q3 - q1)).alias("upper"))


def fence_values(df: DataFrame, column: str, whis: float = 1.5) -> tuple[float | None, float | None]:
    """The two fences of one column as numbers (None for an empty column)."""
    return column_fences(df, [column], whis).get(column, (None, None))


def column_fences(df: DataFrame, columns: Sequence[str], whis: float = 1.5) -> dict[str, tuple[float, float]]:
    """Lower and upper fence of each column that has values."""
    return {c: (q1 - whis * (q3 - q1), q3 + whis * (q3 - q1))
            for c, f in column_figures(df, columns, [0.25, 0.75]).items() for q1, q3 in [f.quantiles]}


def box_statistics(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles per group and the last values inside the fences."""
    quartiles = materialize(exact_quantiles(df, [column], [0.25, 0.5, 0.75], [by]).select(
        by, F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3")), "quartiles")
    rows = lookup_join(df.select(by, column).where(F.col(column).isNotNull()), quartiles, [by], "inner")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.groupBy(by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column that has values."""
    rows = [(c, f.n, f.mean, f.std, f.least, f.most, *f.quantiles)
            for c, f in column_figures(df, columns, [0.25, 0.5, 0.75], moments=True).items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, count bigint, mean double, std double, min double, max double, p25 double, p50 double, p75 double")


def mode_of(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "mode") -> DataFrame:
    """Most frequent value (lowest on ties), per group if ``by`` is given.

    Values are counted first, so a group is never held as a list of values.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("__count"))
    best = F.min(F.struct(-F.col("__count"), F.col(column).alias("value")))["value"]
    return counts.groupBy(*by).agg(best.alias(name))


def outlier_counts(df: DataFrame, columns: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Rows above and below the fences, per column that has values."""
    fences = column_fences(df, columns, whis)
    if not fences:
        return df.sparkSession.createDataFrame([], "column string, above bigint, below bigint")
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c) > F.lit(upper)).alias("above"),
                       F.count_if(F.col(c) < F.lit(lower)).alias("below")).alias(f"c{i}")
              for i, (c, (lower, upper)) in enumerate(fences.items())]
    return df.agg(*counts).select(F.inline(F.array(*[f"c{i}" for i in range(len(fences))])))


def drop_outliers(df: DataFrame, columns: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Keep rows inside the fences, one column after the other: each column's
    fences come from what the columns before it left. Null rows go too; ``removed_counts``
    says how many rows went for their value."""
    for column in columns:
        lower, upper = fence_values(df, column, whis)
        df = df.where(F.col(column).between(F.lit(lower), F.lit(upper)))
    return df


def removed_counts(df: DataFrame, columns: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Rows that each pass of ``drop_outliers`` removes as outliers; rows that go for a
    null are not counted."""
    rows = []
    for column in columns:
        lower, upper = fence_values(df, column, whis)
        inside = F.col(column).between(F.lit(lower), F.lit(upper))
        rows.append((column, df.agg(F.count_if(~inside).alias("n")).first()["n"]))
        df = df.where(inside)
    return df.sparkSession.createDataFrame(rows, "column string, removed bigint")


def beyond_fence(df: DataFrame, column: str, order: Sequence[Column | str], n: int = 5,
                 whis: float = 1.5) -> DataFrame:
    """First ``n`` rows above the upper and below the lower fence."""
    lower, upper = fence_values(df, column, whis)
    above = df.where(F.col(column) > F.lit(upper)).orderBy(*order).limit(n).withColumn("side", F.lit("above"))
    below = df.where(F.col(column) < F.lit(lower)).orderBy(*order).limit(n).withColumn("side", F.lit("below"))
    return above.unionByName(below)
