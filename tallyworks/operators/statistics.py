"""Grouped counts and sums, shares, histograms and densities."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.cells import int_or_zero, pair_or_zero, price_band
from tallyworks.operators.joins import lookup_join
from tallyworks.operators.ordering import running_total
from tallyworks.session import materialize


def sum_by_category(df: DataFrame, category: str, amount: str) -> DataFrame:
    """Sum of a text amount by category; text that is not a number adds 0."""
    return df.groupBy(category).agg(F.sum(int_or_zero(F.col(amount).cast("string"))).alias("sales"))


def sum_by_price_band(df: DataFrame, price: str, amount: str) -> DataFrame:
    """Sum by price band in one pass; a row that does not parse has price 0."""
    pair = pair_or_zero(F.col(price).cast("string"), F.col(amount).cast("string"))
    return (df.select(pair.alias("pair"))
            .select(price_band(F.col("pair.price")).alias("price_band"), F.col("pair.count").alias("count"))
            .where("price_band is not null")
            .groupBy("price_band").agg(F.sum("count").alias("sales")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def sum_through_lookup(facts: DataFrame, key: str, amount: Column, lookup: DataFrame,
                       label: str, name: str) -> DataFrame:
    """Sum of facts by a label of their key. Facts are summed per key before
    the join, so a hot key is one row by the time it meets the lookup."""
    per_key = facts.groupBy(key).agg(F.sum(amount).alias("__sum"))
    return per_key.join(lookup.select(key, label), key).groupBy(label).agg(F.sum("__sum").alias(name))


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq of text columns; lowest value on ties."""
    counts = (df.select(*columns).unpivot([], list(columns), "column", "value").where("value is not null")
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct(-F.col("n"), "value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        best["value"].alias("top"), F.max("n").alias("freq"))


def _per_column(df: DataFrame, columns: Sequence[str], measure, name: str) -> DataFrame:
    wide = df.agg(*[measure(F.col(c)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", name)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, columns or df.columns, lambda c: F.count_if(c.isNull()), "nulls")


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, columns or df.columns,
                       lambda c: F.avg(c.isNull().cast("int")) * 100, "null_percent")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form; a row counts for the pairs it has both of."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    entries = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r"))
               for i, (x, y) in enumerate(pairs) for a, b in ((x, y), (y, x))]
    entries += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns]
    return row.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str, bins: int, limits: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width bins; the last one includes the maximum. Empty bins are left out."""
    c = F.col(column).cast("double")
    if limits is None:
        row = df.agg(F.min(c).alias("low"), F.max(c).alias("high")).first()
        limits = (row["low"], row["high"])
    if limits[0] is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("count")).where(F.lit(False))
    low, high = limits
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((c - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.where(c.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def histograms(df: DataFrame, bins: Mapping[str, int]) -> DataFrame:
    """``histogram`` of several columns: one read for all limits, one for all bins."""
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{k}") for c in bins
                    for k, f in (("low", F.min), ("high", F.max))]).first()
    entries = []
    for c, n in bins.items():
        low, high = wide[f"{c}_low"], wide[f"{c}_high"]
        if low is not None:
            width = (high - low) / n or 1.0
            v = F.col(c).cast("double")
            entries.append(F.struct(F.lit(c).alias("column"), F.least(
                F.floor((v - F.lit(low)) / F.lit(width)), F.lit(n - 1)).cast("int").alias("bin")))
    if not entries:
        return df.select(F.lit("").alias("column"), F.lit(0).alias("bin"),
                         F.lit(0).cast("bigint").alias("count")).where(F.lit(False))
    return df.select(F.inline(F.array(*entries))).where("bin IS NOT NULL").groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("count"))


def densities(df: DataFrame, column: str, groups: Mapping, grid: int = 50, bins: int = 200) -> DataFrame:
    """Gaussian density of each group on an even grid, from histogram bin centres.

    ``groups`` maps a name to the condition of its rows; no row meets two of them.
    Bandwidth is the standard deviation times n to the power -1/5. One read finds
    all limits and moments, one counts all bins; each of the few bins then generates
    its own grid points.
    """
    c = F.col(column).cast("double")
    own = {g: F.when(cond, c) for g, cond in groups.items()}
    row = df.agg(*[f(v).alias(f"{k}{i}") for i, v in enumerate(own.values())
                   for k, f in (("low", F.min), ("high", F.max), ("sd", F.stddev), ("n", F.count))]).first()
    steps = [(g, row[f"low{i}"], row[f"high{i}"], row[f"sd{i}"], row[f"n{i}"]) for i, g in enumerate(own)]
    entries = []
    for g, low, high, sd, n in steps:
        if low is not None and sd:
            place = F.least(F.floor((own[g] - F.lit(low)) / F.lit((high - low) / bins)), F.lit(bins - 1)).cast("int")
            entries.append(F.when(own[g].isNotNull(), F.struct(
                F.lit(g).alias("group"), F.lit(low).alias("low"), F.lit((high - low) / bins).alias("width"),
                F.lit((high - low) / (grid - 1)).alias("step"), F.lit(sd * n ** -0.2).alias("h"),
                F.lit(n).alias("n"), place.alias("bin"))))
    if not entries:
        name = F.lit(next(iter(groups), ""))
        return df.select(name.alias("group"), F.lit(0).alias("point"), F.lit(0.0).alias("x"),
                         F.lit(0.0).alias("density")).where(F.lit(False))
    counts = df.select(F.coalesce(*entries).alias("e")).where("e IS NOT NULL").groupBy("e").agg(
        F.count(F.lit(1)).alias("count")).select("e.*", "count")
    centre = F.col("low") + (F.col("bin") + 0.5) * F.col("width")
    x = F.col("low") + F.col("point") * F.col("step")
    kernel = F.exp(-0.5 * F.pow((x - centre) / F.col("h"), F.lit(2))) / (F.col("h") * math.sqrt(2 * math.pi))
    return (counts.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
            .groupBy("group", "point", x.alias("x")).agg((F.sum(kernel * F.col("count") / F.col("n"))).alias("density")))


def density(df: DataFrame, column: str, grid: int = 50, bins: int = 200) -> DataFrame:
    """``densities`` of one group that holds all rows."""
    return densities(df, column, {"all": F.lit(True)}, grid, bins).drop("group")


def move_shares(df: DataFrame, price: str, listed: str, name: str) -> DataFrame:
    """Share of rows above, below and equal to the listed price; what is
    neither above nor below counts as equal."""
    n = F.count(name)
    up = F.count_if((F.col(price) > F.col(listed)) & F.col(name).isNotNull())
    down = F.count_if((F.col(price) < F.col(listed)) & F.col(name).isNotNull())
    return df.agg(F.try_divide(up, n).alias("up"), F.try_divide(down, n).alias("down"),
                  F.try_divide(n - up - down, n).alias("same"))


def mean_change(df: DataFrame, columns: Sequence[str], before: Column, after: Column) -> DataFrame:
    """Relative change of every column mean between two periods, in one pass."""
    def change(c: Column) -> Column:
        old, new = F.avg(F.when(before, c)), F.avg(F.when(after, c))
        return F.try_divide(new - old, old)
    return _per_column(df, columns, change, "change")


def exceed_rates(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Share of the table not above the given value, per named column."""
    n = F.count(F.lit(1))
    wide = df.agg(*[(1 - F.count_if(F.col(c) > F.lit(v)) / n).alias(c) for c, v in values.items()])
    return wide.unpivot([], list(values), "metric", "rate")


def exceed_rate_per_row(df: DataFrame, column: str, name: str = "rate") -> DataFrame:
    """Share of the table not above each row's own value.

    Runs on counts per distinct value; the rows then look their share up.
    """
    rows = df.where(F.col(column).isNotNull())
    n = rows.count()
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("__count"))
    shares = running_total(counts, [column], "__count", "__upto").select(
        column, (F.col("__upto") / F.lit(n)).alias(name))
    return lookup_join(rows, shares, [column])


def label_rates(df: DataFrame, positive: Column) -> DataFrame:
    """Counts and rates of two-class labels; rates are null for an empty table."""
    n = F.count(F.lit(1))
    return df.agg(F.count_if(positive).alias("pos_num"), F.count_if(~positive).alias("neg_num"),
                  F.try_divide(F.count_if(positive), n).alias("pos_rate"),
                  F.try_divide(F.count_if(~positive), n).alias("neg_rate"))


def percent_of_total(df: DataFrame, category: str) -> DataFrame:
    """Rows per category and their percent of all rows with a category.

    The total is summed over the counts: a row per category, whatever the table's size.
    """
    counts = materialize(value_counts(df, category), "counts")
    total = counts.agg(F.sum("count").alias("total")).first()["total"]
    return counts.withColumn("percent", F.col("count") * 100 / F.lit(total))


def top_per_group(df: DataFrame, group: str, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of each group with their rank. Spark cuts each input
    partition to ``n`` per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def top_lists(df: DataFrame, group: str, name: str, count: str, n: int | None = None) -> DataFrame:
    """Per group, parallel arrays of all names and their counts, highest count first.

    The arrays are the result, so a group's names have to fit in a row; ``n``
    keeps only the first ones, which are cut before the shuffle.
    """
    rows = df if n is None else top_per_group(df, group, [F.desc(count), name], n)
    entry = F.struct((-F.col(count)).alias("o"), F.col(name).alias("name"), F.col(count).alias("count"))
    ranked = rows.groupBy(group).agg(F.sort_array(F.collect_list(entry)).alias("top"))
    return ranked.select(group, F.col("top.name").alias("names"), F.col("top.count").alias("counts"))


def blend_ranks(df: DataFrame, score: str, views: str, key: str, w_score: float = 0.99,
                w_views: float = 0.01, n: int = 20) -> DataFrame:
    """Order a short result list by a blend of two orderings.

    The list is taken in ascending score; position t gets
    ``w_score * t + w_views * argsort(views)[t]`` and the best blend comes
    first. The list is an answer of the ``n`` highest scores, so one window covers it.
    """
    df = df.orderBy(F.desc(score), F.desc(key)).limit(n)
    everything = Window.partitionBy(F.lit(0))
    placed = df.withColumns({
        "position": F.row_number().over(everything.orderBy(score, key)) - 1,
        "__by_views": F.row_number().over(everything.orderBy(views, key)) - 1})
    argsort = placed.select(F.col("__by_views").alias("position"), F.col("position").alias("__argsort"))
    blend = F.lit(w_score) * F.col("position") + F.lit(w_views) * F.col("__argsort")
    blended = placed.drop("__by_views").join(argsort, "position").withColumn("blend", blend).drop("__argsort")
    place = F.row_number().over(everything.orderBy(F.desc("blend"), F.desc("position")))
    return blended.withColumn("place", place)
