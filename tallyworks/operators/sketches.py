"""Mergeable sketches: distinct numbers and most frequent values, stored and combined.

A distinct sketch has a fixed size (``lg_k``: 2**lg_k registers) and a relative standard
error of 1.04 / 2**(lg_k / 2); ``distinct_bound`` gives four times that. Sketches of parts
(days, batches, groups) are stored and merged, so an overlapping or late part costs its own rows only.

A top state tracks at most ``tracked`` values. Whatever stands more than
``ERROR_SHARE / tracked`` of a group's rows is in it for certain, so an exact count of its
candidates gives the exact most frequent values if the last of them is above that share;
where it is not, the state is made larger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import lookup_join
from tallyworks.operators.statistics import top_per_group
from tallyworks.session import discard, materialize

# Of n rows, what a state of m tracked values may miss stands at most n * ERROR_SHARE / m times.
ERROR_SHARE = 3.5
# The largest state that Spark makes.
MOST_TRACKED = 1_000_000


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, lg_k: int = 12, name: str = "sketch") -> DataFrame:
    """One sketch of the distinct values of ``column`` per group, nulls left out."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(column), lg_k).alias(name))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), name: str = "sketch") -> DataFrame:
    """Sketches of the coarser groups ``by`` from those of their parts; parts may overlap."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(name).alias(name))


def distinct_estimates(sketches: DataFrame, name: str = "sketch", to: str = "distinct") -> DataFrame:
    return sketches.withColumn(to, F.hll_sketch_estimate(name)).drop(name)


def distinct_bound(lg_k: int = 12) -> float:
    """Relative error that an estimate stays below in all but some 1 of 16,000 cases."""
    return 4 * 1.04 / 2 ** (lg_k / 2)


def top_states(df: DataFrame, by: Sequence[str], column: str, tracked: int = 10_000) -> DataFrame:
    """(by, rows, state): a bounded state of the most frequent values per group, mergeable."""
    return df.where(F.col(column).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(`{column}`, {tracked})").alias("state"))


def merged_states(states: DataFrame, by: Sequence[str], tracked: int = 10_000) -> DataFrame:
    """States of the groups ``by`` from those of their parts (days, batches)."""
    return states.groupBy(*by).agg(F.sum("rows").alias("rows"),
                                   F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"))


def candidates(states: DataFrame, by: Sequence[str], column: str, tracked: int = 10_000) -> DataFrame:
    """(by, column, rows): every value that a group's state tracks, and the group's number of rows."""
    listed = states.select(*by, "rows", F.explode(F.expr(f"approx_top_k_estimate(state, {tracked})")).alias("e"))
    return listed.select(*by, "rows", F.col("e.item").alias(column))


def exact_top(df: DataFrame, states: DataFrame, by: str, column: str, n: int,
              tracked: int = 10_000) -> tuple[DataFrame, bool]:
    """The ``n`` most frequent values per group, counted exactly among the states' candidates, and
    whether no other value can be among them. Ties go to the smaller value.

    That is certain for a group whose candidates make up all its rows, or whose last value
    stands more often than anything that a state of this size can miss.
    """
    keys = [by, column]
    asked = materialize(candidates(states, [by], column, tracked), "candidates")
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    counted = materialize(lookup_join(counts, asked, keys, "inner"), "counted")
    top = materialize(top_per_group(counted.drop("rows"), by, [F.desc("count"), column], n), "top")
    last = top.groupBy(by).agg(F.min("count").alias("least"), F.count(F.lit(1)).alias("got"))
    whole = counted.groupBy(by).agg(F.sum("count").alias("all"))
    # a state may have lost all its values, so the groups are those of the states
    groups = states.select(F.col(by).alias("__g"), "rows").join(whole, F.col("__g").eqNullSafe(F.col(by)), "left").drop(by).join(
        last, F.col("__g").eqNullSafe(F.col(by)), "left")
    enough = (F.col("got") == n) & (F.col("least") > F.col("rows") * F.lit(ERROR_SHARE / tracked))
    sure = groups.where(~F.coalesce(enough, F.lit(False)) & (F.coalesce("all", F.lit(0)) < F.col("rows"))).isEmpty()
    discard(asked)
    discard(counted)
    return top, sure


def most_frequent(df: DataFrame, by: str, column: str, n: int, parts: Sequence[str] = (),
                  tracked: int = 10_000) -> DataFrame:
    """(by, column, count, rank) of the ``n`` most frequent values of each group, exact.

    One read makes a state per group and part, which are stored and merged; a second read counts
    the candidates. If the states were too small to be sure they are made larger; beyond the
    largest, all values are counted.
    """
    while tracked <= MOST_TRACKED:
        stored = materialize(top_states(df, [by, *parts], column, tracked), "top-states")
        top, sure = exact_top(df, merged_states(stored, [by], tracked), by, column, n, tracked)
        discard(stored)
        if sure:
            return top
        discard(top)
        tracked *= 10
    counts = df.where(F.col(column).isNotNull()).groupBy(by, column).agg(F.count(F.lit(1)).alias("count"))
    return top_per_group(counts, by, [F.desc("count"), column], n)
