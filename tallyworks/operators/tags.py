"""Tag counts per month, co-occurrence and relation scores.

Input is long form: one row per item (``basket``) and tag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import lookup_join, require_keys


def explode_tags(df: DataFrame, column: str, separator: str = ",") -> DataFrame:
    """One row per tag of a separated list."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.split(column, separator)).alias("tag"))


def tag_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Rows per tag, and per month if asked; ``n`` is summed where present."""
    amount = F.sum("n") if "n" in rows.columns else F.count(F.lit(1))
    return rows.groupBy(*by, "tag").agg(amount.alias("count"))


def basket_counts(rows: DataFrame, basket: str) -> DataFrame:
    """How often each tag stands in each basket."""
    return rows.groupBy(basket, "tag").agg(F.count(F.lit(1)).alias("n"))


def _asked(counts: DataFrame, requested: Sequence[str], name: str = "tag") -> DataFrame:
    """The requested tags as a table, each once."""
    return counts.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(requested)], f"{name} string")


def cooccurrence(counts: DataFrame, basket: str, requested: Sequence[str], distinct: bool = False) -> DataFrame:
    """(tag1, tag2, count) of the requested tags with every tag.

    ``counts`` holds (basket, tag, n). A tag k times in a basket makes k * (k - 1)
    with itself; ``distinct`` counts a repeated tag once. Rows of requested tags meet
    their basket's rows and are summed by pair before the shuffle, so the work grows
    with the request and the table, for a request of any length.
    """
    n = F.lit(1).cast("bigint") if distinct else F.col("n")
    rows = counts.select(basket, F.col("tag").alias("tag2"), n.alias("n2"))
    asked = counts.join(_asked(counts, requested), "tag", "left_semi").select(
        basket, F.col("tag").alias("tag1"), n.alias("n1"))
    others = F.col("n2") - F.when(F.col("tag1") == F.col("tag2"), 1).otherwise(0)
    return asked.join(rows, basket).groupBy("tag1", "tag2").agg(
        F.sum(F.col("n1") * others).alias("count")).where("count > 0")


def earlier_pairs(pair_counts: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Pairs of list positions j < i by their two tags, each pair once, the larger tag first.

    ``pair_counts`` names every partner of the requested tags; a pair of two
    requested tags stands there in both directions and is taken once.
    """
    marked = pair_counts.join(_asked(pair_counts, requested, "tag2").withColumn("__both", F.lit(True)), "tag2", "left")
    once = marked.where("tag1 >= tag2 OR __both IS NULL")
    half = F.when(F.col("tag1") == F.col("tag2"), F.expr("count div 2")).otherwise(F.col("count"))
    return once.select(F.greatest("tag1", "tag2").alias("tag1"), F.least("tag1", "tag2").alias("tag2"),
                       half.alias("count"))


def requested_pairs(pair_counts: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Counts of the pairs j < i of a requested list, 0 where never together."""
    listed = pair_counts.sparkSession.createDataFrame(list(enumerate(requested)), "i int, tag1 string")
    later = listed.where("i > 0").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("i") - 1)))
    wanted = later.join(listed.select(F.col("i").alias("j"), F.col("tag1").alias("tag2")), "j")
    found = wanted.join(pair_counts, ["tag1", "tag2"], "left")
    return found.select("i", "j", "tag1", "tag2", F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def relation_by_totals(pair_counts: DataFrame, totals: DataFrame) -> DataFrame:
    """2 c(u, v) / (n_u + n_v) with n the tag totals; no diagonal."""
    pairs = pair_counts.where("tag1 <> tag2")
    left = totals.select(F.col("tag").alias("tag1"), F.col("count").alias("__n1"))
    right = totals.select(F.col("tag").alias("tag2"), F.col("count").alias("__n2"))
    scored = lookup_join(lookup_join(pairs, left, ["tag1"]), right, ["tag2"])
    return scored.select("tag1", "tag2", (2 * F.col("count") / (F.col("__n1") + F.col("__n2"))).alias("relation"))


def relation_request(counts: DataFrame, basket: str, requested: Sequence[str]) -> DataFrame:
    """(i, j, relation) for a requested tag list, both directions; 0 for tags
    that never meet. An unknown tag is an error."""
    totals = require_keys(_asked(counts, requested), tag_counts(counts), ["tag"])
    pairs = requested_pairs(cooccurrence(counts, basket, requested), requested)
    for k in ("1", "2"):
        pairs = pairs.join(totals.select(F.col("tag").alias(f"tag{k}"), F.col("count").alias(f"__n{k}")), f"tag{k}")
    both = F.array(*[F.struct(F.col(a).alias("i"), F.col(b).alias("j")) for a, b in (("i", "j"), ("j", "i"))])
    score = 2 * F.col("count") / (F.col("__n1") + F.col("__n2"))
    return pairs.select(F.explode(both).alias("e"), score.alias("relation")).select("e.i", "e.j", "relation")


def partner_sums(counts: DataFrame, basket: str) -> DataFrame:
    """Per tag, its pair counts summed over all partners, without forming a pair:
    a tag n times in a basket of N tags has n * (N - 1) partners there."""
    sizes = counts.groupBy(basket).agg(F.sum("n").alias("__size"))
    return lookup_join(counts, sizes, [basket], "inner").groupBy("tag").agg(
        F.sum(F.col("n") * (F.col("__size") - 1)).alias("count"))


def relation_by_pairs(counts: DataFrame, basket: str, requested: Sequence[str]) -> DataFrame:
    """2 c(u, v) / (sum_t c(u, t) + sum_t c(t, v)) of the requested tags with every tag; no diagonal."""
    return relation_by_totals(cooccurrence(counts, basket, requested), partner_sums(counts, basket))
