"""The paths for large inputs and hot keys give the same rows as brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyworks.operators import joins, ordering, quantiles, tags
from tallyworks.session import materialize
from tests.conftest import executed_plan


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = ordering.number_rows(df, ["k"], "n").orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(1, 5001))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)


def test_numbers_with_hot_sort_value(spark):
    """Most rows share the first sort key; the key that identifies them spreads them."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 5).alias("g"), "id")
    got = ordering.number_rows(df, ["g", "id"]).collect()
    expected = {key: n for n, key in enumerate(sorted((r["g"], r["id"]) for r in got), 1)}
    assert all(r["row_number"] == expected[(r["g"], r["id"])] for r in got)


def test_running_totals(spark):
    df = spark.range(2000).select("id", ((F.col("id") * 31) % 17).alias("w"))
    values = [(i * 31) % 17 for i in range(2000)]
    got = {r["id"]: (r["a"], r["b"]) for r in ordering.running_total(
        ordering.running_total(df, ["id"], "w", "a"), ["id"], "w", "b", inclusive=False).collect()}
    total = 0
    for i, w in enumerate(values):
        assert got[i] == (total + w, total)
        total += w


def test_empty_order(spark):
    assert ordering.number_rows(spark.range(0), ["id"]).count() == 0
    assert ordering.running_total(spark.range(0).withColumn("w", F.lit(1)), ["id"], "w").count() == 0


def test_first_rows_cut(spark):
    got = ordering.first_rows(spark.range(1000), [F.desc("id")], 300)
    assert sorted(r["id"] for r in got.collect()) == list(range(700, 1000))
    assert ordering.first_rows(spark.range(1000), ["id"]).count() == 1000


@pytest.fixture
def small_splits(spark):
    """Adaptive execution treats small partitions as large ones; nothing is broadcast."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key in values:
        spark.conf.unset(key)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_and_null_keys_join(spark, small_splits, how):
    """One scan of the facts; the hot key's partition is split over tasks."""
    data = [(i, None if i % 3 == 0 else (1 if i % 3 == 1 else i % 50), f"r{i}") for i in range(30_000)]
    facts = materialize(spark.createDataFrame(data, "id int, k int, v string").repartition(8), "facts")
    lookup = materialize(spark.createDataFrame([(k, k * 10) for k in range(60) if k != 4], "k int, w int"), "lookup")
    got = joins.lookup_join(facts, lookup, ["k"], how)
    found = got.collect()
    plan = executed_plan(got)
    assert "skewed" in plan.lower() or "skew=true" in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2
    want = {k: k * 10 for k in range(60) if k != 4}
    expected = [(i, k, v, want.get(k)) for i, k, v in data if how == "left" or k in want]
    assert len(found) == len(expected)
    assert sum(r["w"] or 0 for r in found) == sum(w or 0 for _, _, _, w in expected)


def test_membership_and_required_keys(spark):
    probes = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    known = spark.createDataFrame([(2, "b"), (2, "b"), (5, "e")], "k int, v string")
    assert {(r["k"], r["member"]) for r in joins.membership(probes, known, "k").collect()} == {(1, False), (2, True)}
    with pytest.raises(LookupError):
        joins.require_keys(probes, known, ["k"])
    assert joins.require_keys(probes.where("k = 2"), known.distinct(), ["k"]).count() == 1


@pytest.mark.parametrize("accuracy", [100_000, 40])
@pytest.mark.parametrize("bracket_rows", [50, 10**9])
def test_quantiles_by_every_path(spark, monkeypatch, accuracy, bracket_rows):
    """A sketch too coarse for its bracket is noticed and the bracket widened."""
    monkeypatch.setattr(quantiles, "BRACKET_ROWS", bracket_rows)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", accuracy)
    rng = random.Random(3)
    data = [("hot", rng.gauss(0, 1e6)) for _ in range(20_000)] + [("ties", float(rng.randrange(3))) for _ in range(9_000)]
    data += [("few", float(v)) for v in (1, 2, 3, 4, 100)] + [("null", None), ("one", 5.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {r["g"]: (r["n"], r["quantiles"]) for r in quantiles.exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    groups = defaultdict(list)
    for g, v in data:
        if v is not None:
            groups[g].append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert np.allclose(got[g][1], np.quantile(values, probs), rtol=1e-12)


def test_summary_reads_the_facts_twice(spark):
    facts = materialize(spark.range(1000).select((F.col("id") % 97).cast("double").alias("v")), "facts")
    reads = []
    kind, original = type(facts), type(facts).agg

    def counted(df, *columns):
        reads.append(df)
        return original(df, *columns)
    kind.agg = counted
    try:
        row = quantiles.numeric_summary(facts, ["v"]).first()
    finally:
        kind.agg = original
    assert len(reads) == 2 and all(df is facts for df in reads)
    assert (row["count"], row["min"], row["p50"], row["max"]) == (1000, 0, 46.5, 96)


def brute_pairs(lists):
    pairs = Counter()
    for items in lists:
        for i in range(len(items)):
            for j in range(i):
                pairs[items[i], items[j]] += 1
                pairs[items[j], items[i]] += 1
    return {k: v for k, v in pairs.items()}


def pair_table(df):
    return {(r["tag1"], r["tag2"]): r["count"] for r in df.collect()}


LISTS = [["a", "b", "a"], ["a"], ["c", "b", "a", "d"], ["d", "d", "d"], ["e", "a"] * 5] + [["hot", "a", "b"]] * 30


def own(lists, tags_asked):
    return {k: v for k, v in brute_pairs(lists).items() if k[0] in tags_asked}


def test_cooccurrence(spark):
    rows = spark.createDataFrame([(i, ",".join(x)) for i, x in enumerate(LISTS)], "basket int, tag string")
    counts = tags.basket_counts(tags.explode_tags(rows, "tag"), "basket")
    for asked in ([], ["a", "hot"], ["a", "a", "unseen"], list("abcde") + ["hot"]):
        assert pair_table(tags.cooccurrence(counts, "basket", asked)) == own(LISTS, asked)
    single = [sorted(set(x)) for x in LISTS]
    assert pair_table(tags.cooccurrence(counts, "basket", ["a"], distinct=True)) == own(single, ["a"])


def test_a_wide_request(spark):
    """450 tags asked for at once; no driver loop."""
    rows = spark.range(8000).select((F.col("id") % 2500).alias("basket"),
                                    F.concat(F.lit("t"), (F.col("id") * 7919) % 450).alias("tag"))
    counts = materialize(tags.basket_counts(rows, "basket"), "counts")
    asked = [f"t{i}" for i in range(450)]
    lists = defaultdict(list)
    for r in rows.collect():
        lists[r["basket"]].append(r["tag"])
    assert pair_table(tags.cooccurrence(counts, "basket", asked)) == brute_pairs(lists.values())
    assert tags.relation_request(counts, "basket", asked).count() == 450 * 449


def test_one_basket_holds_most_rows(spark):
    rows = [(0, t) for t in "abcab" * 400] + [(i, "a") for i in range(1, 50)]
    counts = tags.basket_counts(spark.createDataFrame(rows, "basket int, tag string"), "basket")
    got = pair_table(tags.cooccurrence(counts, "basket", ["a"]))
    assert got[("a", "a")] == 800 * 799 and got[("a", "c")] == 800 * 400


def test_relation_scores(spark):
    rows = spark.createDataFrame([(0, "a"), (0, "b"), (0, "a")], "basket int, tag string")
    counts = tags.basket_counts(rows, "basket")
    pairs = tags.cooccurrence(counts, "basket", ["a", "b"])
    assert pair_table(pairs) == {("a", "b"): 2, ("b", "a"): 2, ("a", "a"): 2}
    by_totals = tags.relation_by_totals(pairs, tags.tag_counts(counts)).collect()
    assert {(r["tag1"], round(r["relation"], 3)) for r in by_totals} == {("a", 1.333), ("b", 1.333)}
    by_pairs = tags.relation_by_pairs(counts, "basket", ["a", "b"]).collect()
    assert {round(r["relation"], 3) for r in by_pairs} == {0.667}
    assert pair_table(tags.earlier_pairs(pairs, ["a", "b"])) == {("a", "a"): 1, ("b", "a"): 2}
    only = tags.cooccurrence(counts, "basket", ["a"])
    assert pair_table(tags.earlier_pairs(only, ["a"])) == {("a", "a"): 1, ("b", "a"): 2}


def test_relation_request(spark):
    rows = spark.createDataFrame([(0, "a"), (0, "b"), (0, "a"), (1, "c")], "basket int, tag string")
    counts = tags.basket_counts(rows, "basket")
    got = {(r["i"], r["j"]): round(r["relation"], 3) for r in
           tags.relation_request(counts, "basket", ["b", "a", "c"]).collect()}
    assert got == {(1, 0): 1.333, (0, 1): 1.333, (2, 0): 0, (0, 2): 0, (2, 1): 0, (1, 2): 0}
    with pytest.raises(LookupError):
        tags.relation_request(counts, "basket", ["a", "nobody"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), min_size=1, max_size=6), min_size=1, max_size=12))
def test_cooccurrence_of_any_lists(spark, lists):
    rows = spark.createDataFrame([(i, ",".join(x)) for i, x in enumerate(lists)], "basket int, tag string")
    counts = tags.basket_counts(tags.explode_tags(rows, "tag"), "basket")
    assert pair_table(tags.cooccurrence(counts, "basket", list("abcd"))) == brute_pairs(lists)


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_ungrouped_quantiles_read_twice_and_store_nothing(spark, monkeypatch, accuracy):
    """A poor sketch only widens the bracket; types, ties, nulls, an empty column."""
    import random

    def stored(*_):
        raise AssertionError("a table was stored")
    monkeypatch.setattr(quantiles, "materialize", stored)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "BRACKET_MARGIN", 10 / accuracy if accuracy > 100 else 0.001)
    rng = random.Random(3)
    values = [rng.choice([None, 7, rng.randint(0, 10**6)]) for _ in range(5000)]
    df = spark.createDataFrame([(v, None if v is None else v / 3, None) for v in values], "a long, b double, c int").withColumn(
        "d", F.col("a").cast("decimal(12,2)"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.column_figures(df, ["a", "b", "c", "d"], probs, moments=True)
    known = sorted(v for v in values if v is not None)

    def at(p):
        x = (len(known) - 1) * p
        low = known[int(x)]
        return low + (x - int(x)) * (known[min(int(x) + 1, len(known) - 1)] - low)
    assert list(got) == ["a", "b", "d"] and got["a"].n == len(known)
    assert got["a"].quantiles == pytest.approx([at(p) for p in probs])
    assert got["d"].quantiles == pytest.approx(got["a"].quantiles)
    assert got["b"].quantiles == pytest.approx([at(p) / 3 for p in probs])
    assert got["a"].mean == pytest.approx(sum(known) / len(known)) and got["a"].most == known[-1]


def test_whole_numbers_beyond_53_bits_are_told_apart(spark):
    base = 2**60
    df = spark.createDataFrame([(base + k,) for k in (1, 2, 3)], "v long")
    row = df.agg(F.count_if(F.col("v") > F.lit(base + 2)).alias("n")).first()
    assert row["n"] == 1 and quantiles.outlier_counts(df, ["v"]).first()["above"] == 0
    assert quantiles.column_figures(df, ["v"], [0.5])["v"].quantiles == [float(base + 2)]
