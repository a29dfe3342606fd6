"""Hand-worked statistics, cleaning and feature results."""

import math

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import evaluation, features, joins, quantiles, statistics as stats, tables, words
from tallyworks.operators.graphs import selection_shares


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_fences_and_outliers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)], "v double")
    near = quantiles.iqr_fences(df, ["v"]).first()
    assert (near["q1"], near["q3"], near["lower"], near["upper"]) == (2.0, 4.0, -1.0, 7.0)
    far = quantiles.iqr_fences(df, ["v"], 3).first()
    assert (far["lower"], far["upper"]) == (-4.0, 10.0)
    assert rows(quantiles.outlier_counts(df, ["v"])) == [("v", 1, 0)]
    assert rows(quantiles.drop_outliers(df, ["v"])) == [(1.0,), (2.0,), (3.0,), (4.0,)]


def test_outlier_passes_run_in_turn(spark):
    """The second column's fences come from what the first pass left."""
    data = [(float(a), float(b)) for a, b in ((1, 10), (2, 11), (3, 12), (4, 13), (900, 1000), (5, 14), (2, 40))]
    df = spark.createDataFrame(data, "a double, b double")
    left = data
    for i in (0, 1):
        import numpy as np
        q1, q3 = np.quantile([r[i] for r in left], [0.25, 0.75])
        left = [r for r in left if q1 - 1.5 * (q3 - q1) <= r[i] <= q3 + 1.5 * (q3 - q1)]
    assert rows(quantiles.drop_outliers(df, ["a", "b"])) == sorted(left, key=str)


def test_mode_takes_lowest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert quantiles.mode_of(df, "c").first()["mode"] == "a"


def test_fill_from_neighbours(spark):
    data = [(1, "x1", "y1", "a"), (2, "x1", "y1", None), (3, "x2", "y2", None), (4, None, "y1", None),
            (5, "x3", "y3", "b"), (6, "x4", "y4", "b")]
    df = spark.createDataFrame(data, "id int, x string, y string, v string")
    got = {r["id"]: r["v"] for r in tables.fill_from_neighbours(df, "v", ["x", "y"]).collect()}
    assert got == {1: "a", 2: "a", 3: "b", 4: None, 5: "b", 6: "b"}


def test_move_shares(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1), (1, None)], "p int, q int").withColumn("name", F.lit("n"))
    assert tuple(stats.move_shares(df, "p", "q", "name").first()) == (0.25, 0.25, 0.5)


def test_exceed_rates(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 4)], "id int, v int")
    assert stats.exceed_rates(df, {"v": 2}).first()["rate"] == 0.75
    got = {r["id"]: r["rate"] for r in stats.exceed_rate_per_row(df, "v").collect()}
    assert got == {1: 0.25, 2: 0.75, 3: 0.75, 4: 1.0}


def test_rates_of_empty_tables(spark):
    empty = spark.createDataFrame([], "v int")
    assert stats.label_rates(empty, F.col("v") == 1).first()["pos_rate"] is None
    assert stats.histogram(empty, "v", 5).count() == 0
    assert stats.density(empty, "v").count() == 0
    assert quantiles.exact_quantiles(empty, ["v"], [0.5]).count() == 0
    assert quantiles.fence_values(empty, "v") == (None, None)


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    assert rows(stats.histogram(df, "v", 5)) == [(0, 4)]
    assert [r["v"] for r in features.standard_scaled(df, ["v"]).collect()] == [0.0] * 4


def test_blend_keeps_similarity_order(spark):
    df = spark.createDataFrame([(i, i / 20, (i * 7919) % 101) for i in range(20)], "id int, s double, views int")
    got = stats.blend_ranks(df, "s", "views", "id").orderBy("place")
    assert [r["id"] for r in got.collect()] == list(range(19, -1, -1))


def test_density_integrates_to_one(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 997).alias("v"))
    found = stats.density(df, "v", grid=200).orderBy("point").collect()
    step = found[1]["x"] - found[0]["x"]
    assert 0.85 < sum(r["density"] for r in found) * step <= 1.0


def test_category_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "B")], "id int, c string")
    got = {r["id"]: r["c_code"] for r in features.category_codes(df, "c").collect()}
    assert got == {1: 2, 2: 1, 3: -1, 4: 0}


def test_one_hot_by_appearance(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b")], "id int, c string")
    assert rows(features.one_hot_by_appearance(df, "c", "id")) == [(1, 1, 0), (2, 0, 1), (3, 1, 0)]


def test_token_dummies_contain(spark):
    df = spark.createDataFrame([(1, "south east"), (2, "southeast")], "id int, c string")
    got = features.dummies_by_token(df, "c")
    assert got.columns == ["id", "c_east", "c_south", "c_southeast"]
    assert rows(got) == [(1, 1, 1, 0), (2, 1, 1, 1)]


def test_form_of_dummies_is_the_callers_choice(spark):
    """1,001 values: columns are refused with a word, never switched; the vector holds them all, and few ones too."""
    df = spark.range(1002).select("id", F.when(F.col("id") < 1001, F.format_string("v%04d", F.col("id"))).alias("c"))
    for make in (lambda f: features.dummies_by_value(df, ["c"], f), lambda f: features.one_hot_by_appearance(df, "c", "id", f)):
        with pytest.raises(ValueError, match="more than 1000 values"):
            make("columns")
        with pytest.raises(ValueError, match="form is one of"):
            make("list")
        made = make("vector")
        assert made.columns == ["id", "c_vector"]
        for row in made.collect():
            assert row["c_vector"].size == 1002
            assert row["c_vector"].indices.tolist() == [0 if row["id"] == 1001 else row["id"] + 1]
    few = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    assert {r["id"]: r["c_vector"].indices.tolist() for r in features.dummies_by_value(few, ["c"], "vector").collect()} == {
        1: [2], 2: [1], 3: [0]}
    assert len(features.dummies_by_value(df, ["c"], width=1001).columns) == 1002


def test_token_lists(spark):
    df = spark.createDataFrame([(1, "south east"), (2, "southeast"), (3, None), (4, "a  b"), (5, "ab b"), (6, "")],
                               "id int, c string")
    got = {r["id"]: r["c_tokens"] for r in features.dummies_by_token(df, "c", "list").collect()}
    tokens = {"south", "east", "southeast", "a", "", "b", "ab"}
    assert got == {r["id"]: None if r["c"] is None else sorted(x for x in tokens if x in r["c"]) for r in df.collect()}


def test_needles_in_one_very_long_token_among_many(spark):
    """5,000 tokens, one of 10,000 characters: every one is found where it is contained."""
    import random

    rng = random.Random(3)
    tokens = {"".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(6000)}
    tokens = sorted(tokens)[:4999] + ["".join(rng.choices("abcdefgh", k=10_000))]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = {(r["text"], r["needle"]) for r in features.containing(df, df).where(F.length("text") > 100).collect()}
    assert got == {(tokens[-1], t) for t in tokens if t in tokens[-1]}
    some = set(rng.sample(tokens, 60))
    short = features.containing(df.where(F.length("t") <= 100), df.where(F.col("t").isin(list(some)))).collect()
    assert {(r["text"], r["needle"]) for r in short} == {(t, n) for t in tokens[:-1] for n in some if n in t}


@pytest.mark.parametrize("power", [0.0, 0.333, 4.5, -3.25])
def test_best_power_is_the_optimum(spark, power):
    """Data made normal by a known power, also beyond 2: the likelihood is highest there, to a thousandth."""
    import numpy as np

    rng = np.random.default_rng(1)
    z = 1 + 0.02 * rng.standard_normal(4000) * (1 if power >= 0 else 0.1)
    x = np.expm1(z) if power == 0 else (1 + np.abs(power) * 0.2 * z) ** (1 / power) - 1
    x = x - min(0, x.min())
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    found = features.best_powers(df, ["v"]).first()

    def fit(p):
        l = np.log1p(x)
        y = l if abs(p) < 1e-12 else np.expm1(p * l) / p
        return -len(x) / 2 * np.log(y.var()) + (p - 1) * l.sum()
    near = [found["power"] + k / 1000 for k in (-1, 1)]
    assert all(fit(found["power"]) >= fit(p) for p in near)
    wide = np.arange(-20, 20.01, 0.25)
    assert fit(found["power"]) >= max(fit(p) for p in wide) - 1e-6


def test_top_lists_hold_every_name(spark):
    df = spark.createDataFrame([(1, f"t{i:02d}", i % 7) for i in range(30)], "g int, t string, n int")
    row = stats.top_lists(df, "g", "t", "n").first()
    assert row["names"] == [f"t{i:02d}" for i in sorted(range(30), key=lambda i: (-(i % 7), i))]
    assert row["counts"] == sorted((i % 7 for i in range(30)), reverse=True)
    assert len(stats.top_lists(df, "g", "t", "n", 4).first()["names"]) == 4


def test_removed_counts_leave_out_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)], "v double")
    assert rows(quantiles.removed_counts(df, ["v"])) == [("v", 1)]


def test_power_transform_reduces_skew(spark):
    df = spark.range(1, 500).select(F.exp(F.col("id") / 100).alias("v"))
    before = df.agg(F.skewness("v")).first()[0]
    after = features.power_transformed(df, ["v"]).agg(F.skewness("v"), F.avg("v"), F.stddev_pop("v")).first()
    assert abs(after[0]) < abs(before) / 3
    assert abs(after[1]) < 1e-9 and math.isclose(after[2], 1.0, rel_tol=1e-9)


def test_negative_values_transform(spark):
    row = spark.createDataFrame([(-3.0,)], "v double").select(
        features.yeo_johnson(F.col("v"), F.lit(2.0)), features.yeo_johnson(F.col("v"), F.lit(0.0))).first()
    assert math.isclose(row[0], -math.log(4)) and math.isclose(row[1], -(4 ** 2 - 1) / 2)


def test_regression_measures(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    assert df.agg(evaluation.mean_percent_error(F.col("y"), F.col("p"))).first()[0] == 0.5
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.2), (4.0, 3.5)], "y double, p double")
    assert round(df.agg(evaluation.explained_variance(F.col("y"), F.col("p"))).first()[0], 4) == 0.8871


def test_tfidf_drops_words_of_every_text(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "x z")], "id int, t string")
    weights, idf = words.text_weights(df, "id", "t")
    assert rows(weights) == [(1, "y", 1.0), (2, "z", 1.0)]
    query = words.query_weights(spark.createDataFrame([("z unknown",)], "t string"), "t", idf)
    assert rows(words.most_similar(weights, "id", query)) == [(2, 1.0)]


def test_updates_and_lookups(spark):
    old = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, v int")
    new = spark.createDataFrame([(2, 60), (3, 70)], "id int, v int")
    assert rows(joins.update_by_key(old, new, "id", ["v"])) == [(1, 5), (2, 60), (3, 70)]
    assert rows(joins.lookup_or_zero(old.select("id"), new, ["id"], "v")) == [(1, 0), (2, 60), (3, 70)]


def test_tables(spark):
    df = spark.createDataFrame([(0, "未知"), (1, "b"), (None, None)], "n int, c string")
    assert rows(tables.drop_zero_rows(df, ["n"])) == [(1, "b"), (None, None)]
    assert rows(tables.keep_range(df, "n", 1, 5)) == [(1, "b"), (None, None)]
    assert rows(tables.drop_equal(df, "c", "未知")) == [(1, "b"), (None, None)]
    assert rows(tables.blank_to_null(df, "未知")) == [(0, None), (1, "b"), (None, None)]
    assert tables.match_text(df, "c", "").count() == 2
    with pytest.raises(KeyError):
        tables.rename_columns(df, {"missing": "x"})


def test_date_range_ends_at_midnight(spark):
    df = spark.createDataFrame([("2019-06-30 00:00:00",), ("2019-06-30 00:01:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2019-01-01", "2019-06-30"))
    assert df.where(F.col("t").between(low, high)).count() == 1


def test_selection_shares(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "id int, f double")
    got = selection_shares(df, "id", "f").orderBy("id").collect()
    assert [(r["probability"], r["running"]) for r in got] == [(0.25, 0.25), (0.75, 1.0)]


def test_power_beyond_which_the_likelihood_overflows_is_marked(spark):
    """A narrow column far to the right: the best power is not held at any limit."""
    import numpy as np
    values = 20 + np.random.default_rng(1).beta(30, 1, 800)
    found = features.best_powers(spark.createDataFrame([(float(v),) for v in values], "v double"), ["v"]).first()
    assert found["power"] > 64
    flat = features.best_powers(spark.createDataFrame([(float(k),) for k in range(1, 400)], "v double"), ["v"]).first()
    assert not flat["at_end"]
