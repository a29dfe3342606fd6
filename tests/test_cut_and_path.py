"""Dictionary cuts by hand, the L1 path against Spark's own fits, documents of any schema."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallyworks.operators import cutting, lasso, words
from tallyworks.operators.features import assemble
from tallyworks.sources import documents


def test_ambiguous_runs_take_the_most_likely_path():
    cutter = cutting.Cutter({"研究": 50, "研究生": 20, "生命": 40, "命": 5, "起源": 30, "生": 3})
    assert cutter.cut("研究生命起源") == ["研究", "生命", "起源"]
    assert cutter.cut("研究生") == ["研究生"]
    assert cutter.cut("他研究") == ["他", "研究"]
    # equal shares: the longer first word
    assert cutting.Cutter({"ab": 4, "c": 4, "a": 4, "bc": 4, "x": 100}).cut("abc") == ["ab", "c"]
    assert cutter.cut("") == []


def test_cut_is_the_best_of_all_cuts():
    rng = random.Random(4)
    weights = {"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.randint(1, 50) for _ in range(25)}
    cutter = cutting.Cutter(weights)
    total = sum(weights.values())
    for _ in range(60):
        run = "".join(rng.choices("abcd", k=rng.randint(1, 9)))

        def value(parts):
            return sum(math.log(weights[p] / total) if p in weights else -math.log(total) if len(p) == 1 else -math.inf for p in parts)
        best = max(value([run[a:b] for a, b in zip((0, *cuts), (*cuts, len(run)))])
                   for k in range(len(run)) for cuts in itertools.combinations(range(1, len(run)), k))
        assert math.isclose(value(cutter.cut(run)), best)


def test_texts_are_cut_in_place_and_counted(spark):
    rows = [(1, "我爱北京 and 北京烤鸭!", 0.5), (2, None, None), (3, "", 1.0)]
    df = spark.createDataFrame(rows, "id int, t string, x double")
    table = spark.createDataFrame([("北京", 9), ("烤鸭", 4), ("北京烤鸭", 1), ("爱", 5), ("我", 5), (None, 3), ("北京", 1)], "word string, n long")
    held = cutting.read_dictionary(table)
    assert held["北京"] == 10 and len(held) == 5
    got = {r["id"]: r["t"] for r in cutting.cut_texts(df, "t", held).collect()}
    assert got[1].split() == ["我", "爱", "北京", "and", "北京", "烤鸭", "!"] and got[2] is None and got[3] == ""
    counts = words.title_word_counts(cutting.cut_texts(df, "t", held), "t", spark.createDataFrame([("and",)], "w string"),
                                     cutting.split_words)
    assert {(r["word"], r["count"]) for r in counts.collect()} == {("北京", 2), ("烤鸭", 1)}


def test_large_dictionary_and_its_limit(spark):
    table = spark.range(100_000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.lit(1).alias("n"))
    held = cutting.read_dictionary(table)
    df = spark.createDataFrame([("w12w99999w7x",)], "t string")
    assert cutting.cut_texts(df, "t", held, "[a-z0-9]+").first()["t"].split() == ["w12", "w99999", "w7", "x"]
    with pytest.raises(ValueError, match="more than tasks are to hold"):
        cutting.read_dictionary(table, most=1000)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 5)) * [1, 10, 0.1, 3, 1] + [0, 5, 2, -3, 0]
    x[:, 4] = 7
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + 40 * x[:, 2] + rng.normal(size=600) + 10
    data = [(*map(float, r), float(v), int(k % 3)) for k, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "a double, b double, c double, d double, e double, y double, fold int").cache()


def test_path_equals_sparks_fit_of_every_strength_and_fold(rows):
    names, strengths = list("abcde"), [0.01, 0.1, 1.0, 50.0]
    parts = lasso.fold_moments(rows, names, "y", F.col("fold"), 3)
    for k in range(3):
        others = [m for i, m in enumerate(parts) if i != k]
        train, test = (assemble(rows.where(f), names) for f in (F.col("fold") != k, F.col("fold") == k))
        for line in lasso.fit_path(others[0] + others[1], strengths):
            model = LinearRegression(labelCol="y", elasticNetParam=1.0, regParam=line.strength, tol=1e-12, maxIter=2000).fit(train)
            assert np.allclose(model.coefficients.toArray(), line.coefficients, rtol=1e-6, atol=1e-6)
            assert math.isclose(model.intercept, line.intercept, rel_tol=1e-6)
            mse = model.transform(test).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
            assert math.isclose(lasso.squared_error(parts[k], line), mse, rel_tol=1e-4)


def test_path_is_the_optimum_of_badly_scaled_columns(spark):
    """Far means and widely different scales: the conditions of the optimum hold, where iterative fits get stuck."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 3)) * [1, 0.1, 1000] + [0, 1e4, -3]
    y = 3 * x[:, 0] + 40 * x[:, 1] + rng.normal(size=500) + 1e5
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    for line in lasso.fit_path(lasso.fold_moments(df, list("abc"), "y", F.lit(0), 1)[0], [0.05, 0.5]):
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        pull = z.T @ (y - x @ line.coefficients - line.intercept) / len(y)
        on = line.coefficients != 0
        assert np.allclose(pull[on], line.strength * np.sign(line.coefficients[on]), atol=1e-6)
        assert (np.abs(pull[~on]) <= line.strength + 1e-6).all()


def test_search_reads_twice_and_predicts(rows):
    found = lasso.search(rows, list("abcde"), "y", [0.01, 0.1, 1000.0])
    assert found.best.strength < 1000 and found.errors[found.best.strength] == min(found.errors.values())
    gap = found.predicted(rows, list("abcde")).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    assert gap < 1.3


def test_no_rows_and_nulls(spark):
    none = spark.createDataFrame([], "a double, y double")
    assert lasso.search(none, ["a"], "y", [0.1]).best.coefficients.tolist() == [0.0]
    some = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 9.0), (3.0, 6.0)], "a double, y double")
    found = lasso.fold_moments(some, ["a"], "y", F.lit(0), 1)
    line = lasso.fit_path(found[0], [0.0])[0]
    assert found[0].n == 3 and math.isclose(line.coefficients[0], 2.0) and abs(line.intercept) < 1e-9


def test_documents_of_any_shape_lose_nothing(spark, tmp_path):
    lines = ['{"id":1,"v":1.5,"m":{"b":"x"}}', '{"id":"p2","tags":["a",1],"m":{"b":2,"c":null}}', '{"id":3,"u v":"w"}', "bad", "",
             '{"id":9007199254740993}', '[1]']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/d")
    docs = documents.read_documents(spark, f"{tmp_path}/d")
    assert [r[0] for r in docs.where("malformed IS NOT NULL").select("malformed").collect()] == ["bad"]
    objects = docs.where(documents.type_name(F.col("doc")) == "OBJECT")
    flat = documents.flattened(objects)
    assert set(flat.columns) == {"malformed", "id", "v", "m", "tags", "u v"}
    ids = {(r[0], r[1]) for r in flat.select(documents.as_text(F.col("id")), documents.type_name(F.col("id"))).collect()}
    assert ids == {("1", "BIGINT"), ("p2", "STRING"), ("3", "BIGINT"), ("9007199254740993", "BIGINT")}
    assert {documents_row["u v"] for documents_row in flat.collect()} == {None, "w"}
    types = {(r["field"], r["type"], r["documents"]) for r in documents.field_types(docs).collect()}
    assert {("m.b", "STRING", 1), ("m.b", "BIGINT", 1), ("m.c", "VOID", 1), ("tags", "ARRAY", 1), ("id", "BIGINT", 3)} <= types
    documents.write_documents(docs, f"{tmp_path}/again")
    again = documents.read_documents(spark, f"{tmp_path}/again")
    text = lambda d: sorted(r[0] for r in d.where("doc IS NOT NULL").select(F.to_json("doc")).collect())
    assert text(again) == text(docs)
    mixed = documents.flattened(docs)
    assert set(mixed.columns) == {"doc", "malformed"} or "id" in mixed.columns


def test_empty_collection(spark):
    none = documents.parse_documents(spark.createDataFrame([], "value string"), "value")
    assert documents.found_schema(none) == "STRUCT<>" and documents.flattened(none).columns == ["value", "malformed"]
    assert documents.field_types(none).count() == 0
