"""Models by property: better than the mean, complete, repeatable."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyworks.operators import evaluation, features, learners
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def points(spark):
    x, y = (F.col("id") * 7919) % 101, (F.col("id") * 104729) % 97
    rows = spark.range(600).select("id", x.cast("double").alias("x"), y.cast("double").alias("y"))
    labelled = rows.withColumn("label", 3 * F.col("x") - 2 * F.col("y") + F.col("x") * F.col("y") / 10)
    return features.assemble(labelled, ["x", "y"]).cache()


def test_split_is_whole_and_repeatable(points):
    train, test = learners.split(points, "id")
    assert train.count() + test.count() == points.count()
    assert 0.7 < train.count() / points.count() < 0.9
    assert train.select("id").intersect(test.select("id")).count() == 0
    again, _ = learners.split(points.repartition(7), "id")
    assert again.select("id").exceptAll(train.select("id")).count() == 0


@pytest.mark.parametrize("learner", [
    lambda: learners.forest("label", depth=8, trees=5), lambda: learners.tree("label", depth=8),
    lambda: learners.boosted("label", rounds=10, step=0.3, depth=4, columns="all"),
    lambda: learners.lasso("label", [0.1, 1.0])], ids=["forest", "tree", "boosted", "lasso"])
def test_regressors_beat_the_mean(points, learner):
    train, test = learners.split(points, "id")
    found = evaluation.measures(learner().fit(train).transform(test), "label").first()
    assert found["r2"] > 0.5 and found["mse"] > 0


def test_out_of_fold_covers_every_row_once(points):
    scored = learners.out_of_fold(points.select("id", "features", "label"), "id", learners.tree("label", depth=6))
    assert scored.count() == scored.select("id").distinct().count() == points.count()
    assert scored.where("ensemble is null").count() == 0


def test_importances(spark, points):
    model = learners.tree("label", depth=6).fit(points)
    found = {r["feature"]: r["importance"] for r in learners.importances(model, ["x", "y"], points).collect()}
    assert set(found) == {"x", "y"} and abs(sum(found.values()) - 1) < 1e-9
    table = learners.importances(model, ["x", "y"], points)
    assert features.important_features(table, max(found.values())).count() == 1


def test_quadratic_terms_have_no_constant(points):
    row = features.quadratic_terms(points.select("features", "x", "y")).first()
    x, y = row["x"], row["y"]
    assert list(row["terms"]) == [x, x * x, y, x * y, y * y]


def test_clusters_number(spark):
    found = entry.queries()["l08_kmeans"](spark, SMALL)
    assert found.select("cluster").distinct().count() <= 8 and found.count() == 500


def test_negative_only_when_larger(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense(p),) for p in ([0.5, 0.5], [0.6, 0.4], [0.4, 0.6])], ["probability"])
    assert [r["sentiment"] for r in learners.two_class_label(df).collect()] == ["positive", "negative", "positive"]


def test_callers_model_scores_texts(spark):
    def load():
        return lambda texts: [(float("bad" in t), float("bad" not in t)) for t in texts]
    df = spark.createDataFrame([("bad day",), ("fine",), ("",)], "text string")
    got = {r["text"]: r["sentiment"] for r in learners.score_texts(df, "text", load).collect()}
    assert got == {"bad day": "negative", "fine": "positive", "": "positive"}


@pytest.mark.parametrize("rows", [10**6, 150])
def test_forest_grown_in_tasks(points, monkeypatch, rows):
    """Above a number of rows no tree comes to the driver; cut or not, it predicts about as Spark's forest does."""
    train, test = learners.split(points, "id")
    estimator = learners.forest("label", depth=8, trees=10)
    spark_r2 = evaluation.measures(estimator.fit(train).transform(test), "label").first()["r2"]
    monkeypatch.setattr(learners, "FOREST_ROWS", 0)
    monkeypatch.setattr(learners.forests, "TASK_ROWS", rows)
    monkeypatch.setattr(type(estimator), "fit", lambda *_: pytest.fail("fitted on the driver"))
    got = learners.forest_predicted(train, test, estimator)
    assert got.columns == [*test.columns, "prediction"]
    assert got.count() == test.count() == got.select("id").distinct().count()
    found = evaluation.measures(got, "label").first()
    assert found["r2"] > 0.5 and abs(found["r2"] - spark_r2) < 0.1
    again = evaluation.measures(learners.forest_predicted(train, test, estimator), "label").first()
    assert again["mse"] == pytest.approx(found["mse"])


def test_deep_tree_of_distinct_points_repeats_its_rows(points, monkeypatch):
    """With depth and trees enough, the rows that were learned are predicted closely."""
    monkeypatch.setattr(learners, "FOREST_ROWS", 0)
    got = learners.forest_predicted(points, points, learners.forest("label", depth=20, trees=20))
    assert evaluation.measures(got, "label").first()["r2"] > 0.97
