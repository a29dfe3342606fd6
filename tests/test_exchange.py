"""Files, replies, pages, saved models and streams."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tallyworks import session
from tallyworks.operators import words
from tallyworks.sources import files, models, pages
from tallyworks.streaming import events as streams


def texts(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("encoding,value", [("GBK", "未上牌, \"级别\""), ("windows-1252", "Fuß – café €"), ("UTF-8", "级别")])
def test_csv_encodings(spark, tmp_path, encoding, value):
    df = spark.createDataFrame([(1, value), (2, None)], "id int, c string")
    files.write_csv(df, f"{tmp_path}/t", encoding=encoding)
    assert texts(files.read_csv(spark, f"{tmp_path}/t", "id int, c string", encoding=encoding)) == [(1, value), (2, None)]


def test_every_file_has_its_header_skipped(spark, tmp_path):
    files.write_csv(spark.range(20).repartition(4), f"{tmp_path}/t")
    assert texts(files.read_csv(spark, f"{tmp_path}/t", "id bigint")) == [(i,) for i in range(20)]


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "n")], "x int, note string")
    assert sorted(map(str, files.union_tables([a, b]).collect())) == sorted(
        ["Row(x=1, note=None)", "Row(x=2, note='n')"])


def test_append_adds_rows(spark, tmp_path):
    for _ in range(2):
        files.append(spark.range(3), f"{tmp_path}/t")
    assert files.load(spark, f"{tmp_path}/t").count() == 6


def test_flatten_marks_malformed_replies(spark):
    df = spark.createDataFrame([(1, '{"data": {"stat": {"view": 7}}}'), (2, "<html>"), (3, None)], "id int, r string")
    got = pages.flatten_json(df, "r", "data struct<stat: struct<view: int>>", {"view": "data.stat.view"})
    assert {(r["id"], r["view"], r["parsed"]) for r in got.collect()} == {(1, 7, True), (2, None, False), (3, None, False)}


def test_missing_html_field_is_null(spark):
    df = spark.createDataFrame([(1, '<title>A</title><a href="/x"></a><a href="/y"></a>'), (2, "<p>")], "id int, h string")
    got = pages.html_fields(df, "h", {"title": "<title>([^<]*)</title>"})
    assert {(r["id"], r["title"]) for r in got.collect()} == {(1, "A"), (2, None)}
    assert texts(pages.links(df, "h")) == [(1, 0, "/x"), (1, 1, "/y")]


def test_saved_text_model(spark, tmp_path):
    df = spark.createDataFrame([(1, "x y"), (2, "x z")], "id int, t string")
    weights, idf = words.text_weights(df, "id", "t")
    models.save_text_model(weights, "id", idf, f"{tmp_path}/m")
    index = models.load_text_model(spark, f"{tmp_path}/m")
    assert texts(index.weights()) == texts(weights) and texts(index.vocabulary()) == texts(idf)


def test_saved_pipeline(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from tallyworks.operators import learners
    df = spark.range(50).selectExpr("double(id) as x", "double(id % 7) as y", "double(id * 2) as label")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x", "y"], outputCol="features"),
                             learners.tree("label", depth=4)]).fit(df)
    models.save_fitted(model, ["x", "y"], f"{tmp_path}/m", spark)
    again, names = models.load_fitted(spark, f"{tmp_path}/m")
    assert names == ["x", "y"]
    assert texts(again.transform(df).select("x", "prediction")) == texts(model.transform(df).select("x", "prediction"))


def test_shared_folder_is_the_named_one(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return "/shared/work/" if name == "spark.checkpoint.dir" else default

    class Context:
        master, applicationId = "yarn", "app-1"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    assert session.shared_dir(Session()) == "/shared/work/tallyworks/app-1"
    Conf.get = lambda self, name, default=None: default
    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


@pytest.fixture(scope="module")
def event_folder(spark, tmp_path_factory):
    """Three files in time order; one user makes most of the events."""
    folder = str(tmp_path_factory.mktemp("events"))
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = spark.range(3000).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(hours=F.col("id").cast("int") / 20)).alias("ts"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 40).cast("bigint").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "view").otherwise("click").alias("event_type"))
    for i in range(3):
        part = rows.where(F.expr(f"event_id div 1000 = {i}")).coalesce(1)
        part.write.mode("append").parquet(folder)
    return folder


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, folder = f"{tmp_path}/in", f"{tmp_path}/run"
    rows = spark.range(300).select((F.lit("2024-01-01").cast("timestamp_ntz")
                                    + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"),
                                   (F.col("id") % 7).alias("user_id"))
    for part in range(2):
        rows.where(F.hour("ts") % 2 == part).write.mode("append").parquet(source)
        stream = streams.with_time(streams.read_stream(spark, source, rows.schema))
        seen = streams.run_to_table(streams.first_seen(stream, ["user_id"], "1 hour", "1 day"), "update", folder=folder)
    hours = F.date_trunc("hour", "ts")
    assert texts(streams.unique_visitors(seen).select("visitors")) == texts(
        rows.groupBy(hours.alias("h")).agg(F.countDistinct("user_id").alias("n")).select("n"))
    assert seen.count() == rows.select(hours, "user_id").distinct().count()


def test_stream_equals_batch(spark, event_folder):
    batch = spark.read.parquet(event_folder)
    stream = streams.with_time(
        streams.read_stream(spark, event_folder, batch.schema))
    day = F.to_date("ts").alias("day")
    started = F.col("w.start").cast("timestamp_ntz").cast("date").alias("day")

    views = streams.run_to_table(streams.page_views(stream), "complete").select(started, "views")
    assert texts(views) == texts(batch.groupBy(day).agg(F.count(F.lit(1)).alias("views")))

    seen = streams.run_to_table(streams.first_seen(stream, ["user_id"]), "update")
    visitors = streams.unique_visitors(seen).select(started, "visitors")
    assert texts(visitors) == texts(batch.groupBy(day).agg(F.countDistinct("user_id").alias("v")))

    known = batch.where("user_id = 1")
    kept = streams.run_to_table(streams.first_seen(stream, ["user_id", "event_type"]), "update",
                                lambda b: streams.discard_known(b, known, "user_id"))
    got = kept.select("user_id", "event_type", started).distinct()
    assert texts(got) == texts(batch.where("user_id <> 1").select("user_id", "event_type", day).distinct())


@pytest.mark.parametrize("name", ["n01_stream_page_views", "n02_stream_unique_visitors", "n05_score_stream",
                                  "n07_discard_repeats"])
def test_streams_of_a_table_folder(spark, tmp_path, name):
    """The events table as a folder of three part files gives what the single file gives."""
    import __spark_entry__ as entry

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    run = entry.queries()[name]
    assert sorted(map(str, run(spark, str(tmp_path)).collect())) == sorted(map(str, run(spark, SMALL).collect()))
    empty = tmp_path / "none"
    events.limit(0).write.parquet(str(empty / "events.parquet"))
    if name != "n05_score_stream":
        assert run(spark, str(empty)).count() == 0


def test_missing_fields_are_not_malformed(spark):
    texts = ['{"data": {"stat": {}}}', '{"data": {"stat": {"view": null}}}', "{}", "<html>", None, '{"data": 3}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, r string")
    got = pages.flatten_json(df, "r", "data struct<stat: struct<view: int>>", {"view": "data.stat.view"})
    assert [r["parsed"] for r in got.orderBy("i").collect()] == [True, True, True, False, False, False]
    assert tuple(pages.malformed_count(got).first()) == (6, 3)
