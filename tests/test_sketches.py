"""Stored sketches, exact heavy hitters, and a stream whose state ends."""

import datetime as dt
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import sketches
from tallyworks.streaming import events as streams


def test_merged_sketches_stay_in_the_stated_bound(spark):
    rows = spark.range(200_000).select((F.col("id") % 5).alias("g"), (F.col("id") % 40_009).alias("v"), (F.col("id") % 7).alias("day"))
    stored = sketches.distinct_sketches(rows, ["g", "day"], "v")
    by_group = sketches.distinct_estimates(sketches.merged_sketches(stored, ["g"])).collect()
    exact = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.countDistinct("v").alias("n")).collect()}
    assert all(abs(r["distinct"] - exact[r["g"]]) <= sketches.distinct_bound() * exact[r["g"]] for r in by_group)
    whole = sketches.distinct_estimates(sketches.merged_sketches(stored)).first()["distinct"]
    assert abs(whole - 40_009) <= sketches.distinct_bound() * 40_009
    small = sketches.distinct_sketches(spark.createDataFrame([(1,), (None,), (1,), (2,)], "v long"), [], "v")
    assert sketches.distinct_estimates(small).first()["distinct"] == 2


def test_late_batch_changes_its_own_window_only(spark, tmp_path):
    table = streams.SketchTable(spark, f"{tmp_path}/s")
    day = lambda n: dt.date(2024, 1, n)
    schema = "day date, user_id long"
    table.merge(spark.createDataFrame([(day(1), 1), (day(1), 2), (day(2), 1)], schema), "user_id")
    before = {r["day"]: bytes(r["sketch"]) for r in table.table.read().collect()}
    late = spark.createDataFrame([(day(1), 2), (day(1), 3), (None, 9)], schema)
    table.merge(late, "user_id")
    table.merge(late, "user_id")
    after = {r["day"]: bytes(r["sketch"]) for r in table.table.read().collect()}
    assert after[day(2)] == before[day(2)] and after[day(1)] != before[day(1)]
    again = streams.SketchTable(spark, f"{tmp_path}/s")
    assert {r["day"]: r["distinct"] for r in again.estimates().collect()} == {day(1): 3, day(2): 1}


@pytest.mark.parametrize("tracked", [10, 10_000])
def test_most_frequent_values_are_exact(spark, tracked):
    """A value with a third of the rows, many ties at the edge, a group with few values."""
    given = [("a", 5)] * 300 + [("a", 10 + k % 60) for k in range(600)] + [("b", k) for k in (3, 3, 4)] + [("b", None)]
    rows = spark.createDataFrame(given, "g string, v long").withColumn("day", F.monotonically_increasing_id() % 3)
    got = sorted((r["g"], r["rank"], r["v"], r["count"]) for r in sketches.most_frequent(rows, "g", "v", 4, ["day"], tracked).collect())
    want = []
    for g in "ab":
        ordered = sorted(Counter(v for x, v in given if x == g and v is not None).items(), key=lambda x: (-x[1], x[0]))
        want += [(g, k, v, n) for k, (v, n) in enumerate(ordered[:4], 1)]
    assert got == want


def test_state_too_small_is_not_called_sure(spark):
    rows = spark.range(40_000).select(F.lit("a").alias("g"), (F.col("id") % 9_000).alias("v"))
    states = sketches.top_states(rows, ["g"], "v", 20)
    assert not sketches.exact_top(rows, states, "g", "v", 5, 20)[1]
    assert [r["v"] for r in sketches.most_frequent(rows, "g", "v", 5, tracked=20).orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_no_rows(spark):
    none = spark.createDataFrame([], "g string, v long")
    assert sketches.most_frequent(none, "g", "v", 3).count() == 0
    assert sketches.distinct_sketches(none, ["g"], "v").count() == 0


def test_each_key_leaves_once_and_state_ends(spark, tmp_path):
    """Three micro-batches with repeats within and over batches, and a late row."""
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    batches = [[(1, at(1, 3)), (1, at(1, 5)), (2, at(2, 4))] + [(7, at(2, 6))] * 50,
               [(2, at(2, 9)), (1, at(2, 8)), (3, at(8, 1)), (7, at(2, 7))],
               [(3, at(8, 2)), (9, at(3, 1)), (9, at(1, 2)), (4, at(20, 1)), (2, at(8, 5))]]
    folder = f"{tmp_path}/in"
    for rows in batches:
        spark.createDataFrame(rows, "user_id long, ts timestamp").withColumn("day", F.to_date("ts")).coalesce(1).write.mode(
            "append").parquet(folder)
        time.sleep(1.1)
    stream = spark.readStream.schema("user_id long, ts timestamp, day date").option("maxFilesPerTrigger", 1).parquet(folder)
    table = streams.run_to_table(streams.seen_once(stream, ["user_id", "day"]), "append")
    got = sorted((r["user_id"], r["day"].day) for r in table.collect())
    marks, seen, want = [dt.datetime.min] * 2, {}, []
    for rows in batches:
        for user, ts in rows:
            if ts > marks[-2] and (user, ts.day) not in seen:
                seen[user, ts.day] = ts
                want.append((user, ts.day))
        marks.append(max([marks[-1], *[ts - dt.timedelta(days=1) for _, ts in rows]]))
    assert got == sorted(want) and (9, 1) not in got
    held = [p["stateOperators"][0]["numRowsTotal"] for p in table.progress if p["stateOperators"]]
    assert max(held) >= 4 and held[-1] == 1


def test_stream_of_an_empty_folder_gives_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "user_id long, ts timestamp, day date").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("user_id long, ts timestamp, day date").parquet(f"{tmp_path}/in")
    table = streams.run_to_table(streams.seen_once(stream, ["user_id", "day"]), "append")
    assert table.count() == 0 and set(table.columns) == {"user_id", "ts", "day"}
