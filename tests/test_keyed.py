"""Keyed table: versions, touched buckets, failed and concurrent writers, odd batches."""

import pytest
from pyspark.sql import functions as F

from tallyworks.session import file_system
from tallyworks.sources.keyed import BUCKET, KeyedTable, VersionConflict, newest_per_key

SCHEMA = "k long, a string, b double"


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("a"), "id").alias("a"), F.lit(1.0).alias("b"))
    return KeyedTable.create(rows, f"{tmp_path}/t", "k", buckets=40)


def held(table, version=None):
    return {r["k"]: (r["a"], r["b"]) for r in table.read(version).collect()}


def files_of(table):
    place, system = file_system(table.spark, f"{table.path}/rows")
    found, names = system.listFiles(place, True), {}
    while found.hasNext():
        f = found.next()
        if f.getPath().getName().endswith(".parquet"):
            names[f.getPath().toString()] = f.getLen()
    return names


def test_update_rewrites_only_touched_buckets(spark, table):
    before = files_of(table)
    batch = spark.createDataFrame([(7, "x", 9.0), (8, "y", 8.0), (5000, "z", 7.0)], SCHEMA)
    touched = {r[0] for r in batch.where("k < 400").select(table._bucket(F.col("k"))).collect()}
    assert table.update(batch, ["b"]) == 1
    new = {f: n for f, n in files_of(table).items() if f not in before}
    folders = {f.split(f"{BUCKET}=")[1].split("/")[0] for f in new}
    assert touched <= {int(x) for x in folders} and len(new) <= 3
    assert sum(new.values()) < sum(before.values()) / 5
    want = {k: (f"a{k}", {7: 9.0, 8: 8.0}.get(k, 1.0)) for k in range(400)}
    assert held(table) == want
    assert held(table, 0) == {k: (f"a{k}", 1.0) for k in range(400)}


def test_nulls_inserts_and_repeated_keys(spark, table):
    batch = spark.createDataFrame([(1, None, 2.0, 1), (1, None, 3.0, 2), (900, "new", None, 1), (None, "no key", 1.0, 9)],
                                  SCHEMA + ", at int")
    table.append(batch, order=["at"])
    got = held(table)
    assert len(got) == 401 and got[1] == (None, 3.0) and got[900] == ("new", None) and got[2] == ("a2", 1.0)
    table.update(spark.createDataFrame([(900, "late"), (901, "absent")], "k long, a string"), ["a"])
    assert held(table)[900] == ("late", None) and 901 not in held(table)


def test_a_key_that_a_batch_repeats_is_combined_before_the_shuffle(spark):
    batch = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = newest_per_key(batch, "k", ["v"])
    assert got.count() == batch.select("k").distinct().count()
    assert got.where("k = 5").first()["v"] == 19_998
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") >= 2 and "Window" not in plan


def test_failed_writer_leaves_the_old_version(spark, table):
    broken = spark.createDataFrame([(3, "x", 1.0)], SCHEMA).withColumn(
        "b", F.when(F.col("k") == 3, F.raise_error("writer fails").cast("double")).otherwise(F.col("b")))
    with pytest.raises(Exception, match="writer fails"):
        table.update(broken, ["b"])
    assert table.versions() == [0] and held(table)[3] == ("a3", 1.0)
    table.update(spark.createDataFrame([(3, "x", 4.0)], SCHEMA), ["b"])
    assert held(table)[3] == ("a3", 4.0)


def test_second_writer_of_a_version_is_refused(spark, table):
    first = KeyedTable(spark, table.path)
    manifest = first._manifest(0)
    table.update(spark.createDataFrame([(3, "x", 4.0)], SCHEMA), ["b"])
    with pytest.raises(VersionConflict):
        first._commit(1, manifest["buckets"])
    assert held(table)[3] == ("a3", 4.0)


def test_reader_of_an_old_version_is_not_disturbed_until_vacuum(spark, table):
    old = table.read()
    table.update(spark.createDataFrame([(3, "x", 4.0)], SCHEMA), ["b"])
    assert {r["k"]: r["b"] for r in old.collect()}[3] == 1.0
    n = len(files_of(table))
    assert table.vacuum(keep=1) == 1 and len(files_of(table)) == n - 1
    assert table.versions() == [1] and held(KeyedTable(spark, table.path))[3] == ("a3", 4.0)


def test_lookup_opens_the_buckets_of_its_keys(spark, table):
    got = table.lookup([3, 77, 5000])
    assert {r["k"] for r in got.collect()} == {3, 77}
    assert len(got.inputFiles()) <= 3


def test_empty_tables_and_batches(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    table = KeyedTable.create(none, f"{tmp_path}/e", "k")
    assert table.read().count() == 0
    assert table.update(none, ["b"]) == 1 and table.read().count() == 0
    table.append(spark.createDataFrame([(1, "a", None)], SCHEMA))
    assert held(table) == {1: ("a", None)}
