"""Readers and writers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import file_system


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str = ",",
             header: bool = True, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """CSV with a header row per file. Without a schema, types are inferred,
    which costs a pass over the data."""
    if encoding.lower() not in ("utf-8", "iso-8859-1", "us-ascii"):
        # Other Java charsets (GBK, windows-1252) must be allowed first.
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    reader = reader.option("multiLine", multi_line).option("escape", '"')
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", mode: str = "error") -> None:
    if encoding.lower() not in ("utf-8", "iso-8859-1", "us-ascii"):
        df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
     .option("escape", '"').csv(path))


def spread(scan: DataFrame) -> DataFrame:
    """Give every core some rows when a scan has fewer splits than cores.

    Meant for texts, whose cutting costs far more than moving them once. A
    large table has more splits than cores and stays as it is. ``scan`` must
    be a scan with at most a projection: counting its splits runs no job then.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables under one another; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def load(spark: SparkSession, path: str, form: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(form).options(**options).load(path)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of every file under a path, in order of names."""
    place, system = file_system(spark, path)
    found, out = system.listFiles(place, True), []
    while found.hasNext():
        file = found.next()
        out.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(out)


def append(df: DataFrame, path: str, form: str = "parquet", **options: str) -> None:
    df.write.format(form).options(**options).mode("append").save(path)


def write_pairs(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Rows as separated text lines."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.text(path)


def write_libsvm(df: DataFrame, path: str, label: str, features: str) -> None:
    df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")) \
        .write.format("libsvm").save(path)


def keep_with_metric(df: DataFrame, metric: str, key: str) -> DataFrame:
    """Rows whose metric is known, under the key name the target store uses."""
    return df.where(F.col(metric).isNotNull()).withColumn("_id", F.col(key))
