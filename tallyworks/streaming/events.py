"""Event streams: views and visitors per window, repeated rows, scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import sketches
from tallyworks.session import file_system, fresh_path
from tallyworks.sources.keyed import KeyedTable


def read_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream.

    The last letter stands in brackets, which makes the path a pattern: a plain path
    of a stream has to be a folder.
    """
    path = path.rstrip("/")
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def with_time(events: DataFrame, column: str = "ts") -> DataFrame:
    """Event time as an instant, which watermarks need."""
    return events.withColumn(column, F.col(column).cast("timestamp"))


def page_views(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Events per tumbling window."""
    return (events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"))
            .agg(F.count(F.lit(1)).alias("views")))


def first_seen(events: DataFrame, keys: Sequence[str], width: str = "1 day", late: str = "1 day") -> DataFrame:
    """One row per key and window with the time it was first seen.

    A streaming aggregate combines rows before its shuffle, so a key that
    repeats very often is a few rows per task there; ``dropDuplicates`` would
    send every repeat to one task. The watermark lets old windows go.
    """
    return (events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), *keys)
            .agg(F.min("ts").alias("first_seen")))


def unique_visitors(seen: DataFrame) -> DataFrame:
    """Distinct users per window of a ``first_seen`` table."""
    return seen.groupBy("w").agg(F.countDistinct("user_id").alias("visitors"))


def discard_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in a static table."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


def class_counts(events: DataFrame, model: Model) -> DataFrame:
    """Predicted classes of a stream and how often each came up."""
    return model.transform(events).groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))


def seen_once(events: DataFrame, keys: Sequence[str], late: str = "1 day") -> DataFrame:
    """(keys, ts) of the first row of each key, given out once, with state that ends.

    A key is held until the watermark passes its row by ``late``. Rows older than the watermark that the
    batch before worked with are late and left out; a key comes twice only if its rows lie more than ``late`` apart. With a
    day among the keys and ``late`` of a day or more, each key comes once.

    Rows of a key that arrive together are combined in their task first (per Arrow batch), so
    a key that repeats very often does not send its rows to one task.
    """
    given = events.select(*keys, "ts")

    def combined(batches):
        for batch in batches:
            first = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([("ts", "min")])
            yield from first.rename_columns([*keys, "ts"]).select(batch.schema.names).cast(batch.schema).to_batches()
    return given.mapInArrow(combined, given.schema).withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))


class SketchTable:
    """Distinct numbers per window, as sketches in a keyed table that a stream's batches update.

    A batch is one sketch per window it has rows of; only those windows' sketches are read,
    merged and rewritten, whether the batch is on time or late. Merging is idempotent, so a
    batch that runs again after a failure changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "day", kind: str = "date", lg_k: int = 12):
        self.lg_k, self.key = lg_k, key
        try:
            self.table = KeyedTable(spark, path)
        except FileNotFoundError:
            none = spark.createDataFrame([], f"{key} {kind}, sketch binary")
            self.table = KeyedTable.create(none, path, key, buckets=8)

    def merge(self, rows: DataFrame, column: str) -> None:
        fresh = sketches.distinct_sketches(rows.where(F.col(self.key).isNotNull()), [self.key], column, self.lg_k)
        windows = [r[0] for r in fresh.select(self.key).collect()]
        if windows:
            both = fresh.unionByName(self.table.lookup(windows))
            self.table.append(sketches.merged_sketches(both, [self.key]))

    def estimates(self, to: str = "distinct") -> DataFrame:
        return sketches.distinct_estimates(self.table.read(), to=to)


def run_batches(stream: DataFrame, each: Callable[[DataFrame], None], folder: str | None = None) -> None:
    """Give every micro-batch of what the source holds to ``each``; ``folder`` as in ``run_to_table``."""
    folder = folder or fresh_path(stream.sparkSession, "stream")
    query = (stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/state")
             .foreachBatch(lambda batch, number: each(batch)).start())
    query.awaitTermination()


def run_to_table(stream: DataFrame, mode: str, each: Callable[[DataFrame], DataFrame] | None = None,
                 folder: str | None = None) -> DataFrame:
    """Work off what the source holds and return the result as a table.

    With a ``folder`` a later run goes on where the last one stopped, whether
    it ended or failed; without one each run starts anew.

    Each batch is stored under its number, so a batch that runs again after a
    failure replaces its own rows and no other's. The table is the newest batch
    for ``complete``, all batches otherwise; a source without rows gives an empty one.
    Its ``progress`` lists what Spark reports of each batch of this run.
    """
    spark = stream.sparkSession
    folder = folder or fresh_path(spark, "stream")
    state, out = f"{folder}/state", f"{folder}/out"
    none = spark.createDataFrame([], stream.schema)
    schema = (each(none) if each else none).schema

    def store(batch: DataFrame, number: int) -> None:
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (stream.writeStream.outputMode(mode).trigger(availableNow=True)
             .option("checkpointLocation", state).foreachBatch(store).start())
    query.awaitTermination()
    place, system = file_system(spark, out)
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    batches = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    if mode == "complete":
        batches = batches[-1:]
    table = spark.read.schema(schema).parquet(*[f"{out}/batch={n}" for n in batches]) if batches else spark.createDataFrame([], schema)
    table.progress = query.recentProgress
    return table
