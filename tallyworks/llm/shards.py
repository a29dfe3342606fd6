"""Even shards through fixed virtual slots and a versioned map.

A record's slot is a hash of its doc_id modulo a fixed number of slots (of its text, where it has
no doc_id), so it never changes. Bytes are summed per slot, and a table (version, slot, shard)
says where each slot lives: the first version fills the shards evenly, heaviest
slot first; a later version moves as few slots as level the shards again. The
map has one row per slot, whatever the number of documents.

Defined results: a null text has no bytes, so its size is the constant overhead
alone; rows without doc_id lie where their texts put them; rows that share a doc_id, repeated ones too,
share a slot and follow each other in the shard; equal texts under different doc_ids lie where their
doc_ids put them (a group of copies may be a third of all rows, and the law is that of bytes), and
``text_crc32`` brings them together; an empty table gives no rows and an even map; other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import materialize

SLOTS = 8192
_MAP = "version long, slot long, shard int"


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, slot): size is the UTF-8 bytes of the text plus 16."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64(F.col("doc_id").cast("long"))),
               F.lit(slots)).alias("slot"))


def slot_sizes(records: DataFrame) -> dict[int, int]:
    """Bytes per slot; at most one driver row per slot."""
    return {r["slot"]: r["size"] for r in records.groupBy("slot").agg(F.sum("size").alias("size")).collect()}


def first_map(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Heaviest slot first into the lightest shard; empty slots last, by number of slots."""
    place, load = {}, [(0, 0, s) for s in range(shards)]
    for slot in sorted(range(slots), key=lambda x: (-sizes.get(x, 0), x)):
        held, count, shard = heapq.heappop(load)
        place[slot] = shard
        heapq.heappush(load, (held + sizes.get(slot, 0), count + 1, shard))
    return place


def rebalanced(place: dict[int, int], sizes: dict[int, int], shards: int, slack: float = 0.01) -> dict[int, int]:
    """An edited map for ``shards`` shards: slots leave vanished shards and those
    above the mean by more than ``slack``, each going to the lightest shard."""
    new = dict(place)
    load = dict.fromkeys(range(shards), 0)
    for slot, shard in place.items():
        if shard < shards:
            load[shard] += sizes.get(slot, 0)
    mean = sum(sizes.values()) / shards
    own: dict[int, list[int]] = {}
    for slot, shard in sorted(place.items(), key=lambda x: (-sizes.get(x[0], 0), x[0])):
        own.setdefault(shard, []).append(slot)
    for shard, held in own.items():
        for slot in held:
            size, to = sizes.get(slot, 0), min(load, key=lambda s: (load[s], s))
            if shard >= shards or (load[shard] > mean * (1 + slack) and load[to] + size < load[shard]):
                new[slot] = to
                load[to] += size
                if shard < shards:
                    load[shard] -= size
    return new


def save_map(spark, place: dict[int, int], version: int, path: str) -> None:
    """Add a version of the map to the table at ``path``."""
    rows = [(version, slot, shard) for slot, shard in sorted(place.items())]
    spark.createDataFrame(rows, _MAP).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, the newest if none is named."""
    every = spark.read.schema(_MAP).parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version).select("slot", "shard")


def sharded(records: DataFrame, place: DataFrame) -> DataFrame:
    """Each record's shard and its place there, counted from 0.

    Places are numbered within a slot (a hash bucket, alike for all slots) and
    shifted by the records of the shard's earlier slots, at most one row per slot.
    """
    met = materialize(records.join(F.broadcast(place), "slot"), "sharded")
    counts = met.groupBy("shard", "slot").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("slot").orderBy("doc_id", "text_crc32")
    return met.withColumn("place", F.row_number().over(within)).join(F.broadcast(starts), "slot").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place") - 1).cast("long").alias("place"),
        F.col("slot").alias("virtual_slot"))


def shard_table(docs: DataFrame, path: str, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Shards of near equal bytes; the first version of the map is stored at ``path``."""
    records = with_slots(docs, slots)
    save_map(docs.sparkSession, first_map(slot_sizes(records), shards, slots), 1, path)
    return sharded(records, load_map(docs.sparkSession, path, 1)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
