"""A stored table with one row per key, updated in place by versions.

Rows lie in buckets of the key's hash. A version is a manifest: for each bucket, the
folder that holds its rows. An update reads and rewrites only the buckets that its keys
fall into and then puts the next manifest in place; buckets without an updated key are
taken over by name. Readers open one manifest and see that version whole, before, during
and after later updates. A writer that fails leaves no manifest, so its files belong to no
version; two writers of the same version race for the manifest's name and the second
one gets ``VersionConflict``. ``vacuum`` deletes what no kept version names.

    <path>/versions/00000007.json   {"buckets": [...folder or null per bucket...], ...}
    <path>/rows/<write>/bucket=<b>/*.parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import file_system

BUCKET = "__bucket"


class VersionConflict(RuntimeError):
    """Another writer has put the next version in place."""


def newest_per_key(batch: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the highest ``order`` columns, ties by all columns. Rows without a key drop out.

    Combined before the shuffle, so a key that a batch repeats very often is a row per task.
    """
    rest = [c for c in batch.columns if c != key]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    top = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(rank).alias("__top"))
    return top.select(*[F.col(key) if c == key else F.col(f"__top.{c}").alias(c) for c in batch.columns])


class KeyedTable:
    """A keyed table under ``path``; ``create`` makes one, ``KeyedTable(spark, path)`` opens one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        first = self._manifest(min(self.versions()))
        self.key, self.buckets, self.schema = first["key"], len(first["buckets"]), first["schema"]

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str, buckets: int | None = None,
               rows_per_bucket: int = 1_000_000) -> KeyedTable:
        """Version 0 from ``rows``, which have distinct keys that are not null."""
        table = cls.__new__(cls)
        table.spark, table.path, table.key = rows.sparkSession, path.rstrip("/"), key
        table.buckets = buckets or max(8, -(-rows.count() // rows_per_bucket))
        table.schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        folders = table._write(rows.withColumn(BUCKET, table._bucket(F.col(key))))
        table._commit(0, [folders.get(b) for b in range(table.buckets)])
        return table

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # versions

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/{version:08d}.json"

    def versions(self) -> list[int]:
        place, system = file_system(self.spark, f"{self.path}/versions")
        names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
        found = sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))
        if not found:
            raise FileNotFoundError(f"no keyed table under {self.path}")
        return found

    def version(self) -> int:
        return self.versions()[-1]

    def _manifest(self, version: int) -> dict:
        place, system = file_system(self.spark, self._file(version))
        stream = system.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _commit(self, version: int, folders: list[str | None]) -> None:
        """Put a manifest in place under a name that nobody has taken: written aside, then renamed."""
        place, system = file_system(self.spark, self._file(version))
        aside, _ = file_system(self.spark, f"{self.path}/versions/.{uuid.uuid4().hex}")
        text = json.dumps({"version": version, "key": self.key, "schema": self.schema, "buckets": folders})
        stream = system.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if system.exists(place) or not system.rename(aside, place):
            system.delete(aside, False)
            raise VersionConflict(f"version {version} of {self.path} is already there")

    # rows

    def _write(self, rows: DataFrame) -> dict[int, str]:
        """Write rows by bucket; bucket -> folder. One task writes a bucket's file."""
        folder = f"rows/{uuid.uuid4().hex}"
        rows.repartition(BUCKET).sortWithinPartitions(BUCKET, self.key).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        place, system = file_system(self.spark, f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in system.listStatus(place)]
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def _open(self, folders: Sequence[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the newest by default."""
        manifest = self._manifest(self.version() if version is None else version)
        return self._open([f for f in manifest["buckets"] if f])

    def lookup(self, keys: Sequence) -> DataFrame:
        """Rows of a few keys; only their buckets are opened, and row groups by their sorted keys."""
        manifest = self._manifest(self.version())
        asked = self.spark.createDataFrame([(k,) for k in keys], self._open([]).select(self.key).schema)
        hit = {r[0] for r in asked.select(self._bucket(F.col(self.key))).distinct().collect()}
        return self._open([manifest["buckets"][b] for b in sorted(hit) if manifest["buckets"][b]]).where(
            F.col(self.key).isin(list(keys)))

    # updates

    def update(self, batch: DataFrame, columns: Sequence[str], order: Sequence[str] = (), insert: bool = False) -> int:
        """Set ``columns`` of the rows whose keys the batch has, nulls included; the new version's number.

        Of rows of one key the one with the highest ``order`` counts. Keys that the table lacks
        are left out, or added with ``insert`` (other columns null unless the batch has them).
        """
        old_version = self.version()
        manifest = self._manifest(old_version)
        own = [c for c in self._open([]).columns if c in batch.columns and (insert or c in columns)]
        fresh = newest_per_key(batch.select(*dict.fromkeys([self.key, *own, *order])), self.key, order).withColumn(
            BUCKET, self._bucket(F.col(self.key)))
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        old = self._open([manifest["buckets"][b] for b in touched if manifest["buckets"][b]])
        given = [c for c in fresh.columns if c not in (self.key, BUCKET)]
        new = fresh.select(self.key, F.struct(F.lit(True).alias("__set"), *given).alias("__n"))
        met = old.withColumn("__old", F.lit(True)).join(new, self.key, "full" if insert else "left")
        is_new, is_old = F.col("__n").isNotNull(), F.col("__old").isNotNull()

        def value(c: str) -> Column:
            if c == self.key:
                return F.col(c)
            if c not in given:
                return F.col(c)
            set_here = is_new if c in columns else is_new & ~is_old
            return F.when(set_here, F.col(f"__n.{c}")).otherwise(F.col(c)).alias(c)
        rows = met.select(*[value(c) for c in old.columns]).withColumn(BUCKET, self._bucket(F.col(self.key)))
        written = self._write(rows) if touched else {}
        folders = [written.get(b) if b in set(touched) else f for b, f in enumerate(manifest["buckets"])]
        self._commit(old_version + 1, folders)
        return old_version + 1

    def append(self, batch: DataFrame, order: Sequence[str] = ()) -> int:
        """Rows of new keys are added, rows of known keys replaced whole."""
        return self.update(batch, [c for c in self._open([]).columns if c != self.key], order, insert=True)

    def vacuum(self, keep: int = 1) -> int:
        """Delete all versions but the newest ``keep``, and the folders that those left do not name."""
        kept = self.versions()[-keep:]
        named = {f for v in kept for f in self._manifest(v)["buckets"] if f}
        for v in self.versions():
            if v not in kept:
                place, system = file_system(self.spark, self._file(v))
                system.delete(place, False)
        gone = 0
        root, system = file_system(self.spark, f"{self.path}/rows")
        for write in system.listStatus(root):
            for folder in system.listStatus(write.getPath()):
                name = f"rows/{write.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and name not in named:
                    gone += bool(system.delete(folder.getPath(), True))
        return gone
