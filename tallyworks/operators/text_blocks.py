"""Texts with their weighted words in blocks: one stored row for some thousand texts.

A block holds its distinct words once; its texts' words are places among them. So the words of
a block, not those of every text, meet the corpus-wide frequencies, and a word that stands in
many of its texts is one row wherever words are dealt out. Blocks are made inside tasks, of texts of
about the same number of words; texts are not moved for it. The functions that run in tasks are shipped
by value, as those of ``llm``.

A word's weight in a text is value * factor / length: how often it stands there, its
inverse frequency, and the length of the text's products.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.session import discard, free_shuffles, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words of a block, repeated ones included; texts of so many blocks are sorted by size together.
BLOCK_WORDS = 1 << 20
POOL = 4
# Blocks are numbered within a task, tasks within a size class (a power of two of the number of words).
_TASK, _CLASS = 20, 40
# Rows of a batch that leaves a task.
BATCH = 1 << 16
# Blocks are wide rows, so readers shall not get many of them at once.
WIDE = {"compression": "zstd", "parquet.block.size": 1 << 22, "parquet.page.size.row.check.min": 1}


def packed(values: np.ndarray) -> bytes:
    """Whole or broken numbers that differ little from one to the next, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0)) if values.dtype.kind == "i" else values
    return pa.compress(np.ascontiguousarray(steps).tobytes(), "zstd", asbytes=True) if len(values) else b""


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    steps = np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)
    return np.cumsum(steps, dtype=kind) if steps.dtype.kind == "i" else steps


def _one(values: pa.Array) -> pa.Array:
    """A column of one row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _pooled(parts: list) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """Keys, numbers of words, coded words and values of the texts of several batches that have words."""
    keys, sizes, words, values = [], [], [], []
    for key, lists, value in parts:
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().cast(pa.large_string())
        value = np.ones(len(flat)) if value is None else value.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if flat.null_count:
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            size = np.bincount(np.repeat(np.arange(len(size)), size)[known], minlength=len(size))
            flat, value = flat.drop_null(), value[known]
        full = size > 0
        keys.append(key.filter(pa.array(full)))
        sizes.append(size[full])
        words.append(flat)
        values.append(value)
    return pa.concat_arrays(keys), np.concatenate(sizes), pa.concat_arrays(words).dictionary_encode(), np.concatenate(values)


def counted(rows: DataFrame, texts: int) -> DataFrame:
    """Blocks of at most ``texts`` texts from (key, words) rows, or (key, words, values); a key has one row.

    ``held`` counts the texts of the block that have a word. Texts without words are left out.
    """
    kind = rows.schema[0].dataType.simpleString()
    most = BLOCK_WORDS

    def cut(parts: list, seen: Iterator[int]) -> Iterator[pa.RecordBatch]:
        keys, sizes, words, values = _pooled(parts)
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")
        total, at = np.cumsum(sizes[order]), 0
        while at < len(order):
            to = int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right"))
            some = order[at:min(max(to, at + 1), at + texts)]
            at += len(some)
            size = sizes[some]
            text = np.repeat(np.arange(len(some)), size)
            place = np.arange(len(text)) + np.repeat(starts[some] - (np.cumsum(size) - size), size)
            present = np.zeros(len(words.dictionary), bool)
            present[codes[place]] = True
            known = np.flatnonzero(present)
            cell, found = np.unique(text * len(known) + (np.cumsum(present) - 1)[codes[place]], return_inverse=True)
            text, code = np.divmod(cell, len(known))
            block = (int(size[-1]).bit_length() - 1 << _CLASS) + (TaskContext.get().partitionId() << _TASK) + next(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([block]), _one(words.dictionary.take(pa.array(known)).cast(pa.string())),
                _one(pa.array(np.bincount(code, minlength=len(known)).astype(np.int32))), _one(keys.take(pa.array(some))),
                pa.array([len(cell)]), pa.array([packed(np.searchsorted(text, np.arange(len(some) + 1)).astype(np.int32))]),
                pa.array([packed(code.astype(np.int32))]),
                pa.array([packed(np.bincount(found, values[place], len(cell)))])],
                ["block", "words", "held", "keys", "n", "ends", "codes", "values"])

    def run(batches):
        parts, size, seen = [], 0, iter(range(1 << _TASK))
        for batch in batches:
            parts.append((batch.column(0), batch.column(1), batch.column(2) if batch.num_columns > 2 else None))
            size += len(parts[-1][1].flatten())
            if size >= POOL * most:
                yield from cut(parts, seen)
                parts, size = [], 0
        if parts:
            yield from cut(parts, seen)
    return rows.mapInArrow(run, f"block long, words array<string>, held array<int>, keys array<{kind}>, "
                                "n long, ends binary, codes binary, values binary")


def _coded(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Block, words, factors, lengths, keys, and text, word and value of each entry of the blocks of a batch."""
    at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
    for i in range(batch.num_rows):
        n, keys = at["n"][i].as_py(), at["keys"][i].values
        ends = unpacked(at["ends"][i].as_py(), len(keys) + 1, np.int32)
        yield (at["block"][i].as_py(), at["words"][i].values, at["factors"][i].values.to_numpy(),
               at["lengths"][i].values.to_numpy() if "lengths" in at else None, keys,
               np.repeat(np.arange(len(keys)), np.diff(ends)), unpacked(at["codes"][i].as_py(), n, np.int32),
               unpacked(at["values"][i].as_py(), n, np.float64))


def _finished(blocks: DataFrame, scaled: bool, zero: float) -> DataFrame:
    """Blocks with factors get the lengths of their texts (1 unless ``scaled``) and lose weights up to ``zero``."""
    kind = blocks.schema["keys"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for block, words, factors, _, keys, text, code, value in _coded(batch):
                weight = value * factors[code]
                length = np.sqrt(np.bincount(text, weight * weight, len(keys))) if scaled else np.ones(len(keys))
                kept = np.abs(weight) > zero
                text, code, value = text[kept], code[kept], value[kept]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), _one(words), _one(pa.array(factors)), _one(keys), _one(pa.array(length)), pa.array([len(code)]),
                    pa.array([packed(np.searchsorted(text, np.arange(len(keys) + 1)).astype(np.int32))]),
                    pa.array([packed(code)]), pa.array([packed(value)])],
                    ["block", "words", "factors", "keys", "lengths", "n", "ends", "codes", "values"])
    return blocks.mapInArrow(run, schema(kind))


def schema(keys: str) -> str:
    """Of finished blocks; ``keys`` is the type of the array of keys."""
    return (f"block long, words array<string>, factors array<double>, keys {keys}, lengths array<double>, "
            "n long, ends binary, codes binary, values binary")


def weighted(rows: DataFrame, n_texts: int, texts: int, zero: float) -> tuple[DataFrame, DataFrame]:
    """Stored blocks of (key, words[, values]) rows with TF-IDF weights, each text of length 1, and (word, df, idf)."""
    spark = rows.sparkSession
    counts = materialize(counted(rows, texts), "word-counts", **WIDE)
    held = counts.select(F.explode(F.arrays_zip("words", "held")).alias("w")).groupBy(F.col("w.words").alias("word")).agg(
        F.sum("w.held").alias("df"))
    idf = materialize(held.withColumn("idf", F.log2(F.lit(float(n_texts)) / F.col("df"))), "idf")
    free_shuffles(spark)
    asked = counts.select("block", F.posexplode("words").alias("place", "word"))
    answers = materialize(asked.join(idf.select("word", "idf"), "word").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "idf"))).alias("a")).select("block", F.col("a.idf").alias("factors")), "factors", **WIDE)
    del asked
    free_shuffles(spark)
    blocks = materialize(_finished(counts.join(answers, "block"), True, zero), "text-blocks", **WIDE)
    for stored in (counts, answers):
        discard(stored)
    free_shuffles(spark)
    return blocks, idf


def plain(weights: DataFrame, key: str, texts: int) -> DataFrame:
    """Stored blocks of (key, word, weight) rows as they are."""
    rows = weights.groupBy(key).agg(F.collect_list(F.struct("word", "weight")).alias("w")).select(
        key, F.col("w.word").alias("words"), F.col("w.weight").alias("values"))
    ones = counted(rows, texts).withColumn("factors", F.transform("words", lambda _: F.lit(1.0)))
    return materialize(_finished(ones, False, -1.0), "text-blocks", **WIDE)


def expanded(blocks: DataFrame, key: str) -> DataFrame:
    """(key, word, weight) of stored blocks."""
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for _, words, factors, lengths, keys, text, code, value in _coded(batch):
                for i in range(0, len(code), BATCH):
                    t, c = text[i:i + BATCH], code[i:i + BATCH]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(t)), words.take(pa.array(c)),
                                                      pa.array(value[i:i + BATCH] * factors[c] / lengths[t])], [key, "word", "weight"])
    return blocks.mapInArrow(run, f"`{key}` {kind}, word string, weight double")


def inverted(blocks: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """A row per block and wanted word: its highest weight ``top``, and the places and values of the texts that have it."""
    def run(batches):
        for batch in batches:
            some = batch.column(batch.schema.get_field_index("wanted"))
            for i, (block, words, factors, lengths, _, text, code, value) in enumerate(_coded(batch)):
                kept = some[i].values.to_numpy(zero_copy_only=False)[code]
                text, code, value = text[kept], code[kept], value[kept]
                if not len(code):
                    continue
                order = np.argsort(code, kind="stable")
                weight = (value * factors[code] / lengths[text])[order]
                known, first = np.unique(code[order], return_index=True)
                slots, values = text[order].astype(np.int32), value[order]
                ends = np.append(first, len(order))
                for i in range(0, len(known), BATCH):
                    k, a = known[i:i + BATCH], ends[i:i + BATCH + 1]
                    offsets, part = pa.array((a - a[0]).astype(np.int32)), slice(a[0], a[-1])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(k), block)), words.take(pa.array(k)), pa.array(factors[k]),
                        pa.array(np.maximum.reduceat(weight, first)[i:i + BATCH]),
                        pa.ListArray.from_arrays(offsets, pa.array(slots[part])),
                        pa.ListArray.from_arrays(offsets, pa.array(values[part]))],
                        ["block", "word", "factor", "top", "slots", "values"])
    return blocks.withColumn("wanted", F.transform("words", wanted)).mapInArrow(run, "block long, word string, factor double, top double, slots array<int>, values array<double>")
