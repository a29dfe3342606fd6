"""Words of blocks of texts, and what a corpus-wide table says about them.

A block is a few megabytes of whole texts in one stored row, its words coded by
their place in the block's own dictionary. The dictionaries, not the texts, meet
the corpus-wide table, so a word is one entry per block however often it stands there, and
neither side is broadcast or gathered. ``answers`` does that by rows; ``dealt`` cuts a
dictionary into packed runs, one per hash range of the words, for tables that a task can sum
up range by range: what comes back for a run is in the run's own order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import word_spans


def dictionary(buf: np.ndarray, offs: np.ndarray, table: np.ndarray):
    """Distinct words of a block, each word's place among them, spans of the words, first word of each text."""
    starts, ends, first = word_spans(buf, offs, table)
    places = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places),
                                             pa.py_buffer(np.ascontiguousarray(buf[table[buf]]))).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, ends, first


def packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True) if len(values) else b""


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    """``n`` values that ``packed`` stored."""
    if not n:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


class BlockNumbers:
    """Numbers for the blocks of a task, distinct over all tasks of a job."""

    def __init__(self):
        self.at = TaskContext.get().partitionId() << 32

    def next(self) -> int:
        self.at += 1
        return self.at


def dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts a dictionary by hash range, the ranges that occur, and where each begins (one more at the end)."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, first = np.unique(part[order], return_index=True)
    return order, found, np.append(first, len(order))


def word_bytes(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words one after the other, and their lengths."""
    offs = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    held = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None and len(words) else np.zeros(0, np.uint8)
    return held, np.diff(offs)


def words_of(data: np.ndarray, sizes: np.ndarray) -> pa.LargeStringArray:
    places = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data)))


def answers(entries: DataFrame, table: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(block, known): for each block's entries (block, i, keys) the values of ``table``, which has a row per key.

    ``known`` lists (i, values) of the entries that the table has, in no order.
    """
    return entries.join(table, keys).groupBy("block").agg(F.collect_list(F.struct("i", *values)).alias("known"))


def known_values(known, n: int, names: list[str]) -> list[np.ndarray]:
    """Of one block's ``known`` list: an array of ``n`` longs per name, 0 where nothing is known."""
    out = [np.zeros(n, np.int64) for _ in names]
    if known is not None and len(known):
        at = known.field("i").to_numpy(zero_copy_only=False)
        for values, name in zip(out, names):
            values[at] = known.field(name).to_numpy(zero_copy_only=False)
    return out
