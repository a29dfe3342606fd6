"""Benchmark passages in training texts, found with an FM-index per shard.

Each task builds an index over its shard of the documents: the words are mapped
to the benchmark's vocabulary, runs of known words too short for any phrase are
left out (no phrase can lie in them), the suffixes of the rest are sorted by
prefix doubling, and the Burrows-Wheeler sequence goes into a wavelet matrix.
All test phrases are searched backwards at once through its ranks; places are
located by walking to sampled suffix positions, and merged into word spans.

The benchmark is read in blocks of bounded size, each sent to the tasks and held against
all documents. With more than one block each block's hits are stored before the next block is
read, so the driver holds one block at a time; every block costs a scan of the documents.

Defined results: null and empty texts have no words, no hits and are clean; an
item without words or item_id takes no part; items that share an item_id count as one; rows keep their
own result also if they share a doc_id, repeated rows too, but if the benchmark needs several blocks such
rows become one; a text of any length is searched whole; without documents there are no rows, without
benchmark no hits; other columns are kept by ``drop_contaminated`` and not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import lowered, plain_words, ranges, text_blocks, text_bytes, word_hashes, word_spans
from tallyworks.llm.rowkeys import free_name
from tallyworks.session import materialize

_SPANS = "array<struct<start:int,end:int>>"
_SAMPLE = 8


def _words(buf: np.ndarray, offs: np.ndarray):
    """Hashes of the lower-cased words and the first word of each text."""
    buf = lowered(buf)
    starts, ends, first = word_spans(buf, offs, plain_words())
    return word_hashes(buf, starts, ends), first


class Phrases:
    """Distinct test phrases of a block of benchmark items, as rows of vocabulary numbers.

    Number 0 is the end mark, 1 an unknown word; known words count from 2.
    """

    def __init__(self, items: list[tuple[str, str]], width: int):
        buf, offs = text_bytes(pa.array([text for _, text in items], pa.string()))
        hashes, first = _words(buf, offs)
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 2
        found: dict[tuple[int, ...], set[str]] = {}
        for (item, _), a, b in zip(items, first[:-1], first[1:]):
            for at in range(a, max(b - width, a) + 1) if b > a else ():
                found.setdefault(tuple(numbers[at:min(b, at + width)].tolist()), set()).add(item)
        self.length = np.array([len(p) for p in found], np.int64)
        self.rows = np.zeros((len(found), width), np.int64)
        for i, p in enumerate(found):
            self.rows[i, :len(p)] = p
        self.items = [sorted(x) for x in found.values()]


class Index:
    """FM-index of one shard: runs of known words, each ended by its own mark."""

    def __init__(self, numbers: np.ndarray, text: np.ndarray, shortest: int):
        known = numbers > 1
        new = np.concatenate(([True], (known[1:] != known[:-1]) | (text[1:] != text[:-1])))[:len(numbers)]
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(numbers))
        use = known[begin] & (end - begin >= shortest)
        begin, end = begin[use], end[use]
        place, run = ranges(begin, end + 1)
        mark = place == end[run]
        self.place = place
        symbols = np.where(mark, 0, numbers[np.minimum(place, max(len(numbers) - 1, 0))])
        n = len(symbols)
        rank = np.unique(np.where(mark, run, len(begin) + symbols), return_inverse=True)[1]
        step = 1
        while n and rank.max() < n - 1:
            after = np.zeros(n, np.int64)
            after[:max(n - step, 0)] = rank[step:] + 1
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
            step *= 2
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        last = symbols[order - 1]
        self.levels = []
        bits = int(symbols.max()).bit_length() if n else 0
        below = last
        for level in reversed(range(bits)):
            bit = (below >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit)))
            self.levels.append((level, ones, n - int(ones[-1])))
            below = np.concatenate((below[bit == 0], below[bit == 1]))
        self.last, self.n = last, n
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=2)))) if n else np.zeros(3, int)
        starts_run = np.concatenate(([True], mark[:-1]))[:n]
        sampled = starts_run | (np.arange(n) % _SAMPLE == 0)
        self.is_sampled, self.position = sampled[order], order

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the last column."""
        zero = np.zeros_like(at)
        for level, ones, zeros in self.levels:
            up = ((symbol >> level) & 1).astype(bool)
            at = np.where(up, zeros + ones[at], at - ones[at])
            zero = np.where(up, zeros + ones[zero], zero - ones[zero])
        return at - zero

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, word position in the shard) of every occurrence."""
        if not self.n or not len(phrases.rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        here = np.zeros(max(int(phrases.rows.max()) + 1, len(self.before) - 1), bool)
        here[:len(self.before) - 1] = np.diff(self.before) > 0
        which = np.flatnonzero(here[phrases.rows].all(axis=1))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.n)
        for back in range(phrases.rows.shape[1]):
            at = phrases.length[which] - 1 - back
            go = at >= 0
            symbol = phrases.rows[which, np.maximum(at, 0)]
            low = np.where(go, self.before[symbol] + self._rank(symbol, low), low)
            high = np.where(go, self.before[symbol] + self._rank(symbol, high), high)
            some = high > low
            which, low, high = which[some], low[some], high[some]
        rows, of = ranges(low, high)
        walked = np.zeros(len(rows), np.int64)
        while len(todo := np.flatnonzero(~self.is_sampled[rows])):
            symbol = self.last[rows[todo]]
            rows[todo] = self.before[symbol] + self._rank(symbol, rows[todo])
            walked[todo] += 1
        return which[of], self.place[self.position[rows] + walked]


def _search(phrases: Phrases):
    shortest = int(phrases.length.min()) if len(phrases.length) else 1

    def run(batches):
        for rows, buf, offs in text_blocks(batches):
            hashes, first = _words(buf, offs)
            text = np.repeat(np.arange(len(rows)), np.diff(first))
            numbers = np.ones(len(hashes), np.int64)
            if len(phrases.vocabulary):
                at = np.searchsorted(phrases.vocabulary, hashes)
                at[at == len(phrases.vocabulary)] = 0
                numbers = np.where(phrases.vocabulary[at] == hashes, at + 2, 1)
            which, place = Index(numbers, text, shortest).search(phrases)
            order = np.argsort(place, kind="stable")
            which, place = which[order], place[order]
            cuts = np.searchsorted(place, first).tolist()
            spans, items = [], []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                found = zip(place[a:b].tolist(), (place[a:b] + phrases.length[which[a:b]]).tolist())
                spans.append([{"start": x, "end": y} for x, y in _merged((x - first[i], y - first[i]) for x, y in found)])
                items.append(sorted({item for p in set(which[a:b].tolist()) for item in phrases.items[p]}))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(first)), pa.array(spans, kind),
                 pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "spans", "items"])
    return run


def _merged(spans) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one; the input is in any order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((int(start), int(end)))
    return out


def _item_blocks(benchmark: DataFrame, size: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of about ``size`` bytes, read one after the other."""
    block, held = [], 0
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string"), "text")
    for item, text in items.toLocalIterator():
        block.append((item, text))
        held += len(text) + 16
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


_HITS = f"doc_id long, n_words long, spans {_SPANS}, items array<string>"


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document: merged word spans that
    occurring windows of ``width`` item words cover, and the items they come from."""
    return _contamination(docs, benchmark, width, block_bytes, iter, _HITS)


def _in_one(first, then):
    """Both steps in one Python worker; a ``mapInArrow`` after another keeps a second worker for each task."""
    def run(batches):
        return then(first(batches))
    return run


def _contamination(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int, then, schema: str) -> DataFrame:
    """What ``then`` makes of the batches of every document's hits."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks, found = _item_blocks(benchmark, block_bytes), []
    block, following = next(blocks, []), next(blocks, None)
    if following is None:
        return texts.mapInArrow(_in_one(_search(Phrases(block, width)), then), schema)
    while block:
        found.append(materialize(texts.mapInArrow(_search(Phrases(block, width)), _HITS), "hits"))
        block, following = following, next(blocks, None)
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    return every.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("items")).alias("items")).mapInArrow(_in_one(_merge_rows, then), schema)


def _merge_rows(batches):
    for batch in batches:
        spans = [[{"start": x, "end": y} for x, y in _merged((s["start"], s["end"]) for s in row)]
                 for row in batch.column("spans").to_pylist()]
        items = [sorted(set(row)) for row in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(spans, batch.column("spans").type),
             pa.array(items, batch.column("items").type)], ["doc_id", "n_words", "spans", "items"])


def _digests(batches):
    for batch in batches:
        hit = [sum(s["end"] - s["start"] for s in row) for row in batch.column("spans").to_pylist()]
        items = batch.column("items").to_pylist()
        words = batch.column("n_words").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()),
             pa.array([len(x) for x in items], pa.int64()),
             pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
             pa.array([h > 0 and 20 * h >= n for h, n in zip(hit, words)], pa.bool_())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


_DIGEST = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination_digests(docs: DataFrame, benchmark: DataFrame, width: int = 13,
                          block_bytes: int = 4 << 20) -> DataFrame:
    """Hit words and items of every document; contaminated at a twentieth of its words."""
    return _contamination(docs, benchmark, width, block_bytes, _digests, _DIGEST)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """``docs`` without contaminated ones; other rows and all columns stay as they are."""
    name = free_name(docs, "bad")
    bad = contamination_digests(docs, benchmark, width).where("contaminated AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, docs["doc_id"] == F.col(name), "left_anti")
