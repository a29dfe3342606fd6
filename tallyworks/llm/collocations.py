"""Phrase collocations per language, counted in HAT-tries.

A phrase is a path in a word-id trie: its node is told by (parent node, next word).
Level by level, each block of texts counts the edges under its frequent nodes in a
``HatTrie`` whose first children are prefix partitions; their subtrees leave the task as
sorted runs, and the runs of a prefix partition are merged in Spark. An edge found often
enough becomes a node of the next level, and each block is told which of its edges did. A
phrase can only be frequent if both phrases that it has one word less of are, so nothing
else is counted, and no count is lost. Prefixes with a large share of all words have their
subtrees dealt by the next word too; there are at most 4 of those per partition.

Scores, the rule on longer phrases and the ranking are joins of the frequent nodes.

Defined results: a null or empty text has no words; a null language is ``und``; repeated
rows count as often as they stand there; doc_id and other columns are not read; ties in
score and count are broken by the phrase's UTF-8 bytes; an empty table, or one without frequent
phrases, gives no rows. Node and word ids have 32 bits; more frequent phrases than that raise an error.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.arrays import lowered, mixed, text_blocks
from tallyworks.llm.vocabulary import BlockNumbers, answers, dictionary, known_values, packed, unpacked
from tallyworks.operators.ordering import number_rows
from tallyworks.session import discard, materialize

# Fixed values of the contract: what parts pieces, and words within pieces.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
LONGEST = 4
# Words of the corpus per prefix partition.
PART_WORDS = 1 << 20
_TEXT_BYTES = 4 << 20
_LOW = np.uint64((1 << 32) - 1)


class HatTrie:
    """Counts of 64-bit edges (prefix << 32 | word).

    The root's children are the prefix partitions. A child is a hash container until it has
    ``burst`` entries; it then bursts into 16 children by further bits of the edge. Beyond
    ``limit`` entries in all, the largest subtrees are handed to ``spill`` as sorted runs.
    """

    def __init__(self, spill, burst: int = 1 << 15, limit: int = 2_000_000):
        self.root: dict[int, Counter | list] = {}
        self.sizes: dict[int, int] = {}
        self.spill, self.burst, self.limit = spill, burst, limit

    def add(self, edges: np.ndarray, part: np.ndarray) -> None:
        order = np.argsort(part, kind="stable")
        edges, part = edges[order], part[order]
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))).tolist() if len(part) else []
        for a, b in zip(cuts, [*cuts[1:], len(part)]):
            p = int(part[a])
            self.root[p] = self._into(self.root.get(p, None) or Counter(), edges[a:b], 0)
            self.sizes[p] = self._size(self.root[p])
        while sum(self.sizes.values()) > self.limit:
            self._leave(max(self.sizes, key=self.sizes.get))

    def _into(self, node, edges: np.ndarray, depth: int):
        if isinstance(node, list):
            way = self._ways(edges, depth)
            for k in range(16):
                some = edges[way == k]
                if len(some):
                    node[k] = self._into(node[k], some, depth + 1)
            return node
        node.update(edges.tolist())
        if len(node) <= self.burst or depth == 12:
            return node
        held = np.fromiter(node.keys(), np.uint64, len(node))
        counts = np.fromiter(node.values(), np.int64, len(node))
        way = self._ways(held, depth)
        return [Counter(dict(zip(held[way == k].tolist(), counts[way == k].tolist()))) for k in range(16)]

    @staticmethod
    def _ways(edges: np.ndarray, depth: int) -> np.ndarray:
        return ((mixed(edges) >> np.uint64(4 * depth)) & np.uint64(15)).astype(np.int64)

    def _size(self, node) -> int:
        return sum(map(self._size, node)) if isinstance(node, list) else len(node)

    def _leaves(self, node):
        if isinstance(node, list):
            for child in node:
                yield from self._leaves(child)
        elif node:
            yield node

    def _leave(self, part: int) -> None:
        """A whole subtree as one sorted run."""
        leaves = list(self._leaves(self.root.pop(part)))
        n = self.sizes.pop(part)
        if not n:
            return
        edges = np.concatenate([np.fromiter(x.keys(), np.uint64, len(x)) for x in leaves])
        counts = np.concatenate([np.fromiter(x.values(), np.int64, len(x)) for x in leaves])
        order = np.argsort(edges)
        self.spill(part, edges[order], counts[order])

    def close(self) -> None:
        for part in sorted(self.root):
            self._leave(part)


def _blocks(batches):
    """Blocks of texts: word codes per place, 0 where a piece ends, and the block's (language, word) dictionary."""
    numbers = BlockNumbers()
    breaks = np.zeros(256, bool)
    breaks[list(BREAKS)] = True
    words_of = ~breaks
    words_of[list(BLANKS)] = False
    for rows, buf, offs in text_blocks(batches, size=_TEXT_BYTES):
        buf = lowered(buf)
        words, ids, starts, _, first = dictionary(buf, offs, words_of)
        if not len(starts):
            continue
        langs = rows.column("lang").dictionary_encode()
        lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(first))
        pair, code, count = np.unique(ids * len(langs.dictionary) + lang, return_inverse=True, return_counts=True)
        stop = np.concatenate(([0], np.cumsum(breaks[buf])))[starts]
        new = np.concatenate(([False], stop[1:] != stop[:-1]))
        new[first[(first > 0) & (first < len(starts))]] = True
        places = np.insert((code + 1).astype(np.uint32), np.flatnonzero(new), 0)
        entries = pa.StructArray.from_arrays(
            [langs.dictionary.take(pa.array(pair % len(langs.dictionary))),
             words.take(pa.array(pair // len(langs.dictionary))).cast(pa.string()), pa.array(count)], ["lang", "word", "n"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([numbers.next()]), pa.array([packed(places)], pa.binary()), pa.array([len(places)]),
             pa.array([len(pair)]), pa.ListArray.from_arrays(pa.array([0, len(pair)], pa.int32()), entries)],
            ["block", "places", "length", "size", "words"])


_BLOCK = "block long, places binary, length long, size long, words array<struct<lang:string,word:string,n:long>>"
_STATE = "block long, nodes binary, last binary, length long"


def _without_gaps(nodes: np.ndarray, last: np.ndarray):
    """Runs of zeros as one zero."""
    keep = (nodes != 0) | np.concatenate(([False], nodes[:-1] != 0))
    return nodes[keep], last[keep]


def _state(block, nodes, last):
    nodes, last = _without_gaps(nodes, last)
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([packed(nodes)], pa.binary()), pa.array([packed(last)], pa.binary()),
         pa.array([len(nodes)])], ["block", "nodes", "last", "length"])


def _first_level(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            size = batch.column("size")[k].as_py()
            known = batch.column("known")[k]
            ids = np.concatenate(([0], known_values(known.values if known.is_valid else None, size, ["id"])[0]))
            places = unpacked(batch.column("places")[k].as_py(), batch.column("length")[k].as_py(), np.uint32)
            nodes = ids[places].astype(np.uint32)
            yield _state(batch.column("block")[k].as_py(), nodes, nodes)


def _edges(batch: pa.RecordBatch, k: int):
    """Places of a block's edges, and the edges: a node with the word after it, if the phrase of its size there is frequent too."""
    n = batch.column("length")[k].as_py()
    nodes, last = (unpacked(batch.column(c)[k].as_py(), n, np.uint32) for c in ("nodes", "last"))
    at = np.flatnonzero((nodes[:-1] != 0) & (nodes[1:] != 0)) if n else np.zeros(0, np.int64)
    return n, at, nodes[at].astype(np.uint64) << np.uint64(32) | last[at + 1].astype(np.uint64), last


def _parts(edges: np.ndarray, parts: int, hot: np.ndarray) -> np.ndarray:
    """Prefix partition: by the parent node, for hot parents by the word as well."""
    parent = edges >> np.uint64(32)
    key = np.where(np.isin(parent, hot), mixed(edges), mixed(parent))
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _runs(parts: int, hot: np.ndarray):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                out = []
                trie = HatTrie(lambda part, edges, counts: out.append((part, packed(edges), packed(counts), len(edges))))
                _, _, edges, _ = _edges(batch, k)
                for i in range(0, len(edges), 1 << 18):
                    some = edges[i:i + (1 << 18)]
                    trie.add(some, _parts(some, parts, hot))
                trie.close()
                if out:
                    block = batch.column("block")[k].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(out)), *[pa.array([o[i] for o in out], t) for i, t in enumerate(
                            (pa.int32(), pa.binary(), pa.binary(), pa.int64()))]],
                        ["block", "part", "edges", "counts", "n"])
    return run


_MERGED = "block long, edges binary, ids binary, counts binary, n long"


def _merged(parts: int, least: int):
    """Frequent edges of one prefix partition (block null), and for each run those of its edges that are among them."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        n = table.column("n").to_pylist()
        runs = [unpacked(e.as_py(), k, np.uint64) for e, k in zip(table.column("edges"), n)]
        counts = np.concatenate([unpacked(c.as_py(), k, np.int64) for c, k in zip(table.column("counts"), n)])
        every = np.concatenate(runs)
        order = np.argsort(every, kind="stable")
        every, counts = every[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        total, edges = np.add.reduceat(counts, first), every[first]
        edges, total = edges[total >= least], total[total >= least]
        ids = np.arange(len(edges), dtype=np.uint64) * np.uint64(parts) + np.uint64(part + 1)
        if len(ids) and ids[-1] > _LOW:
            raise OverflowError("more frequent phrases than 32-bit node ids")
        ids = ids.astype(np.uint32)
        rows = [(None, packed(edges), packed(ids), packed(total), len(edges))] if len(edges) else []
        for block, some in zip(table.column("block").to_pylist(), runs):
            at = np.minimum(np.searchsorted(edges, some), max(len(edges) - 1, 0))
            at = at[edges[at] == some] if len(edges) else at[:0]
            if len(at):
                rows.append((block, packed(edges[at]), packed(ids[at]), None, len(at)))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                        ["block", "edges", "ids", "counts", "n"])
    return run


def _next_level(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            n, at, edges, last = _edges(batch, k)
            known = batch.column("known")[k].values
            some = [(unpacked(e.as_py(), c, np.uint64), unpacked(i.as_py(), c, np.uint32)) for e, i, c in zip(
                known.field("edges"), known.field("ids"), known.field("n").to_pylist())]
            keys, ids = (np.concatenate(x) for x in zip(*some))
            order = np.argsort(keys)
            keys, ids = keys[order], ids[order]
            place = np.minimum(np.searchsorted(keys, edges), len(keys) - 1)
            nodes, word = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
            nodes[at] = np.where(keys[place] == edges, ids[place], 0)
            word[at] = last[at + 1]
            yield _state(batch.column("block")[k].as_py(), nodes, word)


def _nodes(batches):
    for batch in batches:
        for k, n in enumerate(batch.column("n").to_pylist()):
            edges = unpacked(batch.column("edges")[k].as_py(), n, np.uint64)
            ids = unpacked(batch.column("ids")[k].as_py(), n, np.uint32)
            counts = unpacked(batch.column("counts")[k].as_py(), n, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)), pa.array((edges >> np.uint64(32)).astype(np.int64)),
                 pa.array((edges & _LOW).astype(np.int64)), pa.array(counts)], ["id", "parent", "word", "a"])


def frequent_phrases(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Words of each language (lang, n), frequent words (id, lang, word, a), and for each length from 2
    to ``LONGEST`` the nodes (id, parent, word, a) of the phrases that stand ``least`` times or more."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")) if "lang" in docs.columns else F.lit("und")
    blocks = materialize(docs.select("text", lang.alias("lang")).mapInArrow(_blocks, _BLOCK), "blocks")
    entries = blocks.select("block", F.posexplode("words").alias("i", "e")).select("block", "i", "e.*")
    counts = materialize(entries.groupBy("lang", "word").agg(F.sum("n").alias("a")), "words")
    totals = materialize(counts.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    words = materialize(number_rows(counts.where(F.col("a") >= least), ["lang", "word"], "id"), "words")
    discard(counts)
    size = totals.agg(F.sum("n")).first()[0] or 0
    if words.count() >> 32:
        raise OverflowError("more frequent words than 32-bit ids")
    parts = max(8, -(-size // PART_WORDS))
    known = answers(entries.drop("n"), words, ["lang", "word"], ["id"])
    state = materialize(blocks.drop("words").join(known, "block", "left").mapInArrow(_first_level, _STATE), "places")
    discard(blocks)
    levels, above = [], words
    for length in range(2, LONGEST + 1):
        # at most 4 * parts prefixes can have so many of all words
        hot = above.where(F.col("a") > F.lit(size // (4 * parts))).select("id").toArrow().column("id").to_numpy()
        runs = state.mapInArrow(_runs(parts, hot.astype(np.uint64)), "block long, part int, edges binary, counts binary, n long")
        merged = materialize(runs.groupBy("part").applyInArrow(_merged(parts, least), _MERGED), "merged")
        above = materialize(merged.where("block IS NULL").mapInArrow(_nodes, "id long, parent long, word long, a long"), "nodes")
        levels.append(above)
        if length < LONGEST:
            told = merged.where("block IS NOT NULL").groupBy("block").agg(
                F.collect_list(F.struct("edges", "ids", "n")).alias("known"))
            later = materialize(state.join(told, "block").mapInArrow(_next_level, _STATE), "places")
            discard(state)
            state = later
    return totals, words, levels


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), exactly."""
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * a.cast("decimal(19,0)"),
                           (left + right).cast("decimal(19,0)"))


def collocations(docs: DataFrame, least: int = 30, longer_percent: int = 80, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases."""
    totals, words, (two, three, four) = frequent_phrases(docs, least)
    w = {k: words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("a").alias(f"f{k}"), *(
        ["lang"] if k == 1 else [])) for k in (1, 2, 3, 4)}
    # words of each phrase by id, and counts of all its parts
    pairs = materialize(two.select(F.col("id").alias("p2"), F.col("parent").alias("w1"), F.col("word").alias("w2"),
                                   F.col("a").alias("f12")).join(w[1], "w1").join(w[2], "w2"), "pairs")
    inner = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f12").alias("f23"))
    triples = materialize(three.select(F.col("id").alias("p3"), F.col("parent").alias("p2"), F.col("word").alias("w3"),
                                       F.col("a").alias("f123")).join(pairs, "p2").join(w[3], "w3").join(inner, ["w2", "w3"]), "triples")
    last = pairs.select(F.col("w1").alias("w3"), F.col("w2").alias("w4"), F.col("f12").alias("f34"))
    after = triples.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), F.col("f123").alias("f234"))
    fours = four.select(F.col("parent").alias("p3"), F.col("word").alias("w4"), F.col("a").alias("f1234")).join(
        triples, "p3").join(w[4], "w4").join(last, ["w3", "w4"]).join(after, ["w2", "w3", "w4"])
    fours = materialize(fours, "fours")

    def longest_of(longer: DataFrame, count: str, head: list[str], tail: list[str], names: list[str]) -> DataFrame:
        """Highest count among the phrases one word longer. Those longer still have no higher one."""
        both = longer.select(*[F.col(c).alias(n) for c, n in zip(head, names)], F.col(count).alias("m")).union(
            longer.select(*[F.col(c).alias(n) for c, n in zip(tail, names)], F.col(count).alias("m")))
        return both.groupBy(*names).agg(F.max("m").alias("m"))

    kept_pairs = pairs.join(longest_of(triples, "f123", ["w1", "w2"], ["w2", "w3"], ["w1", "w2"]), ["w1", "w2"], "left")
    kept_triples = triples.join(
        longest_of(fours, "f1234", ["w1", "w2", "w3"], ["w2", "w3", "w4"], ["w1", "w2", "w3"]), ["w1", "w2", "w3"], "left")

    def scored(rows: DataFrame, a: str, text: list[str], cuts: list[tuple[str, str]], longer: bool) -> DataFrame:
        count = F.col(a)
        best = F.array_min(F.array(*[F.struct(
            _score(count, F.col(x), F.col(y)).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"),
            F.col(y).alias("r")) for k, (x, y) in enumerate(cuts)]))
        some = rows.where(F.coalesce(100 * F.col("m") < longer_percent * count, F.lit(True))) if longer else rows
        return some.select("lang", F.concat_ws(" ", *text).alias("phrase"), count.alias("a"), best.alias("best")).select(
            "lang", "phrase", "a", "best.l", "best.r", "best.score")

    every = scored(kept_pairs, "f12", ["t1", "t2"], [("f1", "f2")], True).union(
        scored(kept_triples, "f123", ["t1", "t2", "t3"], [("f1", "f23"), ("f12", "f3")], True)).union(
        scored(fours, "f1234", ["t1", "t2", "t3", "t4"], [("f1", "f234"), ("f12", "f34"), ("f123", "f4")], False))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
