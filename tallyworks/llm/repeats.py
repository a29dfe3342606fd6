"""Repeated windows of a sequence, found by hashing their anchors.

Shared by the substring operators on words and on bytes. A window is ``width``
consecutive symbols of one text. Its anchor is the ``gram`` of lowest hash in
it, so equal windows have equal anchors at the same place, and only one gram in
several positions needs to be compared at all. Consecutive windows with one
anchor form a node; the node's hull is all that they cover.

A node whose gram stands nowhere else is done. The rest are compared hull by
hull: equal hulls are one path of the graph and are decided together, by the
source coordinates of the first of them. Only where paths that share a core
part ways does the first node of each path go on, cut into smaller nodes with
longer cores (``steps``), down to single windows. Hulls are compared by 128 bits.

Of texts with equal symbols (for 'word' the words, whatever white space parts them; for
'byte' the whole text) only the one with the smallest doc_id goes through the graph;
what happens to the others follows from that (``Found.copies``).

Nothing is held per key: groups are counted with partial sums and joined, so a
passage that a third of all texts share is no single task's work.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import (
    Rolling, byte_symbols, covered, longs, mixed, ranges, space_words, text_blocks, word_hashes, word_spans,
)
from tallyworks.session import discard, materialize


# Bytes of text handled at once: a byte takes about 50 bytes of hashes and sums meanwhile.
_TEXT_BYTES = 1 << 18


@dataclass(frozen=True)
class Windows:
    """What is compared: ``unit`` 'word' or 'byte', and which of equal windows go.

    ``later``: those that start after the first one; else all of them.
    ``steps`` are the sizes into which an undecided node is cut, ending in 1.
    """

    unit: str
    width: int
    gram: int
    later: bool
    steps: tuple[int, ...]


def _symbols(rule: Windows, buf: np.ndarray, offs: np.ndarray):
    """Two independent hash sequences and the first symbol of each text."""
    if rule.unit == "byte":
        return Rolling(byte_symbols(buf)), lambda: Rolling(byte_symbols(buf, 1), 1), offs
    starts, ends, first = word_spans(buf, offs, space_words())
    return (Rolling(word_hashes(buf, starts, ends)),
            lambda: Rolling(word_hashes(buf, starts, ends, 1), 1), first)


def _nodes(rule: Windows, roll: Rolling, first: np.ndarray):
    """Anchor, first and last window start of each node, its text, and the gram's hash."""
    n, w = int(first[-1]), rule.width - rule.gram + 1
    if n < rule.width:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    at = np.arange(n - rule.gram + 1)
    grams = roll.of(at, at + rule.gram)
    place = np.uint64((1 << int(n).bit_length()) - 1)
    keys = (grams & ~place) | at.astype(np.uint64)
    pad = -len(keys) % w
    table = np.concatenate((keys, np.full(pad, ~np.uint64(0)))).reshape(-1, w)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - rule.width + 1)
    lowest = np.minimum(right[starts], left[starts + w - 1])
    long_enough = np.diff(first) >= rule.width
    inside = covered(first[:-1][long_enough], first[1:][long_enough] - rule.width + 1, n)[:len(starts)]
    starts, anchor = starts[inside], (lowest[inside] & place).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))[:len(anchor)])
    anchor, lo = anchor[new], starts[new]
    hi = starts[np.concatenate((new[1:], [len(starts)])) - 1] if len(new) else lo
    return anchor, lo, hi, np.searchsorted(first, lo, "right") - 1, grams[anchor]


def _anchor_rows(rule: Windows):
    """Anchors with their gram's hash, their place, and a mark of (symbols, place) that texts with equal symbols share."""
    def run(batches):
        for rows, buf, offs in text_blocks(batches, size=_TEXT_BYTES):
            roll, _, first = _symbols(rule, buf, offs)
            anchor, _, _, text, gram = _nodes(rule, roll, first)
            ids = rows.column("doc_id").take(pa.array(text))
            at = anchor - first[text]
            whole = roll.of(first[:-1], first[1:])[text]
            yield pa.RecordBatch.from_arrays(
                [ids, longs(gram), pa.array(at.astype(np.int32)), longs(mixed(whole + at.astype(np.uint64)))],
                ["doc_id", "core", "at", "mark"])
    return run


_NODE = "doc_id long, at int, lo int, hi int, core long, hull long, guard long"


def _emit(ids, text, first, at, lo, hi, core, roll, guard, width):
    """Rows of nodes given by positions in the block."""
    base = first[text]
    hull, second = roll.of(lo, hi + width), guard.of(lo, hi + width)
    small = [pa.array((x - base).astype(np.int32)) for x in (at, lo, hi)]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(text)), *small, longs(core), longs(hull), longs(second)],
                                      ["doc_id", "at", "lo", "hi", "core", "hull", "guard"])


def _lists(column: pa.Array):
    """Values of a list column and the row of each."""
    offs = column.offsets.to_numpy()
    return column.values.slice(offs[0], offs[-1] - offs[0]), np.repeat(np.arange(len(column)), np.diff(offs))


def _first_nodes(rule: Windows):
    """Nodes of the anchors that a text's list ``ats`` names."""
    def run(batches):
        for rows, buf, offs in text_blocks(batches, size=_TEXT_BYTES):
            roll, guard, first = _symbols(rule, buf, offs)
            anchor, lo, hi, text, gram = _nodes(rule, roll, first)
            ats, of = _lists(rows.column("ats"))
            keep = np.isin(anchor, ats.to_numpy() + first[of])
            yield _emit(rows.column("doc_id"), text[keep], first, anchor[keep], lo[keep], hi[keep], gram[keep],
                        roll, guard(), rule.width)
    return run


def _smaller_nodes(rule: Windows, size: int):
    """Nodes of a text's list ``nodes`` cut into blocks of ``size`` offsets from the anchor."""
    def run(batches):
        for rows, buf, offs in text_blocks(batches, size=_TEXT_BYTES):
            roll, guard, first = _symbols(rule, buf, offs)
            given, of = _lists(rows.column("nodes"))
            at, lo, hi = (given.field(k).to_numpy() + first[of] for k in ("at", "lo", "hi"))
            block, which = ranges((at - hi) // size, (at - lo) // size + 1)
            at, lo, hi, text = at[which], lo[which], hi[which], of[which]
            near, far = block * size, block * size + size - 1
            core = roll.of(at - near, at - far + rule.width)
            yield _emit(rows.column("doc_id"), text, first, at, np.maximum(lo, at - far), np.minimum(hi, at - near),
                        core, roll, guard(), rule.width)
    return run


def _decide(rows: DataFrame, rule: Windows, last: bool) -> DataFrame:
    """Which nodes go as a whole, and which have to be cut further."""
    paths = rows.groupBy("hull", "guard").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "lo")).alias("first"), F.min("core").alias("core"))
    paths = materialize(paths, "paths")
    if last:
        kinds = paths.where("n > 1").withColumn("parting", F.lit(False))
    else:
        parting = materialize(paths.groupBy("core").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1")
                              .select("core"), "parting")
        kinds = paths.join(parting.withColumn("parting", F.lit(True)), "core", "left").where(
            "n > 1 OR parting").withColumn("parting", F.coalesce("parting", F.lit(False)))
    met = rows.drop("core").join(kinds.drop("core"), ["hull", "guard"])
    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("lo") == F.col("first.lo"))
    goes = ~is_first if rule.later else F.col("n") > 1
    decided = materialize(met.select("doc_id", "at", "lo", "hi", goes.alias("goes"),
                                     (is_first & F.col("parting")).alias("open")).where("goes OR open"), "decided")
    discard(paths)
    return decided


@dataclass(frozen=True)
class Found:
    """``texts``: texts in question; ``spans`` (doc_id, start, end) of their windows that go, in
    symbols, overlapping, up to before ``end``; ``copies``: doc_ids of texts that go as
    a whole, if they are as long as a window, because others have the same symbols."""

    texts: DataFrame
    spans: DataFrame
    copies: DataFrame


def _word_digests(batches):
    """Digest of each text's words, each followed by one space; texts without words are left out."""
    for rows, buf, offs in text_blocks(batches, size=_TEXT_BYTES):
        starts, ends, first = word_spans(buf, offs, space_words())
        size = ends - starts + 1
        stops = np.cumsum(size)
        take, _ = ranges(starts, ends + 1)
        joined = np.append(buf, np.uint8(0x20))[take]
        joined[stops - 1] = 0x20
        edge, data = np.concatenate(([0], stops))[first].tolist(), joined.tobytes()
        some = np.flatnonzero(np.diff(first))
        digests = [hashlib.md5(data[edge[i]:edge[i + 1]]).digest() for i in some.tolist()]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(some)), pa.array(digests, pa.binary())],
                                         ["doc_id", "digest"])


def _equal_texts(texts: DataFrame, rule: Windows) -> DataFrame:
    """(doc_id, rep) of the texts whose symbols others have too; rep is the smallest doc_id."""
    if rule.unit == "word":
        marked = texts.mapInArrow(_word_digests, "doc_id long, digest binary")
    else:
        marked = texts.where("text <> ''").select("doc_id", F.md5("text").alias("digest"))
    classes = materialize(marked.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
                          .where("n > 1").select("digest", "rep"), "classes")
    return materialize(marked.join(classes, "digest").select("doc_id", "rep"), "copies")


def repeated_spans(docs: DataFrame, rule: Windows) -> Found:
    """Repeated windows of all texts.

    Rows without a doc_id take no part. doc_ids have to be distinct.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    equal = _equal_texts(texts, rule)
    anchors = texts.mapInArrow(_anchor_rows(rule), "doc_id long, core long, at int, mark long")
    again = materialize(anchors.groupBy("core").agg(F.min("mark").alias("a"), F.max("mark").alias("b"))
                        .where("a <> b").select("core"), "anchors")
    places = anchors.drop("mark").join(again, "core").groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
    others = equal.where("doc_id <> rep").select("doc_id").distinct()
    some = materialize(texts.join(places.join(others, "doc_id", "left_anti"), "doc_id"), "candidates")
    discard(again)
    rows = materialize(some.mapInArrow(_first_nodes(rule), _NODE), "nodes")
    some = some.drop("ats")
    every = None
    for size in (*rule.steps, None):
        decided = _decide(rows, rule, last=size is None)
        discard(rows)
        spans = decided.where("goes").select(
            "doc_id", F.col("lo").alias("start"), (F.col("hi") + F.lit(rule.width)).alias("end"))
        every = spans if every is None else every.union(spans)
        if size is not None:
            nodes = decided.where("open").groupBy("doc_id").agg(
                F.collect_list(F.struct("at", "lo", "hi")).alias("nodes"))
            rows = materialize(some.join(nodes, "doc_id").mapInArrow(_smaller_nodes(rule, size), _NODE), "nodes")
    gone = equal.where("doc_id <> rep") if rule.later else equal
    return Found(some, every, gone.select("doc_id").distinct())


def spans_by_text(spans: DataFrame) -> DataFrame:
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def span_mask(rows: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    """Which symbols of a block the texts' ``spans`` cover; spans beyond a text's end are cut off."""
    given, of = _lists(rows.column("spans"))
    top = first[1:][of]
    return covered(np.minimum(given.field("start").to_numpy() + first[of], top),
                   np.minimum(given.field("end").to_numpy() + first[of], top), int(first[-1]))
