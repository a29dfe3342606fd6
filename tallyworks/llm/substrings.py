"""Removal of word passages that repeat an earlier place, by anchor hashing.

Windows of ``width`` words are told apart by their anchors; ``repeats`` decides runs of
windows that all continue alike together, by the coordinates of their first source. No De
Bruijn graph is built (see the README).

Defined results: a null or empty text has no words and stays as it is; a text
with fewer words than a window loses none; of texts with equal words, whatever white
space parts them, only the one with the smallest doc_id keeps them; rows without doc_id are returned
unchanged; of different texts that share a doc_id the one with the smaller bytes counts as earlier, and
repeated rows (doc_id and text) are one text and get one result; a text of any length is judged
whole; an empty table gives no rows; other columns are kept by ``drop_repeats`` and not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import covered, ranges, space_words, text_blocks, text_bytes, word_spans
from tallyworks.llm.repeats import Windows, repeated_spans, span_mask, spans_by_text
from tallyworks.llm.rowkeys import as_ids, by_text, free_name, keyed_texts, per_text, shared_ids, texts_of


# End of the span of a text that goes as a whole.
WHOLE = (1 << 31) - 1


def word_windows(width: int = 20) -> Windows:
    """Windows of ``width`` words; the first place of equal windows stays."""
    return Windows("word", width, max(1, min(8, width // 2)), True, (1,))


def repeated_passages(docs: DataFrame, width: int = 20) -> DataFrame:
    """(doc_id, spans): word ranges that windows starting earlier elsewhere cover.

    Spans may overlap. A text with the words of an earlier one has the span up to ``WHOLE``;
    it counts only if the text is as long as a window.
    """
    found = repeated_spans(docs, word_windows(width))
    whole = found.copies.select("doc_id", F.lit(0).alias("start"), F.lit(WHOLE).alias("end"))
    return spans_by_text(found.spans.union(whole))


def _digests(batches):
    for rows, buf, offs in text_blocks(batches):
        starts, ends, first = word_spans(buf, offs, space_words())
        gone = span_mask(rows, first) if "spans" in rows.schema.names else np.zeros(len(starts), bool)
        kept = np.flatnonzero(~gone)
        size = ends[kept] - starts[kept] + 1
        take, _ = ranges(starts[kept], ends[kept] + 1)
        joined = np.append(buf, np.uint8(0x20))[take]
        stops = np.cumsum(size)
        joined[stops - 1] = 0x20
        edge = np.concatenate(([0], stops))[np.searchsorted(kept, first)]
        data = joined.tobytes()
        sha = [hashlib.sha256(data[a:max(a, b - 1)]).hexdigest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        total = np.concatenate(([0], np.cumsum(gone)))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.diff(first)), pa.array(np.diff(total[first])), pa.array(sha)],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])


_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def passage_digests(docs: DataFrame, width: int = 20) -> DataFrame:
    """Words, removed words and the hash of what is left, for every text."""
    return per_text(docs, lambda texts: _passage_digests(texts, width))


def _passage_digests(docs: DataFrame, width: int) -> DataFrame:
    found = repeated_spans(docs, word_windows(width))
    cut = found.texts.join(spans_by_text(found.spans), "doc_id").mapInArrow(_digests, _DIGEST)
    whole = docs.mapInArrow(_digests, _DIGEST)
    return with_changes(whole, cut, found.copies, F.col("n_words") >= width,
                        {"n_removed": F.col("n_words"), "kept_sha256": F.lit(hashlib.sha256().hexdigest())})


def with_changes(whole: DataFrame, changed: DataFrame, copies: DataFrame, long_enough: Column,
                 nothing_left: dict[str, Column]) -> DataFrame:
    """``whole`` with the values of ``changed`` where that has the doc_id, and those of
    ``nothing_left`` for the copies that are long enough."""
    values = [c for c in whole.columns if c != "doc_id"]
    new = changed.groupBy("doc_id").agg(F.min(F.struct(*values)).alias("new"))
    met = whole.join(new, "doc_id", "left").join(copies.withColumn("copy", F.lit(True)), "doc_id", "left")
    gone = F.col("copy").isNotNull() & long_enough
    return met.select("doc_id", *[
        F.when(gone, nothing_left[c] if c in nothing_left else F.col(c)).when(F.col("new").isNull(), F.col(c))
        .otherwise(F.col(f"new.{c}")).alias(c) for c in values])


def _cut(texts: pd.Series, spans: pd.Series, width: int) -> pd.Series:
    out = []
    for text, given in zip(texts, spans):
        if given is None or text is None or not len(given):
            out.append(text)
            continue
        buf, offs = text_bytes(pa.array([text]))
        starts, ends, _ = word_spans(buf, offs, space_words())
        n = len(starts)
        given = [(min(s["start"], n), min(s["end"], n)) for s in given if n >= width or s["end"] < WHOLE]
        gone = covered([a for a, _ in given], [b for _, b in given], n)
        next_start = np.append(starts[1:], len(buf))
        away = covered(starts[gone], next_start[gone], len(buf))
        out.append(buf[~away].tobytes().decode("utf-8"))
    return pd.Series(out, dtype=object)


def cut_words(text: Column, spans: Column, width: int = 20) -> Column:
    """``text`` without the words of ``spans`` and the white space after each; null spans change nothing."""
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return _cut(texts, spans, width)
    return F.pandas_udf(cut, "string")(text, spans)


def drop_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """``docs`` with every passage removed that repeats an earlier one; all columns and rows stay."""
    name = free_name(docs, "cut_spans")
    texts = texts_of(docs)
    if shared_ids(texts):
        keyed = keyed_texts(texts)
        met = by_text(docs, repeated_passages(as_ids(keyed), width).withColumnRenamed("spans", name), keyed, "left")
    else:
        key = free_name(docs, "cut_id")
        spans = repeated_passages(texts, width).select(F.col("doc_id").alias(key), F.col("spans").alias(name))
        met = docs.join(spans, docs["doc_id"] == F.col(key), "left")
    new = F.when(F.col(name).isNull(), F.col("text")).otherwise(cut_words(F.col("text"), F.col(name), width))
    return met.withColumn("text", new).select(*[F.col(f"`{c}`") for c in docs.columns])
