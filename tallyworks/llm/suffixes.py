"""Removal of byte strings that occur more than once, by anchor hashing.

Positions are told apart by the hash of a string around their anchor, first 48
bytes, then longer ones (185, then 200 bytes for the standard width). After each
step positions that are unique drop out, positions whose whole surroundings
repeat are past the threshold and done, and the rest go on. No suffixes are ranked (see the README).

Defined results: a null text counts as empty; a text shorter than the width
loses nothing; of equal strings all copies go, the first included; matches never
cross texts; rows without doc_id are returned unchanged; different texts that share a doc_id
are texts of their own, and repeated rows (doc_id and text) are one text and get one result; a text of any
length is judged whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import text_blocks
from tallyworks.llm.repeats import Windows, repeated_spans, span_mask, spans_by_text
from tallyworks.llm.rowkeys import per_text
from tallyworks.llm.substrings import WHOLE, with_changes


def byte_windows(width: int = 200) -> Windows:
    """Strings of ``width`` bytes; every place of a repeated one goes."""
    gram = max(1, min(48, width // 3))
    steps = tuple(s for s in (16, 1) if s < width - gram)
    return Windows("byte", width, gram, False, steps or (1,))


def repeated_strings(docs: DataFrame, width: int = 200) -> DataFrame:
    """(doc_id, spans): byte ranges covered by strings that start anywhere else too.

    Spans may overlap. A text that another one equals has the span up to ``WHOLE``;
    it counts only if the text is as long as a string.
    """
    found = repeated_spans(docs, byte_windows(width))
    whole = found.copies.select("doc_id", F.lit(0).alias("start"), F.lit(WHOLE).alias("end"))
    return spans_by_text(found.spans.union(whole))


def _digests(batches):
    for rows, buf, offs in text_blocks(batches):
        gone = span_mask(rows, offs)
        before = np.concatenate(([False], gone[:-1]))
        before[offs[:-1][offs[:-1] < len(buf)]] = False
        runs = np.concatenate(([0], np.cumsum(gone & ~before)))
        total = np.concatenate(([0], np.cumsum(gone)))
        data, edge = buf[~gone].tobytes(), (offs - total[offs]).tolist()
        sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(edge[:-1], edge[1:])]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.diff(offs)), pa.array(np.diff(total[offs])),
             pa.array(np.diff(runs[offs])), pa.array(sha)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def string_digests(docs: DataFrame, width: int = 200) -> DataFrame:
    """Bytes, removed bytes and runs, and the hash of what is left, for every text."""
    return per_text(docs, lambda texts: _string_digests(texts, width))


def _string_digests(docs: DataFrame, width: int) -> DataFrame:
    found = repeated_spans(docs, byte_windows(width))
    cut = found.texts.join(spans_by_text(found.spans), "doc_id").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
    return with_changes(whole, cut, found.copies, F.col("n_bytes") >= width, {
        "n_removed": F.col("n_bytes"), "n_spans": F.lit(1).cast("long"),
        "kept_sha256": F.lit(hashlib.sha256().hexdigest())})
