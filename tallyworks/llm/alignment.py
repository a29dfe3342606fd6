"""Alignment of two tokenizers on the same texts, merged in lockstep.

Tokenizer A is a byte-level BPE of the tokenizers library and sees a space and the text;
tokenizer B is a SentencePiece model that adds that space itself. Both are told apart by
the bytes that their tokens stand for. A text is cut before each single space between two
characters that are no white space: A's splitting pattern always starts a match there, and B has no piece
with the marker behind another character, so neither has a token across a cut (``Pair`` checks the
models). Each distinct sequence between cuts is encoded and aligned once per block.

The merge holds one state vector per tokenizer over all sequences of the block: in each step
every sequence advances the pointer that is behind (both if they stand at the same byte),
emits a link and a cut where they meet, and finished sequences are compacted away.

A link's count is that of its id pair over the whole corpus. Blocks send their distinct
pairs, not their links, to be counted; each block is told its pairs' counts and whether one is its
B id's highest, and puts the sums per document together.

Defined results: a null or empty text has no tokens: zeros and an empty digest; so has a text
whose tokens do not give its bytes back. Every row gets a row and counts as a text of its own,
repeated rows and doc_ids included; a null doc_id stays null; ties for a B id's highest count all count;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import text_blocks
from tallyworks.llm.pieces import BPE, BYTE, CONTROL, MARK, UNKNOWN, parse_model, read_model
from tallyworks.llm.vocabulary import BlockNumbers, answers, known_values, packed, unpacked
from tallyworks.session import materialize

_TEXT_BYTES = 4 << 20
# Before a single space between characters that are no white space (Unicode's included).
_CUT = re.compile(r"(?<=\S)(?= \S)")


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, first: str, second: bytes, threads: int = 1):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        model = parse_model(second)
        names = [p for p, _, _ in model.pieces]
        if model.kind != BPE or model.charsmap or model.trim_spaces or not model.dummy_prefix or any(
                MARK in p.lstrip(MARK) for p in names) or self.a.normalizer is not None:
            raise ValueError("texts can only be cut for models without a normaliser, whose pieces begin with the marker")
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN)
                        else p.replace(MARK, " ").encode() for p, _, k in model.pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))

    def encode(self, sequences: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both for sequences that begin with a space."""
        a = [np.asarray(e.ids, np.int64) for e in self.a.encode_batch_fast(sequences, add_special_tokens=False)]
        b = [np.asarray(x, np.int64) for x in self.b.encode([s[1:] for s in sequences], num_threads=1)]
        return a, b

    def gives(self, ids: np.ndarray, text: bytes, which: str) -> bool:
        table = self.a_bytes if which == "a" else self.b_bytes
        return b"".join([table[i] for i in ids.tolist()]) == text


def sequences_of(text: str) -> list[str]:
    """Parts of a space and the text, between the cuts that no token crosses."""
    return _CUT.split(" " + text)


class Encoded:
    """Ids of many sequences one after the other: values, the first of each, bytes up to each token's end."""

    def __init__(self, parts: list[np.ndarray], size: np.ndarray):
        n = np.array([len(p) for p in parts], np.int64)
        self.first = np.concatenate(([0], np.cumsum(n)))
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(size[self.ids])))
        self.ends = total[1:] - np.repeat(total[self.first[:-1]], n)


def lockstep(a: Encoded, b: Encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, A place, B place) of every pair of tokens that end at the same byte, by sequence and place."""
    n = len(a.first) - 1
    seq = np.arange(n)
    i, j = a.first[:-1].copy(), b.first[:-1].copy()
    stop_i, stop_j = a.first[1:], b.first[1:]
    out = []
    live = (i < stop_i) & (j < stop_j)
    while True:
        seq, i, j, stop_i, stop_j = (x[live] for x in (seq, i, j, stop_i, stop_j))
        if not len(seq):
            break
        end_a, end_b = a.ends[i], b.ends[j]
        met = end_a == end_b
        if met.any():
            out.append((seq[met], i[met], j[met]))
        i = i + (end_a <= end_b)
        j = j + (end_b <= end_a)
        live = (i < stop_i) & (j < stop_j)
    if not out:
        return (np.zeros(0, np.int64),) * 3
    seq, i, j = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(i, kind="stable")
    return seq[order], i[order], j[order]


def _group_texts(a: Encoded, b: Encoded, links) -> list[bytes]:
    """Each sequence's groups, written as ``a1,a2|b1;a3|b2``. Every sequence ends in a link."""
    _, at_a, at_b = links
    out: list[bytes] = []
    a_names, b_names = [str(x) for x in a.ids.tolist()], [str(x) for x in b.ids.tolist()]
    i = j = 0
    groups = []
    lasts = iter(np.flatnonzero(np.isin(at_a, a.first[1:] - 1)).tolist())
    last = next(lasts, -1)
    for k, (x, y) in enumerate(zip(at_a.tolist(), at_b.tolist())):
        groups.append(",".join(a_names[i:x + 1]) + "|" + ",".join(b_names[j:y + 1]))
        i, j = x + 1, y + 1
        if k == last:
            out.append(";".join(groups).encode())
            groups = []
            last = next(lasts, -1)
    return out


_PAIR = np.int64(1 << 32)


class Aligned:
    """Distinct sequences of a block, aligned: figures, group texts and links of each."""

    def __init__(self, pair: Pair, sequences: list[str]):
        a_ids, b_ids = pair.encode(sequences)
        data = [s.encode() for s in sequences]
        self.good = np.array([pair.gives(x, d, "a") and pair.gives(y, d, "b") for x, y, d in zip(a_ids, b_ids, data)], bool)
        none = np.zeros(0, np.int64)
        good = self.good.tolist()
        a = Encoded([x if g else none for x, g in zip(a_ids, good)], pair.a_size)
        b = Encoded([x if g else none for x, g in zip(b_ids, good)], pair.b_size)
        links = lockstep(a, b)
        n = len(sequences)
        self.n_a, self.n_b = np.diff(a.first), np.diff(b.first)
        self.n_links = np.bincount(links[0], minlength=n)
        texts = iter(_group_texts(a, b, links))
        self.texts = [next(texts) if g else b"" for g in good]
        self.links = a.ids[links[1]] * _PAIR + b.ids[links[2]]
        self.first = np.concatenate(([0], np.cumsum(self.n_links)))


_BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups array<string>, "
          "n array<long>, ids binary, n_sequences long, sizes binary, links binary, pairs array<long>, counts array<long>")


def _whole(values):
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _aligned_blocks(first: str, second: bytes, threads: int):
    def run(batches):
        pair, numbers = Pair(first, second, threads), BlockNumbers()
        for rows, _, _ in text_blocks(batches, size=_TEXT_BYTES):
            yield _aligned_block(pair, rows, numbers.next())
    return run


def _aligned_block(pair: Pair, rows: pa.RecordBatch, number: int) -> pa.RecordBatch:
    texts = rows.column("text").to_pylist()
    known: dict[str, int] = {}
    cut, n = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        if text:
            parts = [known.setdefault(s, len(known)) for s in sequences_of(text)]
            n[k] = len(parts)
            cut.append(np.array(parts, np.int64))
    ids = np.concatenate(cut) if cut else np.zeros(0, np.int64)
    found = Aligned(pair, list(known))
    first = np.concatenate(([0], np.cumsum(n)))

    def total(values):
        return np.diff(np.concatenate(([0], np.cumsum(values[ids])))[first]) if len(ids) else np.zeros(len(texts), np.int64)
    good = (n > 0) & (total((~found.good).astype(np.int64)) == 0)
    use = np.repeat(good, n)
    digests = []
    for k, ok in enumerate(good.tolist()):
        parts = ids[first[k]:first[k + 1]].tolist() if ok else []
        digests.append(hashlib.sha256(b";".join([found.texts[i] for i in parts])).hexdigest() if ok else "")
    figures = [np.where(good, total(x), 0) for x in (found.n_a, found.n_b, found.n_links)]
    ids = ids[use]
    times = np.bincount(ids, minlength=len(known))
    pairs, which = np.unique(found.links, return_inverse=True)
    counts = np.bincount(which, np.repeat(times, found.n_links), minlength=len(pairs)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), _whole(rows.column("doc_id")), *[_whole(pa.array(x)) for x in figures],
         _whole(pa.array(digests, pa.string())), _whole(pa.array(np.where(good, n, 0))),
         pa.array([packed(ids.astype(np.uint32))], pa.binary()),
         pa.array([len(known)]), pa.array([packed(found.n_links.astype(np.uint32))], pa.binary()),
         pa.array([packed(which.astype(np.uint32))], pa.binary()), _whole(pa.array(pairs)), _whole(pa.array(counts))],
        ["block", "doc_id", "n_a", "n_b", "n_groups", "groups", "n", "ids", "n_sequences", "sizes", "links", "pairs",
         "counts"])


_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _summed(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            n = row["n"].values.to_numpy()
            known = row["known"]
            count, best = known_values(known.values if known.is_valid else None, row["n_pairs"].as_py(), ["count", "best"])
            ids = unpacked(row["ids"].as_py(), int(n.sum()), np.uint32)
            size = unpacked(row["sizes"].as_py(), row["n_sequences"].as_py(), np.uint32).astype(np.int64)
            links = unpacked(row["links"].as_py(), int(size.sum()), np.uint32)
            edge = np.concatenate(([0], np.cumsum(size)))
            first = np.concatenate(([0], np.cumsum(n)))
            sums = []
            for values in (best, count):
                each = np.diff(np.concatenate(([0], np.cumsum(values[links])))[edge])
                sums.append(np.diff(np.concatenate(([0], np.cumsum(each[ids])))[first]))
            yield pa.RecordBatch.from_arrays(
                [*[row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")], *[pa.array(s) for s in sums],
                 row["groups"].values],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align_blocks(docs: DataFrame, first: str, second: bytes) -> DataFrame:
    """Stored blocks of aligned texts."""
    threads = int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(given.mapInArrow(_aligned_blocks(first, second, threads), _BLOCK), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best) of every linked id pair of the corpus."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("e")).select("e.*")
    total = each.where("counts > 0").groupBy("pairs").agg(F.sum("counts").alias("count"))
    total = materialize(total.withColumn("b", F.col("pairs").bitwiseAND(F.lit((1 << 32) - 1))), "pairs")
    top = total.groupBy("b").agg(F.max("count").alias("most"))
    return total.join(top, "b").select(
        F.col("pairs").alias("pair"), F.shiftright("pairs", 32).alias("a"), "b", "count",
        (F.col("count") == F.col("most")).cast("long").alias("best"))


def alignments(docs: DataFrame, first: str, second: bytes) -> DataFrame:
    """Figures of every document. ``first``: A's JSON; ``second``: B's model file."""
    blocks = align_blocks(docs, first, second)
    counts = materialize(pair_counts(blocks), "pair-counts")
    entries = blocks.select("block", F.posexplode("pairs").alias("i", "pair"))
    known = answers(entries, counts, ["pair"], ["count", "best"])
    sized = blocks.withColumn("n_pairs", F.size("pairs")).drop("pairs", "counts")
    return sized.join(known, "block", "left").mapInArrow(_summed, _RESULT)


def alignment_table(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    with open(first_path, encoding="utf-8") as file:
        return alignments(docs, file.read(), read_model(second_path))
