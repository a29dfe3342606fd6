"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word's subwords are the hashes of the byte n-grams of ``<word>``, 3 to 6 long,
and of the word itself. The embeddings of all subwords of a passage of ``PASSAGE``
words are averaged and go through a linear softmax; a text scores as its most
toxic passage, so one insult in a long text is not averaged away. Embeddings and
softmax are learned together, so a misspelt word shares most of its vectors with
the word it comes from. The table of embeddings has a fixed size.

A toxic text teaches from its ``TOP`` highest passages at first and from two in the
end, as it is not known which of them made it toxic.

Fitted on the driver on at most ``sample`` labelled rows; scoring needs only each
bucket's share in the logit.

Defined results: null and empty texts score as a passage without subwords (the
softmax's bias); without labels, or with one kind only, every score is the share
of label 1 (0 if there are none); null labels and ids teach nothing; rows that share a doc_id, repeated ones
too, each get their own text's score and each teach the id's labels; of rows with equal hashes at the sample's
edge the smaller label stays; a text of any length is scored whole; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import (
    Rolling, byte_symbols, lowered, plain_words, ranges, text_blocks, word_hashes, word_spans,
)
from tallyworks.llm.quality import crc_share, labelled_sample, scored

BUCKETS, DIMS, SHORT, LONG, PASSAGE, TOP = 1 << 17, 8, 3, 6, 3, 8


def _words(buf: np.ndarray, offs: np.ndarray):
    """Lower-cased bytes, word starts and ends, first word of each text."""
    buf = lowered(buf)
    return buf, *word_spans(buf, offs, plain_words())


def _subwords(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of all given words, word after word, and how many each has."""
    size = ends - starts + 2
    place, word = ranges(starts - 1, ends + 1)
    first = np.cumsum(size) - size
    inner = np.arange(len(place)) - first[word]
    marked = np.where(inner == 0, 0x3C, np.where(inner == size[word] - 1, 0x3E,
                                                 buf[np.clip(place, 0, max(len(buf) - 1, 0))] if len(buf) else 0))
    roll = Rolling(byte_symbols(marked.astype(np.uint8)))
    kinds, of = [], []
    for n in range(SHORT, LONG + 1):
        at = np.flatnonzero(inner + n <= size[word])
        kinds.append(roll.of(at, at + n))
        of.append(word[at])
    kinds.append(roll.of(first, first + size) ^ np.uint64(0x5BF0363546290DAD))
    of.append(np.arange(len(size)))
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ((np.concatenate(kinds) >> np.uint64(64 - 17)).astype(np.int64)[order], np.bincount(of, minlength=len(size)))


def _passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each passage of all texts that have words, and the first passage of each text."""
    count = -(-np.diff(first) // PASSAGE)
    start, text = ranges(np.zeros(len(count), np.int64), count)
    return start * PASSAGE + first[:-1][text], np.concatenate(([0], np.cumsum(count)))


@dataclass
class Subwords:
    """Share of every bucket in the logit of label 1, and the softmax's bias."""

    share: np.ndarray
    bias: float

    def scores(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        buf, starts, ends, first = _words(buf, offs)
        out = np.full(len(offs) - 1, self.bias)
        if len(starts):
            hashes = word_hashes(buf, starts, ends)
            _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
            bucket, size = _subwords(buf, starts[one], ends[one])
            value = np.add.reduceat(self.share[bucket], np.cumsum(size) - size)
            begin, edge = _passages(first)
            logit = np.add.reduceat(value[which], begin) / np.add.reduceat(size[which], begin) + self.bias
            full = np.flatnonzero(np.diff(edge))
            out[full] = np.maximum.reduceat(logit, edge[:-1][full])
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def _training_words(texts: list[str]):
    """Number of each word, passages, and the subword buckets of the distinct words; worked off in blocks."""
    hashes, begins, edges, known = [], [], [np.zeros(1, np.int64)], {}
    words = passages = 0
    for _, buf, offs in text_blocks([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})], size=1 << 20):
        buf, starts, ends, first = _words(buf, offs)
        own = word_hashes(buf, starts, ends)
        fresh, one = np.unique(own, return_index=True)
        new = [(h, buf[starts[i]:ends[i]].tobytes()) for h, i in zip(fresh.tolist(), one.tolist()) if h not in known]
        known.update(new)
        begin, edge = _passages(first)
        hashes.append(own)
        begins.append(begin + words)
        edges.append(edge[1:] + passages)
        words, passages = words + len(own), passages + len(begin)
    order = np.array(sorted(known), np.uint64)
    which = np.concatenate([np.searchsorted(order, h).astype(np.int32) for h in hashes])
    buckets, sizes = [], []
    for lo in range(0, len(order), 20_000):
        part = b" ".join(known[h] for h in order[lo:lo + 20_000].tolist())
        buf = np.frombuffer(part, np.uint8)
        starts, ends, _ = word_spans(buf, np.array([0, len(buf)]), plain_words())
        bucket, size = _subwords(buf, starts, ends)
        buckets.append(bucket.astype(np.int32))
        sizes.append(size)
    return (which, np.concatenate(begins), np.concatenate(edges), np.concatenate(buckets or [np.zeros(0, np.int32)]),
            np.concatenate(sizes or [np.zeros(0, np.int64)]))


def fit_subwords(texts: list[str], y: np.ndarray, rounds: int = 12, steps: int = 400, seed: int = 5) -> Subwords:
    """Adagrad over texts; each round learns from the passages that score highest now.

    At least ``rounds`` rounds, and as many as ``steps`` mini-batches need.
    """
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Subwords(np.zeros(BUCKETS), 40.0 if share == 1 else -40.0)
    which, begin, edge, bucket, size = _training_words(texts)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMS))
    head = rng.normal(0, 1, (DIMS, 2))
    bias = np.array([0.0, np.log(share / (1 - share))])
    seen, head_steps, bias_steps = np.full(BUCKETS, 1e-8), np.full(head.shape, 1e-8), np.full(2, 1e-8)
    at = np.cumsum(size) - size
    stop = np.append(begin[1:], len(which))
    full = np.flatnonzero(np.diff(edge))
    total = np.add.reduceat(size[which], begin)
    rounds = max(rounds, -(-steps * 64 // len(texts)))
    for turn in range(rounds):
        scalar = vectors @ (head[:, 1] - head[:, 0])
        logit = np.add.reduceat(np.add.reduceat(scalar[bucket], at)[which], begin) / total
        # a text teaches from its highest passages, clean ones also from some picked at random
        high = max(2, TOP * (rounds - turn) // rounds)
        best = [a + np.argsort(-logit[a:b])[:high] for a, b in zip(edge[full].tolist(), edge[full + 1].tolist())]
        owner = np.repeat(np.arange(len(full)), [len(x) for x in best])
        clean = np.flatnonzero(y[full] == 0)
        clean = np.repeat(clean, 2)
        other = edge[full][clean] + (rng.random(len(clean)) * np.diff(edge)[full][clean]).astype(np.int64)
        chosen = np.concatenate((*best, other))
        truth = np.concatenate((y[full][owner], np.zeros(len(other)))).astype(np.int64)
        order = rng.permutation(len(chosen))
        for lo in range(0, len(order), 64):
            pick = order[lo:lo + 64]
            part = chosen[pick]
            word, row = ranges(begin[part], stop[part])
            word = which[word]
            gram, of_word = ranges(at[word], at[word] + size[word])
            gram, row = bucket[gram], row[of_word]
            count = np.bincount(row, minlength=len(pick)).astype(float)
            mean = np.zeros((len(pick), DIMS))
            for k in range(DIMS):
                mean[:, k] = np.bincount(row, vectors[gram, k], len(pick)) / count
            z = mean @ head + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True)
            error[np.arange(len(pick)), truth[pick]] -= 1
            back = (error @ head.T) / count[:, None]
            used, place = np.unique(gram, return_inverse=True)
            slope = np.zeros((len(used), DIMS))
            for k in range(DIMS):
                slope[:, k] = np.bincount(place, back[row, k], len(used))
            seen[used] += np.mean(slope * slope, axis=1)
            vectors[used] -= 0.3 * slope / np.sqrt(seen[used])[:, None]
            up, low = mean.T @ error, error.sum(axis=0)
            head_steps += up * up
            head -= 0.05 * up / np.sqrt(head_steps)
            bias_steps += low * low
            bias -= 0.05 * low / np.sqrt(bias_steps)
    return Subwords(vectors @ (head[:, 1] - head[:, 0]), float(bias[1] - bias[0]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic",
                 sample: int = 6000) -> Subwords:
    """Model from at most ``sample`` labelled texts."""
    rows = sorted(labelled_sample(docs, labels, label, held_out, sample).where("text IS NOT NULL").collect())
    return fit_subwords([r["text"] for r in rows], np.array([r["label"] for r in rows], float))


def toxicity_scores(docs: DataFrame, model: Subwords) -> DataFrame:
    """(doc_id, score) of every text: probability of label 1."""
    def run(batches):
        for rows, buf, offs in text_blocks(batches, size=1 << 20):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(model.scores(buf, offs))],
                                             ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; rows whose hash leaves 2 modulo 4 teach nothing."""
    held = crc_share(4, 2)
    return scored(toxicity_scores(docs, fit_toxicity(docs, labels, held)), held)
