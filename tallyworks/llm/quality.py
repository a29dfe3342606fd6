"""Quality scores from random-indexing word vectors and a small numpy network.

Every token (a run of letters, of digits, or of one other sign) falls into one of a fixed
number of buckets. A bucket has a sparse random index vector; its word vector is
the sum of the index vectors of the tokens that stand up to two places from its
own occurrences, counted over all documents by Spark. The table of vectors has a
fixed size, so broadcasting it is safe for any corpus. A document is the mean and
spread of its tokens' vectors; a two-layer network on that is fitted on the driver
on at most ``sample`` labelled rows, and a temperature on a part of them set aside
makes its outputs probabilities.

Defined results: null and empty texts have the features of no token and get the
network's score for that; without labels, or with one kind only, every score is
the share of label 1 (0.5 if there are none); null labels and ids teach nothing; rows that
share a doc_id, repeated ones too, each get their own text's score and each teach the id's labels; of
rows with equal hashes at the sample's edge the smaller label stays; a text of any length is scored
whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import text_blocks, word_hashes
from tallyworks.llm.rowkeys import free_name
from tallyworks.session import materialize

BUCKETS, DIMS, NONZERO, REACH = 1 << 15, 32, 4, 2
_SLICE = 128
FEATURES = 2 * DIMS + 4


def _kinds() -> np.ndarray:
    """0 white space, 1 letters, 2 digits, 3 line ends, 4 other signs."""
    table = np.full(256, 4, np.int8)
    table[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
    table[0x0A] = 3
    table[0x30:0x3A] = 2
    table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = 1
    return table


def _tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token and the first token of each text."""
    kind = _kinds()[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = edge[-1] = True
    change = edge[:-1] | np.concatenate(([True], (kind[1:] != kind[:-1]) | ((kind[1:] == 4) & (buf[1:] != buf[:-1]))))[:len(buf)]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(buf))
    use = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[use], ends[use]
    # a run of one sign counts as its first three; another sign is another token
    ends = np.where(kind[starts] == 4, np.minimum(ends, starts + 3), ends)
    hashes = word_hashes(buf, starts, ends)
    return (hashes >> np.uint64(64 - 15)).astype(np.int64), np.searchsorted(starts, offs)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of every bucket's index vector."""
    rng = np.random.default_rng(11)
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.choice((-1.0, 1.0), (BUCKETS, NONZERO))


def _context(batches):
    """Sums of neighbours' index vectors over a task's texts, in slices of buckets."""
    place, sign = _index_vectors()
    total = np.zeros(BUCKETS * DIMS)
    for _, buf, offs in text_blocks(batches):
        bucket, first = _tokens(buf, offs)
        text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        for gap in range(1, REACH + 1):
            same = np.flatnonzero(text[gap:] == text[:-gap]) if len(text) > gap else np.zeros(0, np.int64)
            for here, there in ((bucket[same], bucket[same + gap]), (bucket[same + gap], bucket[same])):
                for k in range(NONZERO):
                    total += np.bincount(here * DIMS + place[there, k], sign[there, k], BUCKETS * DIMS)
    rows = total.astype(np.float32).reshape(-1, _SLICE * DIMS)
    some = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([rows[i].tobytes() for i in some],
                                                                             pa.binary())], ["slice", "sums"])


def _added(batches):
    """One row per slice, added as they come."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, sums in zip(batch.column("slice").to_pylist(), batch.column("sums")):
            values = np.frombuffer(sums.as_buffer(), np.float32)
            held[part] = held[part] + values if part in held else values.astype(np.float64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in held.values()], pa.binary())],
        ["slice", "sums"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vector of every bucket, from all documents."""
    schema = "slice int, sums binary"
    parts = docs.select("text").mapInArrow(_context, schema).withColumn("salt", F.spark_partition_id() % 16)
    sums = parts.repartition("slice", "salt").mapInArrow(_added, schema).repartition("slice").mapInArrow(_added, schema)
    vectors = np.zeros((BUCKETS // _SLICE, _SLICE * DIMS), np.float32)
    for row in sums.collect():
        vectors[row["slice"]] = np.frombuffer(row["sums"], np.float32)
    vectors = vectors.reshape(BUCKETS, DIMS)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def features(vectors: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Pooled vectors of all texts: mean, spread, likeness of neighbours, size."""
    bucket, first = _tokens(buf, offs)
    n = np.diff(first)
    out = np.zeros((len(n), FEATURES), np.float32)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    at, count = first[:-1][full], n[full][:, None]
    v = vectors[bucket]
    mean = np.add.reduceat(v, at) / count
    out[full, :DIMS] = mean
    out[full, DIMS:2 * DIMS] = np.sqrt(np.maximum(np.add.reduceat(v * v, at) / count - mean * mean, 0))
    for k, gap in enumerate((1, 2)):
        alike = np.zeros(len(bucket), np.float32)
        alike[gap:] = np.einsum("ij,ij->i", v[gap:], v[:-gap])
        for back in range(gap):
            alike[np.minimum(at + back, len(alike) - 1)] = 0
        out[full, 2 * DIMS + k] = np.add.reduceat(alike, at) / n[full]
    out[full, 2 * DIMS + 2] = np.linalg.norm(mean, axis=1)
    out[full, 2 * DIMS + 3] = np.log1p(n[full])
    return out


@dataclass
class Network:
    """Standardised inputs, one hidden layer, a logit over a temperature."""

    middle: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.middle) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, rounds: int = 60, seed: int = 3) -> Network:
    """Adam on mini-batches; every eighth row is kept to find the temperature."""
    share = float(y.mean()) if len(y) else 0.5
    width = x.shape[1]
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, hidden)), np.zeros(hidden), np.zeros(hidden),
                  float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share == 1 else -40.0))
    if not len(y) or not 0 < share < 1:
        return net
    rng = np.random.default_rng(seed)
    aside = np.arange(len(y)) % 8 == 7
    a, b = x[~aside].astype(float), y[~aside].astype(float)
    net.middle, net.scale = a.mean(axis=0), a.std(axis=0) + 1e-6
    a = (a - net.middle) / net.scale
    p = [rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), net.b2]
    first, second, step = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p], 0
    for turn in range(rounds):
        order, rate = rng.permutation(len(b)), 0.005 * (1 - turn / rounds) + 1e-4
        for at in range(0, len(b), 256):
            pick = order[at:at + 256]
            h = np.tanh(a[pick] @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - b[pick]) / len(pick)
            back = np.outer(error, p[2]) * (1 - h * h)
            slopes = [a[pick].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], error.sum()]
            step += 1
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p[i] = p[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p[0], p[1], p[2], float(p[3])
    if aside.any():
        logits, truth = net.logits(x[aside].astype(float)), y[aside]
        net.temperature = float(min(np.geomspace(0.1, 10, 81), key=lambda t: _loss(logits / t, truth)))
    return net


def _feature_rows(vectors: np.ndarray):
    def run(batches):
        for rows, buf, offs in text_blocks(batches, size=1 << 19):
            x = features(vectors, buf, offs)
            yield pa.RecordBatch.from_arrays(
                [rows.column("order"), rows.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["order", "label", "x"])
    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, sample: int) -> DataFrame:
    """(order, label, text) of at most ``sample`` labelled rows that are not held out.

    The rows with the lowest hash are taken; their ids are few enough to broadcast.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out).select(
        F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label"),
        F.xxhash64(F.col("doc_id").cast("long")).alias("order"))
    few = materialize(known.orderBy("order", "label").limit(sample), "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return texts.join(F.broadcast(few), "id").select("order", "label", "text")


def crc_share(modulus: int, rest: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``rest``; never true for a null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality",
                sample: int = 20_000) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, network from at most ``sample`` labelled rows."""
    vectors = word_vectors(docs)
    rows = sorted(labelled_sample(docs, labels, label, held_out, sample).mapInArrow(
        _feature_rows(vectors), "order long, label int, x binary").collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(-1, FEATURES)
    return vectors, fit_network(x, np.array([r["label"] for r in rows], float))


def _score_rows(vectors: np.ndarray, net: Network):
    def run(batches):
        for rows, buf, offs in text_blocks(batches, size=1 << 19):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(net.scores(features(vectors, buf, offs).astype(float)))],
                ["doc_id", "score"])
    return run


def quality_scores(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """(doc_id, score) of every text: probability of label 1."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score_rows(vectors, net), "doc_id long, score double")


def scored(scores: DataFrame, held_out: Column, threshold: float = 0.3) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; rows whose hash leaves 0 modulo 5 teach nothing."""
    held = crc_share(5, 0)
    return scored(quality_scores(docs, *fit_quality(docs, labels, held)), held)


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without texts that score below ``threshold``; all columns stay."""
    vectors, net = fit_quality(docs, labels, crc_share(5, 0))
    name = free_name(docs, "bad")
    bad = quality_scores(docs, vectors, net).where((F.col("score") < threshold) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, docs["doc_id"] == F.col(name), "left_anti")
