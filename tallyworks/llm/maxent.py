"""Language-model scores by a hashed maximum-entropy model.

Tokens are lower-cased words and one end per text. A token's probability is that
of its class, given the three words before it, times its share of the class:

* Classes hold words of alike count and language (from the corpus-wide counts), all
  of about the same mass; the end and the unseen word are classes of their own. Every
  word of the training texts is in the model: its share is (count - D) / mass of its class.
* The class softmax adds up weight rows, one per active feature: the classes of the last two
  words together, the class three words back (skip), and hashed word features: the word
  before (bigram), the one before that (skip) and both (trigram).
  The hashed rows number about ``8 * sqrt(distinct words)``, so the table follows the corpus
  and is still some 100 MB for 10^10 distinct words; it is what is sent to the tasks.
* D is the discount n1 / (n1 + 2 n2). A training token of count c counts as unseen for
  D / c of its weight, so unseen words get the mass that the corpus itself shows for them.

Training walks the training texts once, in waves of 1, 1, 2, 4 and 8 sixteenths. In a
wave every task sums observed and expected counts per weight row, whose difference is the
gradient; Spark adds them up; a step divides the gradient by the expected counts so far, which
bound the curvature. Scoring works on blocks in sparse batches.

The model is a proper distribution over the training words, the end, and one symbol
for all unseen words, the same events as those of the base score.

Defined results: a null or empty text is one end token; every row gets a row, repeated
rows and doc_ids included, and counts as a text of its own; a null doc_id counts as not held
out; equal counts are equal classes, whatever their order; without training texts all is unseen and
every score is 0; an empty table gives no rows; a very long text is a block of its own; other
columns are not read, but for ``lang``, which only orders words into classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import lowered, mixed, ranges, space_words, text_blocks, word_hashes
from tallyworks.llm.vocabulary import BlockNumbers, dealt, dictionary, packed, unpacked, word_bytes, words_of
from tallyworks.session import discard, free_shuffles, materialize

CLASSES = 32
LANGS = 64
BINS = 4
WAVES = ((0, 1), (1, 2), (2, 4), (4, 8), (8, 16))
BATCH = 2048
CHUNK = 1 << 16
# Bytes of texts in a block, and of the corpus per hash range of words.
BLOCK_BYTES, RANGE_BYTES = 4 << 20, 16 << 20

_BLOCK = ("block long, doc_id array<long>, train array<boolean>, n array<long>, ids binary, hashes binary, size long, "
          "words binary, bytes long, sizes binary, pairs long, pair_word binary, pair_lang binary, pair_n binary, text_bytes long")


def _whole(values):
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _row(**values) -> pa.RecordBatch:
    """One row; bytes become binary, whole numbers long, arrays one list."""
    kinds = {bytes: pa.binary(), int: pa.int64()}
    columns = [pa.array([v], kinds[type(v)]) if type(v) in kinds else _whole(v) for v in values.values()]
    return pa.RecordBatch.from_arrays(columns, list(values))


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k] for c in batch.schema.names}


def _high(data: bytes, n: int) -> np.ndarray:
    """Stored word hashes (their upper 32 bits) as 64-bit ones."""
    return unpacked(data, n, np.uint32).astype(np.uint64) << np.uint64(32)


def _blocks(batches):
    numbers = BlockNumbers()
    for rows, buf, offs in text_blocks(batches, size=BLOCK_BYTES):
        buf = lowered(buf)
        words, ids, _, _, first = dictionary(buf, offs, space_words())
        n = np.diff(first)
        train = rows.column("train").to_numpy(zero_copy_only=False)
        lang = np.repeat(rows.column("lang").to_numpy(zero_copy_only=False).astype(np.int64), n)
        some = np.repeat(train, n)
        pair, count = np.unique(ids[some] * LANGS + lang[some], return_counts=True)
        data, sizes = word_bytes(words)
        # of the distinct words alone: hashes of a whole block take some 50 bytes for each of its bytes
        stop = np.cumsum(sizes)
        hashes = word_hashes(data, stop - sizes, stop)
        yield _row(block=numbers.next(), doc_id=rows.column("doc_id"), train=rows.column("train"), n=pa.array(n),
                   ids=packed(ids.astype(np.uint32)), hashes=packed((hashes >> np.uint64(32)).astype(np.uint32)),
                   size=len(words), words=packed(data),
                   bytes=len(data), sizes=packed(sizes.astype(np.uint32)), pairs=len(pair),
                   pair_word=packed((pair // LANGS).astype(np.uint32)), pair_lang=packed((pair % LANGS).astype(np.uint8)),
                   pair_n=packed(count.astype(np.uint32)), text_bytes=len(buf))


_RUN = ("block long, part long, n long, words binary, bytes long, sizes binary, pairs long, pair_word binary, "
        "pair_lang binary, pair_n binary")


def _runs(parts: int):
    """A block's dictionary by hash range: words, and their training counts per language."""
    def run(batches):
        for row in _rows(batches):
            n, pairs = row["size"].as_py(), row["pairs"].as_py()
            order, found, first = dealt(_high(row["hashes"].as_py(), n), parts)
            sizes = unpacked(row["sizes"].as_py(), n, np.uint32).astype(np.int64)
            stop = np.cumsum(sizes)
            take, _ = ranges((stop - sizes)[order], stop[order])
            data, sizes = unpacked(row["words"].as_py(), row["bytes"].as_py(), np.uint8)[take], sizes[order]
            edge = np.concatenate(([0], np.cumsum(sizes)))
            place = np.empty(n, np.int64)
            place[order] = np.arange(n)
            at = place[unpacked(row["pair_word"].as_py(), pairs, np.uint32)]
            by = np.argsort(at, kind="stable")
            at = at[by]
            lang, count = (unpacked(row[c].as_py(), pairs, k)[by] for c, k in (("pair_lang", np.uint8), ("pair_n", np.uint32)))
            for k, i, j in zip(found.tolist(), first[:-1].tolist(), first[1:].tolist()):
                p, q = np.searchsorted(at, (i, j)).tolist()
                yield _row(block=row["block"].as_py(), part=k, n=j - i, words=packed(data[edge[i]:edge[j]]),
                           bytes=int(edge[j] - edge[i]), sizes=packed(sizes[i:j].astype(np.uint32)), pairs=q - p,
                           pair_word=packed((at[p:q] - i).astype(np.uint32)), pair_lang=packed(lang[p:q]),
                           pair_n=packed(count[p:q]))
    return run


_COUNTED = ("block long, part long, n long, counts binary, langs binary, "
            "cells array<struct<lang:int,bin:int,c:long,n:long,one:long,two:long>>")


def _bin(count: np.ndarray) -> np.ndarray:
    return (np.log2(count) * BINS).astype(np.int64)


def _counted(table: pa.Table) -> pa.Table:
    """Of one hash range: for each run its words' training counts and main languages; a row without block for the classes."""
    rows = list(_rows(table.to_batches()))
    every, at, keys, counts = [], 0, [], []
    for row in rows:
        n, pairs = row["n"].as_py(), row["pairs"].as_py()
        every.append(words_of(unpacked(row["words"].as_py(), row["bytes"].as_py(), np.uint8),
                              unpacked(row["sizes"].as_py(), n, np.uint32)))
        word = unpacked(row["pair_word"].as_py(), pairs, np.uint32).astype(np.int64) + at
        keys.append(word * LANGS + unpacked(row["pair_lang"].as_py(), pairs, np.uint8))
        counts.append(unpacked(row["pair_n"].as_py(), pairs, np.uint32).astype(np.int64))
        at += n
    coded = pa.concat_arrays(every).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    pair, which = np.unique(index[keys // LANGS] * LANGS + keys % LANGS, return_inverse=True)
    n = np.bincount(which, counts, minlength=len(pair)).astype(np.int64)
    word, lang_of = pair // LANGS, pair % LANGS
    c = np.bincount(word, n, minlength=len(coded.dictionary)).astype(np.int64)
    lang = np.zeros(len(coded.dictionary), np.uint8)
    # of a word's languages the one with most of it, ties to the smaller one
    best = np.lexsort((lang_of, -n, word))
    best = best[np.unique(word[best], return_index=True)[1]]
    lang[word[best]] = lang_of[best]
    seen = c > 0
    cell, of = np.unique(lang[seen].astype(np.int64) * 64 * BINS + _bin(c[seen]), return_inverse=True)
    sums = [np.bincount(of, x, minlength=len(cell)).astype(np.int64) for x in (c[seen], c[seen] > 0, c[seen] == 1, c[seen] == 2)]
    cells = pa.StructArray.from_arrays(
        [pa.array((cell // (64 * BINS)).astype(np.int32)), pa.array((cell % (64 * BINS)).astype(np.int32)),
         *[pa.array(x) for x in sums]], ["lang", "bin", "c", "n", "one", "two"])
    out, at = [(None, None, None, None, None)], 0
    for row in rows:
        n = row["n"].as_py()
        some = index[at:at + n]
        out.append((row["block"].as_py(), row["part"].as_py(), n, packed(c[some]), packed(lang[some])))
        at += n
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    lists = pa.ListArray.from_arrays(pa.array([0, *[len(cells)] * len(out)], pa.int32()), cells)
    return pa.table([*[pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], lists],
                    ["block", "part", "n", "counts", "langs", "cells"])


@dataclass
class Vocabulary:
    """Figures of the training words that fit the driver: none grows with the number of words."""

    tokens: int
    distinct: int
    texts: int
    discount: float
    cells: np.ndarray
    mass: np.ndarray

    @property
    def unseen(self) -> int:
        return len(self.mass) - 1

    @property
    def end(self) -> int:
        """Class of the end of a text; without training texts that is unseen too."""
        return len(self.mass) - (2 if self.texts else 1)

    def classes(self, count: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Class of words with these counts (0: unseen) and languages."""
        out = self.cells[lang, _bin(np.maximum(count, 1))]
        return np.where(count > 0, out, self.unseen)


def vocabulary(counted: DataFrame, texts: int, classes: int = CLASSES) -> Vocabulary:
    """Classes of about equal mass over (language, count) cells, most frequent words first."""
    found = counted.where("block IS NULL").select(F.inline("cells")).groupBy("lang", "bin").agg(
        *[F.sum(k).alias(k) for k in ("c", "n", "one", "two")]).collect()
    total, distinct = sum(r.c for r in found), sum(r.n for r in found)
    one, two = sum(r.one for r in found), sum(r.two for r in found)
    discount = min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5
    cells, mass, at = np.zeros((LANGS, 64 * BINS), np.int64), np.zeros(classes), 0.0
    for r in sorted(found, key=lambda r: (r.lang, -r.bin)):
        k = min(classes - 3, int(at / total * (classes - 2)))
        cells[r.lang, r.bin] = k
        mass[k] += r.c - discount * r.n
        at += r.c
    mass[-2], mass[-1] = texts, discount * distinct if distinct or texts else 1.0
    return Vocabulary(total + texts, distinct + bool(texts), texts, discount, cells, mass)


def _coded(voc: Vocabulary, parts: int):
    """Blocks with the counts and classes of their words in place of the words."""
    def run(batches):
        for row in _rows(batches):
            size = row["size"].as_py()
            order, _, _ = dealt(_high(row["hashes"].as_py(), size), parts)
            count, lang = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if size:
                known = row["known"].values
                by = np.argsort(known.field("part").to_numpy())
                n = known.field("n").to_pylist()
                for out, name, kind in ((count, "counts", np.int64), (lang, "langs", np.uint8)):
                    held = known.field(name).to_pylist()
                    out[order] = np.concatenate([unpacked(held[k], n[k], kind) for k in by.tolist()])
            yield _row(**{c: row[c].values for c in ("doc_id", "train", "n")}, ids=row["ids"].as_py(), hashes=row["hashes"].as_py(),
                       size=size, counts=packed(count), classes=packed(voc.classes(count, lang).astype(np.uint8)))
    return run


_CODED = ("doc_id array<long>, train array<boolean>, n array<long>, ids binary, hashes binary, size long, "
          "counts binary, classes binary")


def hashed_rows(distinct: int) -> int:
    """Weight rows for hashed word features: a power of two near 8 * sqrt(distinct words)."""
    return 1 << max(10, int(np.ceil(np.log2(8 * np.sqrt(max(distinct, 1))))))


class Features:
    """Weight rows that are active at each token of a block."""

    active = 5

    def __init__(self, classes: int, hashed: int):
        self.outside = classes
        k = classes + 1
        self.sizes = [k * k, k, hashed, hashed, hashed]
        self.at = [0, k * k, k * k + k, k * k + k, k * k + k]
        self.rows = k * k + k + hashed
        self.mask = np.uint64(hashed - 1)

    def of(self, cls: np.ndarray, hashes: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Rows per feature, of every token; ``place``: each token's number in its text."""
        one, two, three = (self._back(cls, place, j, self.outside) for j in (1, 2, 3))
        mixes = mixed(hashes)
        u, t = (self._back(mixes, place, j, np.uint64(j)) for j in (1, 2))
        hashed = (u, t * np.uint64(3) + np.uint64(1), (u + t * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17))
        return [one * (self.outside + 1) + two, three + self.at[1],
                *[(h & self.mask).astype(np.int64) + self.at[2] for h in hashed]]

    @staticmethod
    def _back(values, place, j, outside):
        out = np.empty_like(values)
        out[j:] = values[:-j] if j < len(values) else outside
        out[:j] = outside
        out[place < j] = outside
        return out


def _exponentials(weights: np.ndarray, rows: list[np.ndarray], out: np.ndarray, spare: np.ndarray, targets: np.ndarray):
    """Into ``out`` the exponentials of each class's summed weights; returns the targets' sums and the totals."""
    np.take(weights, rows[0], axis=0, out=out, mode="clip")
    for r in rows[1:]:
        np.take(weights, r, axis=0, out=spare, mode="clip")
        out += spare
    target = out[np.arange(len(out)), targets]
    np.exp(out, out=out)
    return target, out @ np.ones(out.shape[1], np.float32)


def _tokens(row: dict, voc: Vocabulary, texts: np.ndarray | None = None):
    """Per token of a stored block, ends included: class, count, hash, number in its text; tokens per text.

    ``texts``: which of the block's texts are wanted.
    """
    n = row["n"].values.to_numpy()
    ids = unpacked(row["ids"].as_py(), int(n.sum()), np.uint32)
    if texts is not None:
        ids, n = ids[np.repeat(texts, n)], n[texts]
    size = row["size"].as_py()
    cls, count, hashes = (unpacked(row[c].as_py(), size, k) for c, k in (
        ("classes", np.uint8), ("counts", np.int64), ("hashes", np.uint32)))
    per = n + 1
    stop = np.cumsum(per)
    place = np.arange(int(per.sum())) - np.repeat(stop - per, per)
    inner = np.ones(len(place), bool)
    inner[stop - 1] = False

    def with_ends(values, end, kind):
        out = np.full(len(place), end, kind)
        out[inner] = values[ids]
        return out
    return (with_ends(cls, voc.end, np.int64), with_ends(count, voc.texts, np.int64),
            with_ends(hashes, 0, np.uint64), place, per)


def _gradients(voc: Vocabulary, features: Features, weights, wave: tuple[int, int]):
    """Observed minus expected counts, and expected counts, per weight row over the texts of a wave, summed in the task."""
    k = len(voc.mass)

    def run(batches):
        w = weights.value
        expected, gap = np.zeros((k, features.rows), np.float32), np.zeros(features.rows * k, np.float32)
        out, spare = np.empty((BATCH, k), np.float32), np.empty((BATCH, k), np.float32)
        chunk = np.empty((k, CHUNK), np.float32)
        for row in _rows(batches):
            trains = row["train"].values.to_numpy(zero_copy_only=False).astype(bool)
            slot = np.arange(len(trains)) % 16
            cls, count, hashes, place, per = _tokens(row, voc, trains & (slot >= wave[0]) & (slot < wave[1]))
            if not len(cls):
                continue
            every = features.of(cls, hashes, place)
            lost = np.where(cls == voc.end, 0, voc.discount / np.maximum(count, 1)).astype(np.float32)
            for a in range(0, len(cls), CHUNK):
                b = min(len(cls), a + CHUNK)
                for i in range(a, b, BATCH):
                    j = min(b, i + BATCH)
                    p = out[:j - i]
                    _, total = _exponentials(w, [r[i:j] for r in every], p, spare[:j - i], cls[i:j])
                    p /= total[:, None]
                    chunk[:, i - a:j - a] = p.T
                for r, at, size in zip(every, features.at, features.sizes):
                    some = r[a:b] - at
                    for c in range(k):
                        expected[c, at:at + size] += np.bincount(some, chunk[c, :b - a], minlength=size)
                    held = np.bincount(some * k + cls[a:b], 1 - lost[a:b], minlength=size * k)
                    held += np.bincount(some * k + voc.unseen, lost[a:b], minlength=size * k)
                    gap[at * k:(at + size) * k] += held
        expected = expected.T
        gap = gap.reshape(-1, k) - expected
        got = np.flatnonzero(expected.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(got.astype(np.int32)),
             *[pa.array(np.ascontiguousarray(x[got, j])) for x in (gap, expected) for j in range(k)]],
            ["row", *[f"v{j}" for j in range(2 * k)]])
    return run


def train(coded: DataFrame, voc: Vocabulary, prior: float = 2.0) -> tuple[Features, np.ndarray]:
    """Weights after one walk over the training texts, in waves."""
    spark = coded.sparkSession
    k = len(voc.mass)
    features = Features(k, hashed_rows(voc.distinct))
    total = max(voc.mass.sum(), 1.0)
    weights = np.zeros((features.rows, k), np.float32)
    weights[:features.sizes[0]] = np.log(np.maximum(voc.mass, 1e-20 * total) / total)
    met = np.zeros((features.rows, k))
    columns = [f"v{j}" for j in range(2 * k)]
    for wave in WAVES if voc.texts else ():
        sent = spark.sparkContext.broadcast(weights)
        found = coded.mapInArrow(_gradients(voc, features, sent, wave), "row int, " + ", ".join(f"{c} float" for c in columns)) \
            .groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
        sent.destroy()
        row = found.column("row").to_numpy()
        values = np.stack([found.column(c).to_numpy() for c in columns], axis=1)
        met[row] += values[:, k:]
        weights = weights.copy()
        step = values[:, :k] / (features.active * met[row] / 2 + prior)
        weights[row] = np.clip(weights[row] + step, -15, 15)
    return features, weights


def _scores(voc: Vocabulary, features: Features, weights):
    def run(batches):
        w = weights.value
        mass = np.log(np.maximum(voc.mass, 1e-300))
        out, spare = np.empty((BATCH, len(mass)), np.float32), np.empty((BATCH, len(mass)), np.float32)
        for row in _rows(batches):
            cls, count, hashes, place, per = _tokens(row, voc)
            every = features.of(cls, hashes, place)
            logs = np.empty(len(cls))
            for i in range(0, len(cls), BATCH):
                j = min(len(cls), i + BATCH)
                target, total = _exponentials(w, [r[i:j] for r in every], out[:j - i], spare[:j - i], cls[i:j])
                logs[i:j] = target - np.log(total)
            known = (count > 0) & (cls != voc.end)
            share = np.where(known, np.log(np.maximum(count - voc.discount, 1e-9)) - mass[cls], 0.0)
            base = np.log(count + 1.0) - np.log(float(voc.tokens + voc.distinct + 1))
            first = np.cumsum(per) - per
            sums = [np.add.reduceat(x, first) / np.log(10.0) for x in (base, logs + share)]
            trains = row["train"].values.to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [row["doc_id"].values, pa.array(~trains), pa.array(per),
                 pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
                 pa.array(np.full(len(per), voc.tokens)), *[pa.array(s) for s in sums]],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: Column, parts: int = 7, which: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == which, F.lit(False))


def language_scores(docs: DataFrame, parts: int = 7, which: int = 2) -> DataFrame:
    """Base and model log10 probability of every text; learned from those that are not held out."""
    lang = F.pmod(F.crc32(F.coalesce(F.col("lang").cast("string"), F.lit(""))), F.lit(LANGS)) \
        if "lang" in docs.columns else F.lit(0)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        (~held_out(F.col("doc_id"), parts, which)).alias("train"), lang.cast("int").alias("lang"))
    blocks = materialize(given.mapInArrow(_blocks, _BLOCK), "blocks")
    about = blocks.agg(F.sum("text_bytes").alias("bytes"), F.sum(F.size(F.filter("train", lambda t: t))).alias("texts")).first()
    hash_ranges = max(8, -(-(about.bytes or 0) // RANGE_BYTES))
    runs = blocks.select("block", "size", "hashes", "words", "bytes", "sizes", "pairs", "pair_word", "pair_lang", "pair_n")
    counted = materialize(runs.mapInArrow(_runs(hash_ranges), _RUN).groupBy("part").applyInArrow(_counted, _COUNTED), "counted")
    free_shuffles(docs.sparkSession)
    voc = vocabulary(counted, about.texts or 0)
    known = counted.where("block IS NOT NULL").groupBy("block").agg(
        F.collect_list(F.struct("part", "n", "counts", "langs")).alias("known"))
    coded = materialize(blocks.select("block", "doc_id", "train", "n", "ids", "hashes", "size").join(known, "block", "left")
                        .mapInArrow(_coded(voc, hash_ranges), _CODED), "coded")
    discard(blocks)
    discard(counted)
    free_shuffles(docs.sparkSession)
    features, weights = train(coded, voc)
    return coded.mapInArrow(_scores(voc, features, docs.sparkSession.sparkContext.broadcast(weights)), _SCORE)
