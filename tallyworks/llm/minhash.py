"""Near-duplicate documents by b-bit MinHash.

A text's set is its distinct shingles of lower-cased words. Texts with equal
sets form a class, and only the class's smallest doc_id goes on. Each class gets
``bands * rows`` minima: the full minima of a band make its key, and the low
``BITS`` bits of all minima, packed into longs, make the signature. Classes that
meet in a band are candidates; the share of equal signature places, corrected
for places that are equal by chance, estimates the similarity, and what could
reach the threshold is confirmed on the full sets.

Every class of a bucket is first held against the bucket's smallest one, so a
large group of near copies costs a row per member, not per pair. Buckets whose
members this leaves in different components are joined to families; in a family every
member outside its largest component is held against all members of other
components. That is done in blocks of bounded size, by signatures and then by full sets
inside the task, and only links leave the task: no link is lost and no pair is a row.

Recall: a pair at similarity s shares a band with probability
1 - (1 - s**rows)**bands; at 0.75 the standard 40 bands of 4 miss 2.5 in ten
million pairs. The estimate rejects only six standard deviations below the threshold.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; fewer words than a shingle are one shingle; rows
without doc_id stay alone, with a null component; rows that share a doc_id, repeated rows
among them, are one document that has the links of each, and each row gets its own set's size; of equal
sets, and of ties in a bucket, the smallest doc_id leads; a text of any length is one set; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.arrays import (
    Rolling, blocks, longs, lowered, mixed, space_words, text_blocks, text_bytes, word_hashes, word_spans,
)
from tallyworks.llm.rowkeys import as_ids, by_text, free_name, keyed_texts, shared_ids, texts_of
from tallyworks.session import discard, materialize

BITS = 2
_PER_LONG = 64 // BITS


def shingles(buf: np.ndarray, offs: np.ndarray, words: int = 5):
    """Sorted distinct shingle hashes of all texts of a block, and the first of each text."""
    buf = lowered(buf)
    starts, ends, first = word_spans(buf, offs, space_words())
    roll = Rolling(word_hashes(buf, starts, ends))
    at = np.arange(len(starts))
    text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    end = np.minimum(at + words, first[1:][text])
    use = (at + words == end) | (at == first[:-1][text])
    hashes, of = roll.of(at[use], end[use]), text[use]
    edge = np.searchsorted(of, np.arange(len(offs)))
    parts = [np.unique(hashes[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else hashes), np.concatenate(([0], np.cumsum(sizes)))


def _minima(hashes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """One row of ``count`` minima per text that has shingles."""
    rng = np.random.default_rng(7)
    times = rng.integers(1, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    plus = rng.integers(0, 1 << 32, count, dtype=np.uint32)
    low = mixed(hashes).astype(np.uint32)
    starts = first[:-1][np.diff(first) > 0]
    out = np.empty((len(starts), count), np.uint32)
    for i in range(count):
        out[:, i] = np.minimum.reduceat(low * times[i] + plus[i], starts) if len(starts) else 0
    return out


def _signatures(words: int, bands: int, rows: int):
    count = bands * rows

    def run(batches):
        for batch, buf, offs in text_blocks(batches, size=1 << 18):
            hashes, first = shingles(buf, offs, words)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            minima = _minima(hashes, first, count)
            keys = np.zeros((len(full), bands), np.uint64)
            for b in range(bands):
                key = np.full(len(full), b + 1, np.uint64)
                for r in range(rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, b * rows + r])
                keys[:, b] = key
            low = mixed(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
            packed = np.zeros((len(full), -(-count // _PER_LONG)), np.uint64)
            for i in range(count):
                packed[:, i // _PER_LONG] |= low[:, i] << np.uint64(BITS * (i % _PER_LONG))
            at = first[:-1][full]
            one, two = (np.zeros(len(sizes), np.uint64) for _ in range(2))
            if len(full):
                one[full] = np.add.reduceat(mixed(hashes + np.uint64(1)), at)
                two[full] = np.add.reduceat(mixed(hashes ^ np.uint64(0xC2B2AE3D27D4EB4F)), at)

            def lists(values):
                lengths = np.zeros(len(sizes), np.int32)
                lengths[full] = values.shape[1]
                return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)),
                                                longs(values.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), longs(one), longs(two), lists(keys), lists(packed)],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"])
    return run


def _estimate(a: Column, b: Column, count: int) -> Column:
    """Similarity from packed signatures, corrected for chance collisions."""
    ones = int("01" * (64 // BITS), 2)
    differ = F.lit(0)
    for i in range(-(-count // _PER_LONG)):
        apart = a[i].bitwiseXOR(b[i])
        differ = differ + F.bit_count(apart.bitwiseOR(F.shiftrightunsigned(apart, 1)).bitwiseAND(F.lit(ones)))
    equal = F.lit(1.0) - differ / F.lit(count)
    chance = 2.0 ** -BITS
    return (equal - F.lit(chance)) / F.lit(1 - chance)


def _floor(threshold: float, count: int) -> float:
    """Lowest estimate that a pair at the threshold may have: six standard deviations below."""
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * threshold
    return threshold - 6 * math.sqrt(p * (1 - p) / count) / (1 - chance)


def _confirm(words: int, percent: int):
    """Pairs whose full shingle sets are similar enough."""
    def run(batches):
        for batch in batches:
            buf, offs = text_bytes(batch.column("text_a"))
            for i, j in blocks(offs):
                pairs = batch.slice(i, j - i)
                mine, first = shingles(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], words)
                others = [x[p:q] for x, f in (shingles(b, o, words) for _, b, o in text_blocks([pairs], "text_b"))
                          for p, q in zip(f[:-1].tolist(), f[1:].tolist())]
                keep = np.zeros(j - i, bool)
                for k, other in enumerate(others):
                    both = np.concatenate((mine[first[k]:first[k + 1]], other))
                    both.sort()
                    shared = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep[k] = shared > 0 and 100 * shared >= percent * (len(both) - shared)
                yield pa.RecordBatch.from_arrays([pairs.column(c).filter(pa.array(keep)) for c in "ab"], ["a", "b"])
    return run


def _leftovers(words: int, percent: int, floor: float, count: int):
    """Links between members that ask and members of other components, block pair by block pair.

    Rows come sorted by (family, i, j); one such group is a block of askers and a block of members.
    """
    def group(rows: pa.Table):
        parts = [shingles(b, o, words) for _, b, o in text_blocks(rows.combine_chunks().to_batches())]
        sets = [x[p:q] for x, f in parts for p, q in zip(f[:-1].tolist(), f[1:].tolist())]
        rep, root, n = (rows.column(c).to_numpy() for c in ("rep", "root", "n"))
        asks, minor = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "minor"))
        sign = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        local = dict.fromkeys(root.tolist())
        local = {r: r for r in local}
        now = root.copy()
        out = []
        for x in np.flatnonzero(asks):
            other = ~asks & (now != local[int(root[x])]) & ~(minor & (rep < rep[x]))
            other &= (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            at = np.flatnonzero(other)
            at = at[_similar(sign[at], sign[x], count) >= floor]
            if not len(at):
                continue
            size = np.array([len(sets[y]) for y in at])
            values, mine = np.concatenate([sets[y] for y in at]), sets[x]
            hit = mine[np.minimum(np.searchsorted(mine, values), len(mine) - 1)] == values
            shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
            for y in at[100 * shared >= percent * (size + len(mine) - shared)].tolist():
                mine_now, theirs = local[int(root[x])], int(now[y])
                if mine_now != theirs:
                    out.append((int(rep[x]), int(rep[y])))
                    local = {r: mine_now if c == theirs else c for r, c in local.items()}
                    now[now == theirs] = mine_now
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables(
                [held, pa.Table.from_batches([batch])])
            keys = [table.column(c).to_numpy() for c in ("family", "i", "j")]
            cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
            edges = [0, *cuts.tolist()]
            for a, b in zip(edges[:-1], edges[1:]):
                yield group(table.slice(a, b - a))
            held = table.slice(edges[-1]) if table.num_rows else None
        if held is not None and held.num_rows:
            yield group(held)
    return run


def _similar(some: np.ndarray, one: np.ndarray, count: int) -> np.ndarray:
    """``_estimate`` on arrays of packed longs."""
    apart = (some ^ one).view(np.uint64)
    ones = np.uint64(int("01" * (64 // BITS), 2))
    differ = np.bitwise_count((apart | (apart >> np.uint64(1))) & ones).sum(axis=1)
    chance = 2.0 ** -BITS
    return (1 - differ / count - chance) / (1 - chance)


def _family_links(split: DataFrame, marks: DataFrame, texts: DataFrame, words: int, percent: int, floor: float,
                  count: int, askers: int = 256, block: int = 1024) -> DataFrame | None:
    """Links between components that share a bucket; ``split`` has key, rep and root."""
    parted = materialize(split.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                                  F.min("rep").alias("lead"))
                         .where("low <> high").select("key", "lead"), "parted")
    met = materialize(split.join(parted, "key").select("rep", "root", "lead").distinct(), "parted")
    if met.isEmpty():
        return None
    family = components(met.where("lead <> rep").select(F.col("lead").alias("a"), F.col("rep").alias("b")))
    people = met.select("rep", "root").distinct().join(
        family.select(F.col("id").alias("rep"), F.col("root").alias("family")), "rep")
    people = materialize(people, "people")
    shares = people.groupBy("family", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = materialize(shares.groupBy("family").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).select(
        "family", F.col("top.root").alias("most"),
        F.ceil((F.col("all") - F.col("top.n")) / askers).cast("int").alias("ni"),
        F.ceil(F.col("all") / block).cast("int").alias("nj")).where("ni > 0"), "families")
    full = people.join(largest, "family").withColumn("minor", F.col("root") != F.col("most")).join(marks, "rep").join(
        texts.withColumnRenamed("doc_id", "rep"), "rep")
    own_i, own_j = (F.pmod(F.xxhash64("rep", F.lit(k)), F.col(f"n{k}")).cast("int") for k in "ij")
    every_i, every_j = (F.sequence(F.lit(0), F.col(f"n{k}") - 1) for k in "ij")
    places = F.array_union(
        F.transform(every_i, lambda i: F.struct(i.alias("i"), own_j.alias("j"), F.lit(False).alias("asks"))),
        F.when(F.col("minor"), F.transform(every_j, lambda j: F.struct(own_i.alias("i"), j.alias("j"),
                                                                       F.lit(True).alias("asks"))))
        .otherwise(F.array().cast("array<struct<i:int,j:int,asks:boolean>>")))
    placed = full.withColumn("place", F.explode(places)).select(
        "family", "place.i", "place.j", "place.asks", "minor", "rep", "root", "n", "signature", "text")
    return materialize(placed.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(
        _leftovers(words, percent, floor, count), "a long, b long"), "confirmed")


def components(links: DataFrame) -> DataFrame:
    """(id, root): smallest id reachable over ``links`` (a, b), for every id in them.

    Large-star and small-star steps, each stored, until every link goes to a root.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
                        .where("v <> m").distinct(), "links")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = materialize(both.groupBy("v").agg(F.min("m").alias("low")).select(
            F.col("v").alias("u"), F.least("v", "low").alias("low")), "least")
        # every larger neighbour of u is tied to u's smallest neighbour
        star = materialize(both.join(least, both.m == least.u).where("v > m").select("v", F.col("low").alias("m"))
                           .where("v <> m").distinct(), "star")
        low = materialize(star.groupBy("v").agg(F.min("m").alias("low")), "least")
        # smaller neighbours of v, and v itself, are tied to the smallest of them
        tied = star.join(low, "v")
        edges = materialize(tied.select("v", F.col("low").alias("m")).union(
            tied.select(F.col("m").alias("v"), F.col("low").alias("m"))).where("v <> m").distinct(), "links")
    return edges.select(F.col("v").alias("id"), F.col("m").alias("root")).union(
        edges.select(F.col("m").alias("id"), F.col("m").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every id goes to one smaller id, which goes nowhere."""
    ids = edges.select("v", F.lit(1).alias("out")).union(edges.select(F.col("m").alias("v"), F.lit(0)).distinct())
    both = ids.groupBy("v").agg(F.sum("out").alias("out"), F.count(F.lit(1)).alias("n"))
    return both.where("out > 1 OR (out = 1 AND n > 1)").isEmpty()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further links (a, b): only the roots that they tie are worked on again."""
    a, b = (roots.select(F.col("id").alias(k), F.col("root").alias(f"r{k}")) for k in "ab")
    tied = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    more = materialize(components(tied), "roots").select(F.col("id").alias("root"), F.col("root").alias("newer"))
    moved = roots.join(more, "root", "left").select("id", F.coalesce("newer", "root").alias("root"))
    return moved.union(more.select(F.col("root").alias("id"), F.col("newer").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 40, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Two documents are linked if 100 * shared shingles >= ``percent`` * shingles of either.
    """
    texts = texts_of(docs)
    if not shared_ids(texts):
        return _near_duplicates(texts, words, percent, bands, rows)
    # texts are told apart by number; then documents are tied by what their texts are tied to
    keyed = keyed_texts(texts)
    found = materialize(_near_duplicates(as_ids(keyed), words, percent, bands, rows), "found")
    ids = keyed.select("key", F.col("doc_id").alias("id"))
    tied = found.join(ids, F.col("doc_id") == F.col("key")).select("component_id", F.col("id").alias("a")).join(
        ids, F.col("component_id") == F.col("key")).select("a", F.col("id").alias("b"))
    roots = materialize(components(tied), "roots")
    each = by_text(texts, found.select("doc_id", "n_shingles"), keyed).join(
        roots, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    named = each.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return named.union(_near_duplicates(texts.where("doc_id IS NULL"), words, percent, bands, rows))


def _near_duplicates(texts: DataFrame, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``near_duplicates`` of texts with distinct doc_ids."""
    count = bands * rows
    sets = materialize(texts.mapInArrow(
        _signatures(words, bands, rows), "doc_id long, n_shingles long, set_a long, set_b long, "
        "bands array<long>, signature array<long>"), "sets")
    known = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), "classes")
    reps = materialize(
        known.withColumnsRenamed({"doc_id": "rep", "n_shingles": "n"}).join(classes, ["set_a", "set_b", "rep"])
        .dropDuplicates(["set_a", "set_b", "rep"]).select("rep", "n", "bands", "signature"), "classes")
    exploded = reps.select("rep", F.explode("bands").alias("key"))
    buckets = materialize(exploded.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("top"))
                          .where("lead <> top").select("key", "lead"), "buckets")
    members = materialize(exploded.join(buckets, "key"), "members")
    floor = _floor(percent / 100, count)
    marks = reps.select("rep", "signature", "n")
    in_any = members.select("rep").distinct()
    some = materialize(texts.where("doc_id IS NOT NULL").join(in_any, F.col("doc_id") == F.col("rep"), "left_semi")
                       .groupBy("doc_id").agg(F.min("text").alias("text")), "candidates")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = (some.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        return materialize(pairs.select("a", "b").join(a, "a").join(b, "b").mapInArrow(
            _confirm(words, percent), "a long, b long"), "confirmed")

    def likely(pairs: DataFrame) -> DataFrame:
        a, b = (marks.select(F.col("rep").alias(c), F.col("signature").alias(f"s_{c}"), F.col("n").alias(f"n_{c}"))
                for c in "ab")
        fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        return materialize(pairs.join(a, "a").join(b, "b").where(
            fits & (_estimate(F.col("s_a"), F.col("s_b"), count) >= floor)).select("a", "b"), "pairs")

    links = confirmed(likely(members.where("lead <> rep").select(F.col("lead").alias("a"), F.col("rep").alias("b"))
                             .distinct()))
    roots = components(links)
    # what the stars left apart: members of one bucket in different components
    split = members.join(roots, members.rep == roots.id, "left").select(
        "key", "rep", F.coalesce("root", "rep").alias("root"))
    more = _family_links(split, marks, some, words, percent, floor, count)
    if more is not None and not more.isEmpty():
        roots = _joined(materialize(roots, "roots"), more)
    named = materialize(classes.join(roots, classes.rep == roots.id, "left").select(
        "set_a", "set_b", F.coalesce("root", "rep").alias("root")), "named")
    for table in (classes, reps, buckets, members, some):
        discard(table)
    return sets.drop("bands", "signature").join(named, ["set_a", "set_b"], "left").select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("root"))
        .otherwise(F.col("doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; all columns stay."""
    name = free_name(docs, "gone")
    gone = near_duplicates(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == F.col(name), "left_anti")
