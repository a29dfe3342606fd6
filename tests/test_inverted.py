"""Best-n search on the inverted index against all scores; what it leaves unread."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyworks.operators import inverted, text_blocks, words
from tallyworks.session import discard
from tests.conftest import executed_plan


def corpus(seed: int, n: int = 400):
    """Texts of very different lengths over few words, with equal texts for ties."""
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(60)]
    out = []
    for i in range(n):
        size = rng.choice([1, 2, 3, 8, 40, 120])
        out.append((i, " ".join(rng.choices(names, [1 / (k + 1) for k in range(60)], k=size))))
    return out + [(n + k, out[k][1]) for k in range(60)]


def every_score(weights, query):
    of = {}
    for r in weights.collect():
        if r["word"] in query:
            of[r["id"]] = of.get(r["id"], 0.0) + r["weight"] * query[r["word"]]
    return sorted(((round(s, 6), i) for i, s in of.items()), key=lambda x: (-x[0], x[1]))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    old, inverted.BLOCK_TEXTS, ranges, inverted.RANGE_POSTINGS = inverted.BLOCK_TEXTS, 8, inverted.RANGE_POSTINGS, 300
    path = str(tmp_path_factory.mktemp("index"))
    weights, idf = words.text_weights(spark.createDataFrame(corpus(1), "id long, t string"), "id", "t")
    inverted.build(weights, "id", idf, path)
    inverted.BLOCK_TEXTS, inverted.RANGE_POSTINGS = old, ranges
    return weights, inverted.Index(spark, path)


@pytest.mark.parametrize("text", ["w0 w1", "w59", "w3 w3 w40 nothing", "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w50", "nothing", ""])
@pytest.mark.parametrize("n", [1, 20, 1000])
def test_search_equals_all_scores(spark, stored, text, n):
    weights, index = stored
    query = index.query(spark.createDataFrame([(text,)], "t string"), "t")
    want = every_score(weights, {w: x for w, _, x in query})[:n]
    got = [(round(r["similarity"], 6), r["id"]) for r in index.search(query, n).collect()]
    assert got == want


def test_query_weights_are_those_of_the_table_join(spark, stored):
    _, index = stored
    asked = spark.createDataFrame([("w1 w1 w7",), ("w9 unknown",)], "t string")
    want = {r["word"]: r["query_weight"] for r in words.query_weights(asked, "t", index.vocabulary()).collect()}
    assert {w: pytest.approx(x) for w, _, x in index.query(asked, "t")} == want


def test_blocks_that_cannot_reach_the_result_are_left_out(spark, stored):
    weights, index = stored
    query = index.query(spark.createDataFrame([("w45",)], "t string"), "t")
    rows = spark.createDataFrame(query, "word string, h long, query_weight double")
    limits = index.block_limits(rows, [query[0][1]])
    best = index.search(query, 3).collect()
    condition = index.reachable(limits, best[-1]["similarity"] - inverted.SLACK)
    kept = {r["block"] for r in limits.where(condition).collect()}
    assert 0 < len(kept) < limits.count()
    of = {r["block"]: r["most"] for r in limits.collect()}
    assert all(block in kept for block, most in of.items() if most >= best[-1]["similarity"])


def test_plan_prunes_folders_and_row_groups(spark, stored):
    _, index = stored
    query = index.query(spark.createDataFrame([("w45 w2",)], "t string"), "t")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = executed_plan(index.search(query, 5))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "postings" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*range#\d+ IN|PartitionFilters: \[[^\]]*\(range#\d+ = ", scan)
    pushed = scan[scan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(h," in pushed and "GreaterThanOrEqual(block," in pushed
    hashes = {h for _, h, _ in query}
    every = spark.read.parquet(f"{index.path}/postings").inputFiles()
    held = groups = 0
    for file in every:
        meta = pq.ParquetFile(file.removeprefix("file:").replace("///", "/")).metadata
        at = meta.schema.names.index("h")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups += 1
            held += any(stats.min <= h <= stats.max for h in hashes)
    assert held < groups


def test_intervals_cover_and_are_few():
    rng = random.Random(2)
    given = [rng.randint(-2**63, 2**63 - 1) for _ in range(200)]
    got = inverted.intervals(given, 16)
    assert len(got) == 16 and all(any(a <= x <= b for a, b in got) for x in given)
    assert inverted.intervals([5]) == [(5, 5)] and inverted.intervals([]) == []


def test_repeated_build_of_changed_files_is_not_served_from_the_old_model(spark, tmp_path):
    from tallyworks.sources import files
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    df.write.parquet(f"{tmp_path}/d")
    first = files.listing(spark, f"{tmp_path}/d")
    df.union(df).write.mode("append").parquet(f"{tmp_path}/d")
    assert files.listing(spark, f"{tmp_path}/d") != first


def test_empty_table(spark, tmp_path):
    weights, idf = words.text_weights(spark.createDataFrame([], "id long, t string"), "id", "t")
    inverted.build(weights, "id", idf, f"{tmp_path}/i")
    index = inverted.Index(spark, f"{tmp_path}/i")
    assert index.search(index.query(spark.createDataFrame([("a",)], "t string"), "t")).count() == 0
    assert index.word_bounds().agg(F.count(F.lit(1))).first()[0] == 0


def weights_by_hand(texts):
    """{(key, word): weight} of (key, text) rows; rows of one key are one text."""
    tf = {}
    for key, text in texts:
        for word in (text or "").split():
            tf[key, word] = tf.get((key, word), 0) + 1
    df = Counter(word for _, word in tf)
    raw = {k: n * math.log2(len(texts) / df[k[1]]) for k, n in tf.items()}
    length = defaultdict(float)
    for (key, _), x in raw.items():
        length[key] += x * x
    return {k: x / math.sqrt(length[k[0]]) for k, x in raw.items() if abs(x) > 1e-12}


ODD = [(1, "a b b c"), (2, None), (3, ""), (None, "a c"), (4, "a"), (5, "d d d"), (6, "e a")]


@pytest.mark.parametrize("texts", [ODD, [*ODD, (1, "b x"), (None, "a y"), (None, "a y"), (4, None)], corpus(3)])
@pytest.mark.parametrize("size", [4, 1 << 20])
def test_weights_and_bounds_by_hand(spark, tmp_path, monkeypatch, texts, size):
    """Null and repeated keys, texts without words, blocks of a few words."""
    monkeypatch.setattr(text_blocks, "BLOCK_WORDS", size)
    monkeypatch.setattr(inverted, "RANGE_POSTINGS", 20)
    df = spark.createDataFrame(texts, "id long, t string").coalesce(2)
    want = weights_by_hand(texts)
    weights, idf = words.text_weights(df, "id", "t")
    inverted.build(weights, "id", idf, f"{tmp_path}/own")
    inverted.build(spark.createDataFrame(weights.collect(), weights.schema), "id", idf, f"{tmp_path}/given")
    for got in (weights, inverted.Index(spark, f"{tmp_path}/own").weights(), inverted.Index(spark, f"{tmp_path}/given").weights()):
        found = {(r["id"], r["word"]): r["weight"] for r in got.collect()}
        assert found == pytest.approx(want) and got.count() == len(want)
    for at in ("own", "given"):
        bounds = {r["word"]: (r["texts"], r["top"]) for r in inverted.Index(spark, f"{tmp_path}/{at}").word_bounds().collect()}
        assert set(bounds) == {w for _, w in want}
        for word, (n, top) in bounds.items():
            assert n == sum(w == word for _, w in want) and top == pytest.approx(max(x for (_, w), x in want.items() if w == word))


def test_no_row_per_text_and_word_is_moved_or_stored(spark, tmp_path):
    """Weights are read from blocks without a shuffle; the index has a row per block and word, and the blocks go with ``discard``."""
    texts = [(i, " ".join(f"w{(i + k) % 50}" for k in range(20))) for i in range(2000)]
    df = spark.createDataFrame(texts, "id long, t string").coalesce(1)
    weights, idf = words.text_weights(df, "id", "t")
    assert "Exchange" not in executed_plan(weights) and "Window" not in executed_plan(weights)
    inverted.build(weights, "id", idf, f"{tmp_path}/i")
    discard(weights)
    assert spark.read.parquet(f"{tmp_path}/i/postings").count() == 50
    index = inverted.Index(spark, f"{tmp_path}/i")
    assert index.weights().count() == 40_000
    query = index.query(spark.createDataFrame([("w3 w4",)], "t string"), "t")
    assert len(index.search(query, 5).collect()) == 5
