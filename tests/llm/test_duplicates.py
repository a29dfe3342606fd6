"""Near duplicates, substrings, suffixes and benchmark passages against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyworks.llm import contamination, minhash, repeats, substrings, suffixes
from tallyworks.llm.contamination import Index, Phrases
from tests.conftest import executed_plan
from tests.llm.small import by_id, documents, odd_documents, rows, sentence

WORD = re.compile("[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def components_of(given):
    sets = {}
    for row in given:
        w = WORD.findall(lower(row[1]))
        sets[row[0]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark):
    got = by_id(minhash.near_duplicates(documents(spark)))
    want = components_of(rows())
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicate_chain_and_many_copies(spark):
    """A chain whose ends are not alike, and a group of near copies that differ in one word each."""
    import random

    rng = random.Random(4)
    words = sentence(rng, 400).split()
    chain = [" ".join(words[k:k + 200]) for k in range(0, 120, 12)]
    base = sentence(rng, 200).split()
    near = [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(0, 200, 2)]
    given = [(1000 - i, t, None, None, None, None, None, None) for i, t in enumerate(chain + near)]
    got = by_id(minhash.near_duplicates(documents(spark, given)))
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in components_of(given).items()}


@pytest.mark.parametrize("bits", [0, 1])
def test_components_of_a_long_path(spark, bits):
    n = 40
    ids = list(range(n)) if bits else [(i * 17) % n for i in range(n)]
    links = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(n - 1)] + [(100, 101)], "a long, b long")
    got = {r.id: r.root for r in minhash.components(links).collect()}
    assert got == {**dict.fromkeys(range(n), 0), 100: 100, 101: 100}


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 62, 3000, dtype=np.uint64)
    both = np.concatenate((pool[:2000], pool[500:2500]))
    minima = minhash._minima(both, np.array([0, 2000, 4000]), 4000)
    low = minhash.mixed(minima.astype(np.uint64)) & np.uint64(3)
    share = (low[0] == low[1]).mean()
    assert abs((share - 0.25) / 0.75 - 1500 / 2500) < 0.06


def passages_of(given, width=20):
    first, out = set(), {}
    for i, text in sorted((r[0], r[1] or "") for r in given):
        w = WORD.findall(text)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            window = tuple(w[k:k + width])
            if window in first:
                gone[k:k + width] = [True] * width
            first.add(window)
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("width", [1, 3, 20])
def test_passages(spark, width):
    got = by_id(substrings.passage_digests(documents(spark), width))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == passages_of(rows(), width)


def test_passages_of_texts_that_differ_only_in_white_space(spark):
    words = sentence(random.Random(5), 60).split()
    forms = [" ".join(words), "  ".join(words), "\t".join(words), "\r\n".join(words), " " + " ".join(words) + "\n",
             " ".join(words[:19]), "\n".join(words[:19])]
    given = [(k + 2, t, "en", "x", 1, "k", k, 0) for k, t in enumerate(forms)]
    got = by_id(substrings.passage_digests(documents(spark, given)))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == passages_of(given, 20)
    assert [got[k].n_removed for k in range(2, 9)] == [0, 60, 60, 60, 60, 0, 0]
    left = by_id(substrings.drop_repeats(documents(spark, given)))
    assert [left[k].text.split() for k in range(3, 7)] == [[]] * 4 and left[2].text == forms[0]


def strings_of(given, width=200):
    count = Counter(d[k:k + width] for r in given for d in [(r[1] or "").encode()] for k in range(len(d) - width + 1))
    out = {}
    for r in given:
        data = (r[1] or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            if count[data[k:k + width]] > 1:
                gone[k:k + width] = b"\1" * width
        out[r[0]] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                     sha(bytes(x for x, g in zip(data, gone) if not g)))
    return out


@pytest.mark.parametrize("width", [2, 30, 200])
def test_strings(spark, width):
    got = by_id(suffixes.string_digests(documents(spark), width))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == strings_of(rows(), width)


def test_cut_keeps_the_rest_as_it_stands(spark):
    given = [(1, "a b\tc d\n e", None, None, 1, None, None, None), (2, "x  b\tc d\n y", None, None, 1, None, None, None),
             (3, None, None, None, 1, None, None, None)]
    got = by_id(substrings.drop_repeats(documents(spark, given), 3))
    assert {i: r.text for i, r in got.items()} == {1: "a b\tc d\n e", 2: "x  y", 3: None}
    assert got[1].asDict().keys() == documents(spark, given).collect()[0].asDict().keys()


def hits_of(given, items, width=13):
    windows = defaultdict(set)
    for item, text in items:
        w = PLAIN.findall(lower(text))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[k:k + width])].add(str(item))
    out = {}
    for r in given:
        w = PLAIN.findall(lower(r[1]))
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit[k:k + n] = [True] * n
                    found |= windows[tuple(w[k:k + n])]
        out[r[0]] = (len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit) and 20 * sum(hit) >= len(w))
    return out


@pytest.mark.parametrize("block", [1, 4 << 20])
def test_contamination(spark, block):
    given = rows()
    text = next(r[1] for r in given if r[1] and len(r[1].split()) > 1000)
    w = PLAIN.findall(text)
    items = [(1, " ".join(w[40:80]).upper()), (22, ", ".join(w[70:84])), (3, "Eins"), (4, None), (5, "..."),
             (6, "words that stand nowhere"), (7, " ".join(w[40:80])), (10, " ".join(w[-13:]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination(documents(spark), benchmark, block_bytes=block)
    got = {r.doc_id: r for r in found.mapInArrow(
        contamination._digests, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
        "contaminated boolean").collect()}
    assert {i: tuple(r)[1:] for i, r in got.items()} == hits_of(given, items)
    kept = {r.doc_id for r in contamination.drop_contaminated(documents(spark), benchmark).collect()}
    assert kept == {i for i, x in hits_of(given, items).items() if not x[4]}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c".split()), max_size=30), max_size=4),
       st.lists(st.lists(st.sampled_from("a b c d".split()), min_size=1, max_size=6), max_size=4))
def test_index_finds_every_place(docs, items):
    phrases = Phrases([(str(k), " ".join(x)) for k, x in enumerate(items)], 3)
    words = [w for d in docs for w in d]
    text = np.array([k for k, d in enumerate(docs) for _ in d], np.int64)
    vocabulary = sorted({w for x in items for w in x}, key=lambda w: Phrases([("0", w)], 1).vocabulary[0])
    numbers = np.array([vocabulary.index(w) + 2 if w in vocabulary else 1 for w in words], np.int64)
    shortest = int(phrases.length.min()) if len(phrases.length) else 1
    which, place = Index(numbers, text, shortest).search(phrases)
    want = {(k, at) for k, (row, n) in enumerate(zip(phrases.rows, phrases.length)) for at in range(len(words) - n + 1)
            if numbers[at:at + n].tolist() == row[:n].tolist() and len(set(text[at:at + n].tolist())) == 1}
    assert sorted(zip(which.tolist(), place.tolist())) == sorted(want)


def test_odd_rows_and_empty_tables(spark):
    odd, none = odd_documents(spark), documents(spark).limit(0)
    benchmark = spark.createDataFrame([(None, "a b"), (2, "a b c d")], "item_id long, text string")
    for run in (minhash.near_duplicates, substrings.passage_digests, suffixes.string_digests,
                lambda d: contamination.contamination_digests(d, benchmark),
                lambda d: contamination.contamination_digests(d, benchmark.limit(0))):
        assert run(odd).count() == odd.count()
        assert run(none).count() == 0
    for run in (minhash.drop_near_duplicates, substrings.drop_repeats,
                lambda d: contamination.drop_contaminated(d, benchmark)):
        assert run(odd).columns == odd.columns
        assert run(odd).where("doc_id IS NULL").count() == odd.where("doc_id IS NULL").count()
        assert run(none).count() == 0


def test_families_just_above_the_threshold(spark):
    """140 texts off one base, 5 or 6 of 300 words changed: links that buckets' leads do not show."""
    rng = random.Random(8)
    base = sentence(rng, 300).split()
    given = []
    for k in range(140):
        words = list(base)
        for at in rng.sample(range(300), rng.choice([5, 6])):
            words[at] = f"new{k}x{at}"
        given.append((500 - k, " ".join(words), None, None, None, None, None, None))
    got = by_id(minhash.near_duplicates(documents(spark, given)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == components_of(given)


def test_roots_joined_by_further_links(spark):
    roots = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "id long, root long")
    links = spark.createDataFrame([(6, 2), (20, 21), (9, 20)], "a long, b long")
    got = {(r.id, r.root) for r in minhash._joined(roots, links).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 1), (8, 8), (9, 8), (20, 8), (21, 8)}


THUE = "".join("ab"[bin(k).count("1") & 1] for k in range(2048))
SWAPPED = THUE.translate(str.maketrans("ab", "ba"))


def test_regular_long_words_are_told_apart(spark):
    """Two words of 2,048 letters whose sums modulo 2**64 are equal for every odd base."""
    rows_ = [(1, THUE, None, None, None, None, None, None), (2, SWAPPED, None, None, None, None, None, None)]
    got = by_id(minhash.near_duplicates(documents(spark, rows_)))
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 2: 2}


def shared_rows():
    """Different texts under one doc_id, repeated rows, and rows without doc_id; columns named like helpers."""
    rng = random.Random(9)
    a, b, c = (sentence(rng, 40) for _ in range(3))
    near = " ".join(["new"] + a.split()[1:])
    return [(1, a), (1, b), (2, near), (3, b + " more"), (4, a), (4, c), (4, c), (5, a + " " + c), (None, a), (6, None)]


def shared_table(spark):
    return spark.createDataFrame([(i, t, k, "g", None) for k, (i, t) in enumerate(shared_rows())],
                                 "doc_id long, text string, cut_id int, gone string, bad string")


def test_near_duplicates_of_shared_ids_have_the_links_of_each_text(spark):
    got = minhash.near_duplicates(shared_table(spark)).collect()
    sets = [(i, {tuple(w[k:k + 5]) for w in [WORD.findall(lower(t))] for k in range(len(w) - 4)}) for i, t in shared_rows()]
    root = {i: i for i, _ in sets if i is not None}
    for _ in sets:
        for i, x in sets:
            for j, y in sets:
                if None not in (i, j) and x and y and 100 * len(x & y) >= 75 * len(x | y):
                    root[i] = root[j] = min(root[i], root[j])
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == sorted(
        (i or 0, len(x), root.get(i) or 0, i is None or root[i] == i) for i, x in sets)
    assert root == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6}


def test_repeats_of_shared_ids_are_cut_from_their_own_text(spark):
    texts_in_order = sorted({(i, t or "") for i, t in shared_rows() if i is not None})
    want = passages_of([(k, t) for k, (_, t) in enumerate(texts_in_order)])
    by = {key: want[k] for k, key in enumerate(texts_in_order)}
    got = substrings.passage_digests(shared_table(spark)).collect()
    expected = [(i or 0, *(by[i, t or ""] if i is not None else (len(t.split()), 0, sha(t)))) for i, t in shared_rows()]
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(expected)
    left = substrings.drop_repeats(shared_table(spark)).collect()
    assert sorted((r.doc_id or 0, sha(" ".join((r.text or "").split()))) for r in left) == sorted((e[0], e[3]) for e in expected)
    strings = {key: x for key, x in zip(texts_in_order, strings_of([(k, t) for k, (_, t) in enumerate(texts_in_order)]).values())}
    found = suffixes.string_digests(shared_table(spark)).where("doc_id IS NOT NULL").collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == sorted(
        (i, *strings[i, t or ""]) for i, t in shared_rows() if i is not None)


def test_text_longer_than_a_block(spark):
    """More than a block (1 MB) in one text: a passage of it stands in a short one, and a near copy of all of it in a third."""
    rng = random.Random(2)
    pool = [sentence(rng, 50) for _ in range(200)]
    long = " ".join(f"{pool[rng.randrange(200)]} n{k}" for k in range(5_000))
    assert len(long) > 1 << 20
    words = long.split()
    given = [(1, long), (2, " ".join(words[5000:5060])), (3, " ".join(words[:-3])), (4, "short")]
    df = spark.createDataFrame(given, "doc_id long, text string")
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in by_id(substrings.passage_digests(df)).items()} == passages_of(given)
    got = by_id(minhash.near_duplicates(df))
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 2: 2, 3: 1, 4: 4}
    items = [(1, " ".join(PLAIN.findall(long)[70_000:70_030]))]
    found = by_id(contamination.contamination_digests(df, spark.createDataFrame(items, "item_id long, text string")))
    assert {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in found.items()} == hits_of(given, items)


@pytest.mark.parametrize("size", [{}, {"block_bytes": 1}])
def test_hits_and_their_digests_share_a_worker(spark, size):
    """Two Python steps in a row would keep two workers for each task until the application ends."""
    given, items = rows(), [(1, "Eins"), (2, " ".join(PLAIN.findall(lower(rows()[7][1] or "a b"))[:20]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination_digests(documents(spark), benchmark, **size)
    assert executed_plan(found).count("MapInArrow") == 1
    assert {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
            for i, r in by_id(found).items()} == hits_of(given, items)


def test_memory_of_a_task_does_not_grow_with_its_batch():
    """Eight MB of texts in one batch: what a step holds beside the batch is that of a block."""
    rng = random.Random(4)
    pool = [sentence(rng, 50) for _ in range(200)]
    texts = [" ".join(f"{pool[rng.randrange(100, 200)]} n{k}" for _ in range(10)) for k in range(2600)]
    texts[7] += f" {pool[3]}"
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": texts})
    assert sum(map(len, texts)) > 7 << 20
    search = contamination._search(contamination.Phrases([(str(k), t) for k, t in enumerate(pool[:5])], 13))
    steps = {"search": (search, 120), "anchors": (repeats._anchor_rows(substrings.word_windows()), 20),
             "digests": (repeats._word_digests, 30)}
    for name, (run, most) in steps.items():
        tracemalloc.start()
        try:
            n = sum(len(b) for b in run([batch]))
            peak = tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()
        assert n and peak < most, (name, peak)
