"""Language scores, collocations and alignments against brute force, on odd rows and empty tables."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyworks.llm import alignment, collocations, maxent, vocabulary
from tallyworks.llm.collocations import HatTrie
from tests.llm.small import documents, odd_documents, rows, sentence
from tests.llm.test_duplicates import SWAPPED, THUE, WORD, lower

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*WORD.findall(lower(text)), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_of(given):
    count = Counter(w for i, t in given if not held(i) for w in tokens(t))
    total, distinct = sum(count.values()), len(count)
    return [(i or 0, held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total,
             round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 6)) for i, t in given]


def base_columns(found):
    return sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)


@pytest.mark.parametrize("block", [200, 4 << 20])
def test_base_scores_on_odd_rows(spark, monkeypatch, block):
    """Nulls, empty texts, repeated rows, rows without doc_id, clashing columns, many small blocks and hash ranges."""
    monkeypatch.setattr(maxent, "BLOCK_BYTES", block)
    monkeypatch.setattr(maxent, "RANGE_BYTES", block)
    odd = odd_documents(spark)
    got = maxent.language_scores(odd).collect()
    assert base_columns(got) == sorted(base_of([(r.doc_id, r.text) for r in odd.collect()]))
    assert all(r.score < 0 for r in got)


def test_a_block_takes_little_memory_beside_its_texts(monkeypatch):
    """Stage by stage, two workers and the heap share an executor; hashing whole blocks took it over its limit."""
    monkeypatch.setattr(vocabulary, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    text = " ".join(f"word{i % 5000}" for i in range(200_000))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text], "train": [True], "lang": [0]})
    tracemalloc.start()
    try:
        found = list(maxent._blocks([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found[0]["size"].to_pylist() == [5000]
    assert peak < 20 * len(text)


def test_scores_without_training_rows_and_of_no_rows(spark):
    ids = [i for i in range(60) if held(i)]
    only = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.base_score, round(r.score, 9)) for r in maxent.language_scores(only).collect()} == {(0, 0, 0.0, 0.0)}
    assert maxent.language_scores(documents(spark).limit(0)).count() == 0


def test_regular_long_words_are_two_words(spark):
    given_ = [(i, t) for i in range(12) for t in (THUE, SWAPPED)]
    got = maxent.language_scores(spark.createDataFrame(given_, "doc_id long, text string")).collect()
    assert base_columns(got) == sorted(base_of(given_))


def test_model_is_a_distribution_and_beats_the_base_on_texts_it_has_not_seen(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = [r for r in maxent.language_scores(docs).collect() if r.held_out]
    size = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / size > sum(r.base_score for r in got) / size + 0.3
    voc = maxent.Vocabulary(100, 4, 10, 0.5, np.zeros((64, 256), np.int64), np.array([40.0, 48.0, 10.0, 2.0]))
    features = maxent.Features(4, 16)
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(features.rows, 4)).astype(np.float32)
    at = features.of(np.array([0, 1, 1]), np.array([3, 4, 5], np.uint64), np.arange(3))
    out, spare = np.empty((3, 4), np.float32), np.empty((3, 4), np.float32)
    chance = []
    for k in range(4):
        target, total = maxent._exponentials(weights, at, out, spare, np.full(3, k))
        chance.append(np.exp(target) / total)
    assert np.allclose(np.sum(chance, axis=0), 1, atol=1e-5)
    # a class's words share it out: (c - D) / mass adds up to 1
    counts = np.array([40, 30, 19])
    assert math.isclose(sum((c - 0.5) / sum(counts - 0.5) for c in counts), 1)
    assert voc.unseen == 3 and voc.end == 2


def test_context_teaches_the_model(spark):
    """Two kinds of texts with words of their own: what came before tells which words follow."""
    rng = random.Random(3)
    kinds = [[f"{k}{i}" for i in range(40)] for k in "xy"]
    given_ = [(i, " ".join(rng.choices(kinds[i % 2], k=60))) for i in range(400)]
    df = spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in given_], "doc_id long, text string, lang string")
    got = [r for r in maxent.language_scores(df).collect() if r.held_out]
    per_word = sum(r.score for r in got) / sum(r.n_tokens for r in got)
    assert per_word > -math.log10(80) + 0.2


def phrases_of(given_, least=30, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in given_:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        found = []
        for p, a in often.items():
            if any(100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in often.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def table_of(found):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found.collect())


def phrase_rows():
    rng = random.Random(6)
    fixed = ["new york city hall", "of the", "a, b", "la casa blanca", "of the new"]
    out = [("en" if k % 3 else None, " ".join(rng.choice([*fixed, *"p q r s".split()]) for _ in range(30)) + rng.choice(".;\n"))
           for k in range(120)]
    return out + [("und", "of the of the"), ("en", None), (None, ""), ("en", " .,;"), ("en", "é of the É"), ("en", THUE)]


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(collocations, "PART_WORDS", 200)
        monkeypatch.setattr(collocations, "_TEXT_BYTES", 300)
    given_ = phrase_rows()
    df = spark.createDataFrame([(lang, t, 1, "x") for lang, t in given_], "lang string, text string, word int, block string")
    assert table_of(collocations.collocations(df)) == phrases_of(given_)
    assert table_of(collocations.collocations(df, least=5, top=3)) == phrases_of(given_, 5, 3)


def test_collocations_of_no_rows_and_without_frequent_phrases(spark):
    assert collocations.collocations(documents(spark).limit(0)).count() == 0
    assert collocations.collocations(documents(spark).select("text"), least=10**6).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=40), max_size=6), st.integers(1, 8), st.integers(1, 30))
def test_trie_counts_whatever_bursts_and_spills(batches, burst, limit):
    got, runs = Counter(), []

    def spill(part, edges, counts):
        assert (np.diff(edges.astype(np.int64)) > 0).all() and {int(e) % 3 for e in edges} == {part}
        runs.append(part)
        got.update(dict(zip(edges.tolist(), counts.tolist())))
    trie = HatTrie(spill, burst, limit)
    for values in batches:
        edges = np.array(values, np.uint64)
        trie.add(edges, (edges % np.uint64(3)).astype(np.int64))
    trie.close()
    seen = Counter()
    for run in [Counter(v for values in batches for v in values)]:
        seen.update(run)
    # spilled runs of one part are merged by adding, so counts add up over runs
    total = Counter()
    for e, n in got.items():
        total[e] += n
    assert set(total) == set(seen)


def aligned(given_):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment._byte_letters()
    names = {i: bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode() for s, i in a.get_vocab().items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    count, links, out = Counter(), [], []
    for _, text in given_:
        text = text or ""
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        ends = []
        for ids, name in ((x, names.get), (y, piece)):
            at, place = 0, {}
            for k, i in enumerate(ids):
                at += len(name(i))
                place[at] = k
            ends.append(place)
        if not text or any(b"".join(map(n, ids)) != f" {text}".encode() for ids, n in ((x, names.get), (y, piece))):
            links.append(None)
            out.append(None)
            continue
        groups, i, j, own = [], 0, 0, []
        for e in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0][e], ends[1][e]
            groups.append(",".join(map(str, x[i:p + 1])) + "|" + ",".join(map(str, y[j:q + 1])))
            own.append((x[p], y[q]))
            i, j = p + 1, q + 1
        count.update(own)
        links.append(own)
        out.append((len(x), len(y), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return sorted((i or 0, *(o[:4] if o else (0,) * 4), *((sum(count[k] == top[k[1]] for k in own), sum(count[k] for k in own)) if o else (0, 0)),
                   o[4] if o else "") for (i, _), own, o in zip(given_, links, out))


ODD_TEXTS = ["", " ", "  ", " a", "a  b", "a \n b", "x▁y", "tab\tb", "<|endoftext|> here", "<s> a </s>", "é　ü b", "a b c",
             "don't  stop", "a\r\nb c", "😀 😀😀 x", "trail  ", "\x00 a\x00", "'s it's", "1 234 5", "​ zero", "x" * 3000, "\x1c a \x1d b",
             " ".join(["same"] * 400)]


@pytest.mark.parametrize("block", [64, 4 << 20])
def test_alignments(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "_TEXT_BYTES", block)
    given_ = [(r[0], r[1]) for r in rows()] + [(900 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a b"), (None, None), (7, "a b"), (7, "a b")]
    df = spark.createDataFrame([(*g, k, "p") for k, g in enumerate(given_)], "doc_id long, text string, block int, pairs string")
    found = alignment.alignment_table(df, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted((r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found.collect())
    assert got == aligned(given_)


def test_alignment_of_no_rows(spark):
    found = alignment.alignment_table(documents(spark).limit(0), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"))
    assert found.count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), max_size=8), st.lists(st.integers(1, 4), max_size=8)), max_size=6))
def test_lockstep_finds_every_common_end(sizes):
    length = np.arange(6)
    a, b = (alignment.Encoded([np.array(s[k], np.int64) for s in sizes], length) for k in (0, 1))
    got = set(zip(*[x.tolist() for x in alignment.lockstep(a, b)]))
    want = set()
    for k, (x, y) in enumerate(sizes):
        for i in range(len(x)):
            for j in range(len(y)):
                if sum(x[:i + 1]) == sum(y[:j + 1]):
                    want.add((k, int(a.first[k]) + i, int(b.first[k]) + j))
    assert got == want


def test_text_longer_than_a_block(spark, monkeypatch):
    for module, name in ((maxent, "BLOCK_BYTES"), (collocations, "_TEXT_BYTES"), (alignment, "_TEXT_BYTES")):
        monkeypatch.setattr(module, name, 1 << 20)
    rng = random.Random(4)
    pool = [sentence(rng, 50) for _ in range(200)]
    long = ". ".join(pool[rng.randrange(200)] for _ in range(5_000))
    assert len(long) > 1 << 20
    given_ = [(1, long), (3, "a b"), (4, long[:300])]
    df = spark.createDataFrame([(*g, "en") for g in given_], "doc_id long, text string, lang string")
    assert base_columns(maxent.language_scores(df).collect()) == sorted(base_of(given_))
    assert table_of(collocations.collocations(df, top=50)) == phrases_of([("en", t) for _, t in given_], top=50)
    found = alignment.alignment_table(df, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found.collect())
    assert got == aligned(given_)
