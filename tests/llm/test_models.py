"""Classifiers, rules, encoders, token files and shards."""

import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tallyworks.llm import perplexity, pieces, quality, shards, token_files, toxicity
from tallyworks.llm.arrays import text_bytes
from tallyworks.session import fresh_path
from tests.llm.small import by_id, documents, odd_documents, rows

FOLDER = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"
WORDS, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "piece_bpe_32k.model"))
STRANGE = ["don't IT'S 'LL x'dy", "é É ß ẞ İstanbul ΣΑΣ Å ﬁ ſ K", "x<|endoftext|>y <|startoftext|>", "中文 日本 emoji😀!!",
           "a.b,c;d 12ab34 _x_ ~`^ ½ µ ª ÿ × ÷", "a　b \x00 \x1c\x1d a\x85b \x7f", "  two  spaces   here ", " ", "\n\n",
           "<s> </s> <0x41> <unk> ▁x ▁", "é ̈ ä"]


@pytest.mark.parametrize("table,label,modulus,rest", [(quality.quality_table, "quality", 5, 0),
                                                      (toxicity.toxicity_table, "toxic", 4, 2)])
def test_held_out_accuracy(spark, table, label, modulus, rest):
    docs, labels = (spark.read.parquet(f"{LARGER}/{n}.parquet") for n in ("documents", "labels"))
    got = by_id(table(docs, labels))
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == rest) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    pairs = [(r[label], got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.95


def test_scores_do_not_use_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    wrong = labels.withColumns({c: quality.F.when(quality.crc_share(m, k), 1 - labels[c]).otherwise(labels[c])
                                for c, m, k in (("quality", 5, 0), ("toxic", 4, 2))})
    for table in (quality.quality_table, toxicity.toxicity_table):
        assert by_id(table(docs, labels)) == by_id(table(docs, wrong))


def test_misspelt_word_shares_its_subwords():
    clean = ["the house on the hill", "a walk in the park", "rain and wind at sea", "bread with salt"] * 20
    toxic = ["you are an idiot here", "what a moron he is"] * 20
    model = toxicity.fit_subwords(clean + toxic, np.array([0.0] * len(clean) + [1.0] * len(toxic)), steps=200)
    scores = model.scores(*text_bytes(pa.array(["an idiott indeed", "a walk at sea", "", None])))
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3]


def test_models_without_usable_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(3, 1, 1), (10, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        for table in (quality.quality_table, toxicity.toxicity_table):
            got = table(docs, labels)
            assert got.count() == docs.count() and got.where("score IS NULL").count() == 0
    assert quality.quality_table(docs.limit(0), none).count() == 0
    kept = quality.drop_low_quality(docs, one)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 6)).astype(np.float32)
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.fit_network(x[:3000], y[:3000])
    p, truth = net.scores(x[3000:].astype(float)), y[3000:]
    for low, high in ((0, 0.3), (0.3, 0.7), (0.7, 1.01)):
        part = (p >= low) & (p < high)
        assert abs(p[part].mean() - truth[part].mean()) < 0.08


def figures_of(text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    count = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    twice = [False] * len(w)
    for k in range(len(w) - 4):
        if count[tuple(w[k:k + 5])] > 1:
            twice[k:k + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(twice))


def test_base_rules(spark):
    got = by_id(perplexity.rule_table(documents(spark)))
    for row in rows():
        r, want = got[row[0]], figures_of(row[1])
        assert tuple(r[k] for k in perplexity._FIGURES) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_language_model_against_counting(spark):
    """Counts from Spark equal counts by hand; probabilities after any context add up to one."""
    texts = [r[1] for r in rows()]
    count, table = Counter(), perplexity._classes()
    for t in texts:
        c = [31] * 3 + table[np.frombuffer((t or "").encode(), np.uint8)].tolist()
        count.update(tuple(c[k:k + 4]) for k in range(len(c) - 3))
    model = perplexity.fit_language_model(documents(spark))
    key = sorted(a << 15 | b << 10 | c << 5 | d for a, b, c, d in count)
    assert model.keys[3].tolist() == key
    sums = model.probability(np.arange(1 << 20)).reshape(-1, 32).sum(axis=1)
    assert np.allclose(sums, 1)
    third = Counter(k[1:] for k in count)
    assert model.keys[2].tolist() == sorted(a << 10 | b << 5 | c for a, b, c in third)


def test_band_keeps_prose_and_rejects_noise(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = np.random.default_rng(3)
    noise = "".join(chr(33 + k) + " " * (k % 5 == 0) for k in rng.integers(0, 90, 3000).tolist())
    more = spark.createDataFrame([(10_000_000, noise, "en", "x", 1)], docs.schema)
    got = by_id(perplexity.rule_table(docs.union(more)))
    assert not got[10_000_000].base_failed and not got[10_000_000].kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [r.kept for i, r in got.items() if labels.get(i) == 1 and not r.base_failed]
    assert np.mean(good) > 0.98


def test_word_order_and_other_scripts_count(spark):
    """Shuffled words, and noise in letters beyond ASCII, lie outside the band of the prose they are made of."""
    rng = np.random.default_rng(4)
    latin = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(800)]
    cyrillic = ["".join(rng.choice(list("абвгдежзик"), rng.integers(2, 8))) for _ in range(800)]
    given = []
    for lang, words, gap in (("a", latin, " "), ("b", cyrillic, " "), ("c", [chr(0x4E00 + k) for k in range(800)], "")):
        lines = [gap.join(rng.choice(words, 12)) for _ in range(60)]
        texts = [" ".join(rng.choice(lines, 20, replace=False)) for _ in range(40)]
        shuffled = list(texts[0].replace(" ", "")) if lang == "c" else texts[0].split()
        rng.shuffle(shuffled)
        if lang == "c":
            noise = gap.join(chr(k) for k in rng.integers(0x5000, 0x9000, 240))
            texts, shuffled = [t.replace(" ", " , ") for t in texts], [noise[k:k + 12] for k in range(0, 240, 12)]
        given += [(len(given) + k, t, lang, "x", 1) for k, t in enumerate([*texts, " ".join(shuffled)])]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = by_id(perplexity.rule_table(docs))
    for at in (0, 41, 82):
        assert all(got[at + k].kept for k in range(40))
        assert not got[at + 40].base_failed and not got[at + 40].kept


def test_pair_words():
    texts = ["", "ab  c", "中文x", "é\n", " "]
    buf, offs = text_bytes(pa.array(texts))
    starts, ends, first = perplexity.pair_words(buf, offs)
    assert [buf[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["ab", "c", "中", "文", "x", "é"]
    assert first.tolist() == [0, 0, 2, 5, 6, 6]


def test_piece_encoding(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = pieces.read_model(PIECES)
    given = rows() + [(-k, t, None, None, None, None, None, None) for k, t in enumerate(STRANGE, 1)]
    got = by_id(pieces.encode_texts(documents(spark, given), model))
    back = by_id(pieces.decode_ids(pieces.encode_texts(documents(spark, given), model), model))
    for row in given:
        ids = library.encode(row[1] or "")
        assert got[row[0]].ids == ids and got[row[0]].parity and got[row[0]].restored
        assert back[row[0]].text == library.decode(ids)
    assert pieces.encode_texts(odd_documents(spark), model).count() == odd_documents(spark).count()
    assert pieces.encode_texts(documents(spark).limit(0), model).count() == 0


@pytest.mark.parametrize("joined", [True, False])
def test_parts_need_no_call_each(monkeypatch, joined):
    """Most parts of a corpus are rare words, so no step may run once for each of them; ids and round trips stay."""
    encoder = pieces.Encoder(pieces.parse_model(pieces.read_model(PIECES)))
    parts = pieces.Parts(encoder)
    parts.joined = joined
    given = [None, "", *STRANGE, " ".join(f"wört{i}x" for i in range(30_000)), *STRANGE, "x" * 5000]
    ids, _ = encoder.encode([t or "" for t in given])
    calls = []
    monkeypatch.setattr(encoder, "bytes_of", lambda x, of=encoder.bytes_of: calls.append(1) or of(x))
    flat, first, restored = parts.encode(pa.array(given))
    assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == ids
    assert restored.all() and len(calls) < 100
    # an id that stands for other bytes than its piece is noticed, in its texts alone
    lost = int(flat[first[2]])
    parts.surface = parts.surface.copy()
    parts.surface[parts.surface_at[lost]] ^= 1
    _, _, restored = parts.encode(pa.array(given))
    assert restored.tolist() == [lost not in x for x in ids]


def test_unigram_model_keeps_its_scores():
    def part(number, data):
        return bytes([number << 3 | 2, len(data)]) + data

    def piece(text, score, kind=1):
        return part(1, part(1, text.encode()) + b"\x15" + np.float32(score).tobytes() + bytes([0x18, kind]))
    data = (piece("<unk>", 0, 2) + piece("▁a", -1) + piece("▁ab", -2.5) + piece("b", -1.2) + piece("c", -3)
            + part(2, b"\x18\x01") + part(3, part(1, b"identity") + b"\x18\x01\x20\x01"))
    encoder = pieces.Encoder(pieces.parse_model(data))
    assert encoder.encode(["ab  a", "abc"])[0] == [[1, 3, 1], [1, 3, 4]]
    assert encoder.decode([1, 3, 1]) == "ab a"


def test_known_parts_are_arrays():
    """Most parts of a corpus are rare words: none becomes an object of its own, known, new and forgotten ones keep their ids."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    given = ["", *STRANGE, "it's a<|b <| < | Öx×y", "one two one", *STRANGE[::-1], ""]
    for held in (0, 250_000):
        encoder = token_files.WordEncoder(WORDS, held)
        for texts in (given, given[5:], given[:3], ["", " "], given):
            ids, count = encoder.encode(*text_bytes(pa.array(texts)), 1)
            stop = np.cumsum(count)
            assert [ids[a:b].tolist() for a, b in zip(stop - count, stop)] == [
                whole.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    buf, offs = text_bytes(pa.array([" ".join(f"{chr(97 + i % 26)}q{chr(97 + i // 26 % 26)}z{chr(97 + i // 676 % 26)}"
                                              f"{chr(97 + i // 17576)}" for i in range(100_000))]))
    tracemalloc.start()
    try:
        encoder.encode(buf, offs, 1)
        assert tracemalloc.get_traced_memory()[0] < 50 * 100_000
    finally:
        tracemalloc.stop()


def test_token_files(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    given = rows() + [(-k, t, None, None, None, None, None, None) for k, t in enumerate(STRANGE, 1)]
    path = fresh_path(spark, "tokens")
    token_files.write_token_files(documents(spark, given), WORDS, path, length=64, file_ids=500, range_bytes=9000)
    got, start, stream = by_id(token_files.read_token_files(spark, path)), 0, []
    for row in sorted(given, key=lambda r: r[0]):
        ids = whole.encode(row[1] or "", add_special_tokens=False).ids + [1]
        assert tuple(got[row[0]])[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
        stream += ids
    contents = [r.content for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    assert len(contents) > 3
    total = 0
    for content in contents:
        schema, batches = token_files.open_stream(pa.py_buffer(content))
        assert schema.field("ids").type.list_size == 64
        for k in range(sum(b.num_rows for b in batches)):
            ids, mask = token_files.sequence(batches, k)
            assert len(ids) == len(mask) == 64
            total += sum(mask.to_pylist())
    assert total == len(stream)


def test_token_files_of_odd_rows(spark):
    assert token_files.token_digests(odd_documents(spark), WORDS).count() == odd_documents(spark).count()
    assert token_files.token_digests(documents(spark).limit(0), WORDS).count() == 0


def test_shards(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = shards.shard_table(docs, fresh_path(spark, "map")).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 16 for r in got)
    load, places = Counter(), {}
    for r in got:
        load[r.shard] += r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    assert len(load) == 40 and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= 0.02 * max(load.values())


def test_rebalancing_moves_little_and_keeps_versions(spark):
    rng = np.random.default_rng(1)
    sizes = dict(enumerate(rng.integers(100, 200, 400).tolist()))
    path, place = fresh_path(spark, "map"), shards.first_map(sizes, 8, 400)
    grown = shards.rebalanced(place, sizes, 10)
    moved = sum(sizes[s] for s in place if grown[s] != place[s])
    load = Counter()
    for slot, shard in grown.items():
        load[shard] += sizes[slot]
    assert max(load.values()) < 1.05 * sum(sizes.values()) / 10 and moved < 0.25 * sum(sizes.values())
    assert all(grown[s] >= 8 for s in place if grown[s] != place[s])
    less = shards.rebalanced(grown, sizes, 7)
    assert set(less.values()) == set(range(7)) and all(grown[s] >= 7 or less[s] == grown[s] for s in less)
    for version, given in ((1, place), (2, grown), (3, less)):
        shards.save_map(spark, given, version, path)
    assert {r.slot: r.shard for r in shards.load_map(spark, path).collect()} == less
    assert {r.slot: r.shard for r in shards.load_map(spark, path, 1).collect()} == place


def test_shards_of_odd_rows(spark):
    got = shards.shard_table(odd_documents(spark), fresh_path(spark, "map"), 3)
    assert got.count() == odd_documents(spark).count()
    assert shards.shard_table(documents(spark).limit(0), fresh_path(spark, "map")).count() == 0
