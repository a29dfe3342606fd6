"""Registered queries of the operators, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import (
    alignment, collocations, contamination, maxent, minhash, perplexity, pieces, quality, shards, substrings, suffixes, token_files, toxicity,
)
from tallyworks.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_minhash_dedup", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)""")
def op1(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op2_sentencepiece")
def op2(spark, folder):
    return pieces.encoding_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM g),
c AS (SELECT DISTINCT doc_id, i + o AS i FROM (SELECT doc_id, i, unnest(range(0, 20)) AS o FROM f WHERE again)),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
      FROM p ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""")
def op3(spark, folder):
    return substrings.passage_digests(table(spark, folder, "documents"))


@query("op4_quality")
def op4(spark, folder):
    return quality.quality_table(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_token_files")
def op5(spark, folder):
    return token_files.token_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_sharding")
def op6(spark, folder):
    return shards.shard_table(table(spark, folder, "documents"), fresh_path(spark, "shard-map"))


@query("op7_toxicity")
def op7(spark, folder):
    return toxicity.toxicity_table(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_quality_rules")
def op8(spark, folder):
    return perplexity.rule_table(table(spark, folder, "documents"))


@query("op9_suffix_dedup")
def op9(spark, folder):
    return suffixes.string_digests(table(spark, folder, "documents"))


@query("op10_decontamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
pat AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
        FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
              FROM b WHERE len(w) > 0)),
g AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM pat))),
h AS (SELECT doc_id, i, n, item_id FROM g JOIN pat USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""")
def op10(spark, folder):
    return contamination.contamination_digests(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_language_scores")
def op11(spark, folder):
    return maxent.language_scores(table(spark, folder, "documents"))


@query("op12_collocations", r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(
             coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents),
q AS (SELECT lang, regexp_extract_all(unnest(p), '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM q GROUP BY lang),
g AS (SELECT lang, k, w[i:i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM q, (VALUES (1), (2), (3), (4)) v(k))),
f AS (SELECT lang, k, p, count(*) AS a FROM g GROUP BY ALL HAVING a >= 30),
c AS (SELECT f.lang, f.k, f.p, f.a, l.a AS l, r.a AS r, l.k AS cut, ((2000000::HUGEINT * f.a) // (l.a + r.a))::BIGINT AS score
      FROM f JOIN f l ON l.lang = f.lang AND l.k < f.k AND l.p = f.p[1:l.k]
             JOIN f r ON r.lang = f.lang AND r.k = f.k - l.k AND r.p = f.p[l.k + 1:f.k]),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
i AS (SELECT lang, p[o:o + k - 1] AS p, max(a) AS m FROM (
        SELECT lang, p, a, v.k, unnest(range(1, f.k - v.k + 2)) AS o FROM f, (VALUES (2), (3)) v(k) WHERE v.k < f.k) GROUP BY ALL),
t AS (SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.p = b.p WHERE i.m IS NULL OR 100 * i.m < 80 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM t JOIN n USING (lang) QUALIFY rank <= 2000""")
def op12(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query("op13_alignment")
def op13(spark, folder):
    return alignment.alignment_table(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))
