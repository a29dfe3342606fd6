"""Inputs that several queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import lookup_join
from tallyworks.plans.registry import Tables
from tallyworks.session import materialize

# Own short stop list for the test texts; real jobs pass their list.
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "it", "that", "for", "with", "on", "as", "by", "at",
              "la", "le", "les", "des", "un", "une", "et", "que", "der", "die", "das", "und", "el", "los",
              "de", "en"]
STOP_SQL = ", ".join(f"('{w}')" for w in STOP_WORDS)

# DuckDB text of the word cut, from its definition: runs of letters, marks and
# numbers of any script. Chinese runs become pairs in Spark; the tables hold none.
CUT_SQL = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{M}}\p{{N}}]+')"
WORDS_SQL = "unnest(" + CUT_SQL + ")"

WEIGHTS_SQL = f"""
  tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, {WORDS_SQL.format('text')} AS word FROM documents) w
         GROUP BY ALL),
  idf AS (SELECT word, log2((SELECT count(*) FROM documents)::DOUBLE / count(*)) AS idf FROM tf GROUP BY 1),
  raw AS (SELECT doc_id, word, tf * idf AS weight FROM tf JOIN idf USING (word) WHERE abs(tf * idf) > 1e-12),
  weights AS (SELECT doc_id, word, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def stop_words(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")


def labelled_documents(t: Tables, *more: Column) -> DataFrame:
    """Documents with their labels; null where a document has none."""
    return lookup_join(t.documents.select("doc_id", *more, "lang", "source", "n_chars"), t.labels, ["doc_id"])


def text_mark() -> Column:
    """Stands for the text where only its presence matters, so that no text is moved."""
    return F.when(F.col("text").isNotNull(), F.lit(True)).alias("text")


LABELLED_SQL = ("SELECT doc_id, lang, source, n_chars, quality, toxic "
                "FROM documents LEFT JOIN labels USING (doc_id)")
LABELLED_TEXT_SQL = LABELLED_SQL.replace("doc_id,", "doc_id, text,", 1)


def order_tags(t: Tables) -> DataFrame:
    """(o_orderkey, month, tag, n): part types of each order, counted per line."""
    orders = t.orders.select("o_orderkey", F.month("o_orderdate").alias("month"))
    return basket_tags(t).join(orders, "o_orderkey")


def stored_baskets(t: Tables) -> DataFrame:
    """``basket_tags`` written once, for jobs that read it several times."""
    return materialize(basket_tags(t), "baskets")


def basket_tags(t: Tables) -> DataFrame:
    """(o_orderkey, tag, n): lines meet their part, then are counted per order and type."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("tag"))
    return lookup_join(t.lineitem.select("l_orderkey", "l_partkey"), parts, ["l_partkey"], "inner").groupBy(
        F.col("l_orderkey").alias("o_orderkey"), "tag").agg(F.count(F.lit(1)).alias("n"))


TAGS_SQL = """
  tags AS (SELECT l_orderkey AS basket, p_type AS tag, month(o_orderdate)::INT AS month, count(*) AS n
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
           GROUP BY ALL),
  pairs AS (SELECT a.tag AS tag1, b.tag AS tag2,
                   sum(a.n * (CASE WHEN a.tag = b.tag THEN b.n - 1 ELSE b.n END))::BIGINT AS count
            FROM tags a JOIN tags b ON a.basket = b.basket GROUP BY ALL HAVING count > 0)"""


def user_counts(t: Tables) -> DataFrame:
    """Events per month day and type: the 'month and tag' table of the event log."""
    return t.events.groupBy(F.dayofmonth("ts").alias("day"), F.col("event_type").alias("tag")).agg(
        F.count(F.lit(1)).alias("count"))


DAY_TAGS_SQL = "day_tags AS (SELECT day(ts)::INT AS day, event_type AS tag, count(*) AS count FROM events GROUP BY ALL)"
