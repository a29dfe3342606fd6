"""Word counts, TF-IDF weights and similar-text search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.cells import letter_words, words
from tallyworks.functions.fixed_values import CJK_RUN
from tallyworks.operators import text_blocks
from tallyworks.operators.joins import lookup_join, remove_stop_words
from tallyworks.session import materialize

# Weights this small count as zero.
ZERO_WEIGHT = 1e-12


def explode_words(df: DataFrame, text: str, cut: Callable[[Column], Column] = words) -> DataFrame:
    """One row per word; the text column itself is not carried along."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(cut(F.col(text))).alias("word"))


def letter_word_counts(df: DataFrame, text: str) -> DataFrame:
    """Counts of letter words, case kept."""
    pieces = explode_words(df.select(text), text, letter_words)
    return pieces.where(F.length(F.trim("word")) > 0).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def title_word_counts(df: DataFrame, text: str, stop_words: DataFrame,
                      cut: Callable[[Column], Column] = words) -> DataFrame:
    """Words over one character that are no stop words, with their counts.

    Words are counted before the stop-word join, so a very frequent word is
    one row there.
    """
    long_words = explode_words(df.select(text), text, cut).where(F.length("word") > 1)
    counts = long_words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return remove_stop_words(counts, stop_words)


def reply_word_counts(df: DataFrame, text: str, stop_words: DataFrame, script: str = CJK_RUN,
                      cut: Callable[[Column], Column] = words) -> DataFrame:
    """Counts of the one run of the wanted script in each word, if it is the
    only run and longer than one character."""
    counts = title_word_counts(df.select(F.lower(text).alias(text)), text, stop_words, cut)
    runs = counts.select(F.regexp_extract_all("word", F.lit(script), 0).alias("runs"), "count")
    single = runs.where((F.size("runs") == 1) & (F.length(F.col("runs")[0]) > 1))
    return single.groupBy(F.col("runs")[0].alias("word")).agg(F.sum("count").alias("count"))


def term_counts(df: DataFrame, key: str, text: str, cut: Callable[[Column], Column] = words) -> DataFrame:
    """(key, word, tf): how often each word stands in each text."""
    return explode_words(df.select(key, text), text, cut).groupBy(key, "word").agg(
        F.count(F.lit(1)).cast("bigint").alias("tf"))


def text_weights(df: DataFrame, key: str, text: str,
                 cut: Callable[[Column], Column] = words) -> tuple[DataFrame, DataFrame]:
    """(key, word, weight) with weight = tf * log2(N / df), each text of length
    1, and the (word, df, idf) table that a query needs. N is the number of rows; rows of one key are one text.

    The weights are read from stored blocks of texts (``text_blocks``), which an index is built from;
    ``discard(weights)`` deletes them. No row per text and word is moved or stored, unless keys repeat: then
    words are counted per key first, and a key's distinct words are held as one row.
    """
    from tallyworks.operators import inverted  # it imports this module

    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (rows["most"] or 0) <= 1:
        counts = df.select(key, cut(F.col(text)).alias("words"))
    else:
        pairs = term_counts(df, key, text, cut).groupBy(key).agg(F.collect_list(F.struct("word", "tf")).alias("w"))
        counts = pairs.select(key, F.col("w.word").alias("words"), F.col("w.tf").alias("values"))
    blocks, idf = text_blocks.weighted(counts, rows["n"] or 0, inverted.BLOCK_TEXTS, ZERO_WEIGHT)
    weights = text_blocks.expanded(blocks, key)
    weights.text_blocks, weights.stored_path = blocks, blocks.stored_path
    return weights, idf


def query_weights(query: DataFrame, text: str, idf: DataFrame,
                  cut: Callable[[Column], Column] = words) -> DataFrame:
    """Weights of all given texts as one query; unknown words drop out.

    Stored, so that Spark knows its size when it meets the text weights.
    """
    counts = explode_words(query.select(text), text, cut).groupBy("word").agg(F.count(F.lit(1)).alias("tf"))
    weighted = counts.join(idf, "word").select("word", (F.col("tf") * F.col("idf")).alias("weight"))
    weighted = materialize(weighted.where(F.abs("weight") > ZERO_WEIGHT), "query")
    total = weighted.agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length")).first()["length"]
    return weighted.select("word", (F.col("weight") / F.lit(total)).alias("query_weight"))


def most_similar(weights: DataFrame, key: str, query: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` texts with the highest cosine to one query.

    The query side has one row per word, so every (text, word) row is met at
    most once, and products are summed per text before anything is sorted.
    """
    met = lookup_join(weights, query, ["word"], "inner")
    scores = met.groupBy(key).agg(F.sum(F.col("weight") * F.col("query_weight")).alias("similarity"))
    return scores.orderBy(F.desc(F.round("similarity", 9)), key).limit(n)
