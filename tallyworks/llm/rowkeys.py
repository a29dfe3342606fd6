"""Rows that share a doc_id, and names that no table has.

Operators that tell texts apart by doc_id need distinct ones. Where a table's doc_ids
repeat, each distinct (doc_id, text) gets a number in their order, the operator runs
on the numbers, and every row gets what its own text got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.ordering import number_rows
from tallyworks.session import materialize


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def shared_ids(texts: DataFrame) -> bool:
    """Whether two rows have one doc_id. Only ids are shuffled."""
    counts = texts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.where("n > 1").isEmpty()


def keyed_texts(texts: DataFrame) -> DataFrame:
    """(key, doc_id, text) of every distinct (doc_id, text) with a doc_id, keys in their order."""
    known = texts.where("doc_id IS NOT NULL").distinct()
    return materialize(number_rows(known, ["doc_id", "text"], "key").select("key", "doc_id", "text"), "keyed")


def as_ids(keyed: DataFrame) -> DataFrame:
    """The keyed texts with the keys as doc_ids."""
    return keyed.select(F.col("key").alias("doc_id"), "text")


def by_text(docs: DataFrame, found: DataFrame, keyed: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of ``docs`` with the columns of ``found`` (doc_id = key, values) that belong to their doc_id and text."""
    values = [c for c in found.columns if c != "doc_id"]
    named = found.withColumnRenamed("doc_id", "key").join(keyed, "key").select(
        F.col("doc_id").alias("__doc"), F.col("text").alias("__text"), *values)
    same = (docs["doc_id"].cast("long") == F.col("__doc")) & docs["text"].eqNullSafe(F.col("__text"))
    return docs.join(named, same, how).drop("__doc", "__text")


def per_text(docs: DataFrame, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` on the texts of ``docs``, with a row per row; ``run`` needs distinct doc_ids and gives (doc_id, values)."""
    texts = texts_of(docs)
    if not shared_ids(texts):
        return run(texts)
    keyed = keyed_texts(texts)
    found = run(as_ids(keyed))
    rows = by_text(texts, found, keyed).select(*found.columns)
    return rows.union(run(texts.where("doc_id IS NULL")))
