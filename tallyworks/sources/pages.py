"""Fields from JSON replies and raw HTML."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_json(df: DataFrame, column: str, schema: str, fields: Mapping[str, str]) -> DataFrame:
    """Nested JSON to columns; ``fields`` maps a new name to a path. ``parsed`` is
    false for a reply that is not JSON of that form (or null); a missing or null
    field alone does not make it so."""
    reply = F.from_json(column, f"{schema}, __bad string", {"columnNameOfCorruptRecord": "__bad"})
    out = df.withColumn("__reply", reply)
    out = out.withColumns({name: F.col(f"__reply.{path}") for name, path in fields.items()})
    good = F.col("__reply").isNotNull() & F.col("__reply.__bad").isNull()
    return out.withColumn("parsed", good).drop("__reply")


def malformed_count(flat: DataFrame) -> DataFrame:
    """Replies of a ``flatten_json`` table, and how many were malformed."""
    return flat.agg(F.count(F.lit(1)).alias("replies"), F.count_if(~F.col("parsed")).alias("malformed"))


def id_names(df: DataFrame, items: str, key: str, name: str) -> DataFrame:
    """One name per id from arrays of records; the lowest if it has several."""
    return df.select(F.inline(items)).groupBy(key).agg(F.min(name).alias(name))


def field_from_html(html: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, null if there is none."""
    return F.get(F.regexp_extract_all(html, F.lit(pattern), group), F.lit(0))


def html_fields(df: DataFrame, html: str, patterns: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: field_from_html(F.col(html), p) for name, p in patterns.items()})


def links(df: DataFrame, html: str, pattern: str = 'href="([^"]+)"') -> DataFrame:
    """One row per link target, in page order."""
    found = F.regexp_extract_all(html, F.lit(pattern), 1)
    return df.select(*[c for c in df.columns if c != html], F.posexplode(found).alias("position", "link"))
