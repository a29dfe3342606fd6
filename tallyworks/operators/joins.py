"""Joins, keyed updates and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.keyed import newest_per_key


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join facts to a lookup with at most one row per key, reading each side once.

    Whether the lookup is broadcast is Spark's choice by its size in bytes. In a
    shuffle join adaptive execution splits a hot key's (or the nulls') partition of
    facts over tasks and gives each the key's one lookup row; ``build_session``
    lets it do so even where that costs another shuffle.
    """
    return facts.join(lookup, list(keys), how)


def membership(probes: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Distinct non-null keys of ``probes``, and whether each is among ``keys``."""
    asked = probes.select(column).where(F.col(column).isNotNull()).distinct()
    known = keys.select(column).distinct().withColumn("__known", F.lit(True))
    return asked.join(known, column, "left").select(column, F.coalesce("__known", F.lit(False)).alias("member"))


def require_keys(keys_table: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lookup rows of the given keys; a key that is not in the lookup is an error."""
    missing = keys_table.select(*keys).distinct().join(lookup, list(keys), "left_anti").limit(5).collect()
    if missing:
        raise LookupError(f"unknown keys: {[tuple(r) for r in missing]}")
    return keys_table.join(lookup, list(keys))


def lookup_or_zero(keys_table: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Value of each key in a lookup, 0 where the key is missing."""
    joined = lookup_join(keys_table, lookup, keys)
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def update_by_key(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Replace columns by a newer batch; rows without an update, and nulls in the batch, keep the old values.

    If the batch repeats a key its highest values count, so no row is doubled. ``sources.keyed``
    updates a stored table in place and can set nulls.
    """
    fresh = newest_per_key(new.select(key, *columns), key).select(key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = lookup_join(old, fresh, [key])
    merged = {c: F.coalesce(F.col(f"__new_{c}"), F.col(c)) for c in columns}
    return joined.withColumns(merged).select(*old.columns)


def remove_stop_words(words: DataFrame, stop_words: DataFrame, column: str = "word") -> DataFrame:
    """Keep the words that are not listed."""
    listed = stop_words.select(F.col(stop_words.columns[0]).alias(column)).distinct()
    return words.join(listed, column, "left_anti")


def fetch_ranked(rows: DataFrame, ranked: DataFrame, key: str) -> DataFrame:
    """Rows for a ranked id list; keeps the rank column of the list."""
    return rows.join(ranked, key)


def with_grid(categories: DataFrame, **axes: Sequence) -> DataFrame:
    """Every category with every value of each axis (periods, pages): one row
    generates its own combinations, so nothing is joined or shuffled."""
    out = categories
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out
