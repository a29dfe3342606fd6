"""Column choice, row filters and small repairs on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.cells import any_zero
from tallyworks.operators.joins import lookup_join
from tallyworks.operators.quantiles import mode_of
from tallyworks.session import materialize

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC or kind.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def blank_to_null(df: DataFrame, sentinel: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn a text that stands for 'missing' into null."""
    chosen = text_columns(df) if columns is None else columns
    return df.withColumns({c: F.when(F.col(c) != sentinel, F.col(c)) for c in chosen})


def drop_zero_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with 0 in any column; nulls stay."""
    return df.where(~any_zero(columns))


def keep_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Drop rows outside [low, high]; nulls stay, as they compare to nothing."""
    c = F.col(column)
    if low is not None:
        df = df.where(c.isNull() | (c >= low))
    if high is not None:
        df = df.where(c.isNull() | (c <= high))
    return df


def drop_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def match_text(df: DataFrame, column: str, text: str, literal: bool = False) -> DataFrame:
    """Rows whose text matches a pattern (or contains it, without case)."""
    c = F.col(column)
    return df.where(F.lower(c).contains(text.lower()) if literal else c.rlike(text))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a map; a name that is not a column is an error."""
    unknown = sorted(set(names) - set(df.columns))
    if unknown:
        raise KeyError(f"no such columns: {unknown}")
    return df.withColumnsRenamed(dict(names))


def repair_with_group_mode(df: DataFrame, bad: Column, column: str, group: str) -> DataFrame:
    """Replace bad values by the most frequent value of their group."""
    modes = materialize(mode_of(df, column, [group], "__mode"), "modes")
    repaired = lookup_join(df, modes, [group])
    return repaired.withColumn(column, F.when(bad, F.col("__mode")).otherwise(F.col(column))).drop("__mode")


def fill_from_neighbours(df: DataFrame, column: str, place: Sequence[str]) -> DataFrame:
    """Fill nulls with the mode of rows at the same place, else of the table.

    A row without a place stays null.
    """
    overall = mode_of(df, column).first()
    default = F.lit(overall["mode"]) if overall else F.lit(None)
    known = df.where(F.col(column).isNotNull())
    for c in place:
        known = known.where(F.col(c).isNotNull())
    modes = materialize(mode_of(known, column, place, "__mode"), "modes")
    filled = F.coalesce(F.col(column), F.col("__mode"), default)
    has_place = F.lit(True)
    for c in place:
        has_place = has_place & F.col(c).isNotNull()
    joined = lookup_join(df, modes, place)
    return joined.withColumn(column, F.when(has_place, filled).otherwise(F.col(column))).drop("__mode")
