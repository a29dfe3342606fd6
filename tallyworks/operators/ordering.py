"""Row numbers and running totals over a whole table.

A window without ``partitionBy`` puts every row in one task. These functions
range-sort the table instead, store it once, and add a start value per range.
``order`` must identify a row, so that equal sort keys can spread over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import materialize

_POSITION = "__position"
_RANGE = "__range"
_START = "__start"
# monotonically_increasing_id keeps the row offset in the low 33 bits.
_OFFSET_BITS = 33


def _range_sorted(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    ranked = df.orderBy(*order).withColumn(_POSITION, F.monotonically_increasing_id())
    return materialize(ranked, "sorted").withColumn(_RANGE, F.shiftright(_POSITION, _OFFSET_BITS))


def _with_starts(stored: DataFrame, amount: Column) -> DataFrame:
    """Attach the total amount of all earlier ranges; one driver row per range."""
    sums = sorted(stored.groupBy(_RANGE).agg(amount.alias("amount")).collect())
    starts, total = [], 0
    for part, part_sum in sums:
        starts.append((part, total))
        total += part_sum or 0
    kind = "double" if isinstance(total, float) else "bigint"
    starts = [(part, float(s) if kind == "double" else s) for part, s in starts]
    table = stored.sparkSession.createDataFrame(starts, f"{_RANGE} bigint, {_START} {kind}")
    return stored.join(F.broadcast(table), _RANGE)


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_number",
                first: int = 1) -> DataFrame:
    """Add 1, 2, 3, ... in the given total order."""
    stored = _range_sorted(df, order)
    offset = F.col(_POSITION).bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1))
    numbered = _with_starts(stored, F.count(F.lit(1)))
    return (numbered.withColumn(name, F.col(_START) + offset + F.lit(first))
            .drop(_POSITION, _RANGE, _START))


def running_total(df: DataFrame, order: Sequence[Column | str], weight: str,
                  name: str = "running_total", inclusive: bool = True) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to this one (or before it)."""
    stored = _with_starts(_range_sorted(df, order), F.sum(weight))
    within = (Window.partitionBy(_RANGE).orderBy(_POSITION)
              .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = F.coalesce(F.sum(weight).over(within), F.lit(0))
    return stored.withColumn(name, F.col(_START) + local).drop(_POSITION, _RANGE, _START)


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int | None = None) -> DataFrame:
    """The first ``n`` rows of a total order, spread over tasks when ``n`` is large; all rows if None."""
    if n is None:
        return df
    numbered = number_rows(df, order, "__number")
    return numbered.where(F.col("__number") <= n).drop("__number")
