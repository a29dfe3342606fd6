"""Cell-level parsing, text and ratio expressions: Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.functions.fixed_values import CJK_RUN, HAN_RUN, ID_LINK_PREFIXES, POSITION, PRICE_BANDS, WORD_RUN


# A failing try_cast costs an exception per row, so texts are matched first.
_WHOLE = r"^\s*[-+]?[0-9]+\s*$"
_DECIMAL = r"^\s*[-+]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"


def whole(c: Column, kind: str = "bigint") -> Column:
    """Whole number, null if the text is not one."""
    return F.when(c.rlike(_WHOLE), c.try_cast(kind))


def int_or_zero(c: Column) -> Column:
    """Whole number, 0 if the text is not one. A whole number beyond 64 bits is an
    error: a silent 0 or a wrapped value would falsify sums."""
    beyond = F.raise_error(F.concat(F.lit("whole number beyond 64 bits: "), c)).cast("bigint")
    return F.when(c.rlike(_WHOLE), F.coalesce(c.try_cast("bigint"), beyond)).otherwise(F.lit(0).cast("bigint"))


def pair_or_zero(price: Column, count: Column) -> Column:
    """(price, count); both 0 if either text does not parse."""
    p, known = to_number(price), F.coalesce(count.rlike(_WHOLE), F.lit(False))
    bad = p.isNull() | ~known
    return F.struct(F.when(bad, F.lit(0.0)).otherwise(p).alias("price"),
                    F.when(bad, F.lit(0)).otherwise(int_or_zero(count)).alias("count"))


def to_number(c: Column) -> Column:
    """Double, null if the text is not a number."""
    return F.when(c.rlike(_DECIMAL), c.try_cast("double"))


def typed_text(c: Column, keep_text: bool = False) -> Column:
    """Text typed by its form: digits are a long, a decimal or exponent form a
    double (left as text with ``keep_text``), '-' is long 0, the rest text. Digits
    beyond 64 bits stay text, so none is lost."""
    digits = F.coalesce(c.rlike("^[0-9]+$"), F.lit(False)) & c.try_cast("bigint").isNotNull()
    many = c.rlike("^[0-9]+$") & c.try_cast("bigint").isNull()
    decimal = ~digits & ~many & c.rlike(r"^[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?$") & F.lit(not keep_text)
    dash = c == "-"
    kind = F.when(digits | dash, "long").when(decimal, "double").when(c.isNotNull(), "text")
    return F.struct(
        kind.alias("kind"),
        F.when(dash, F.lit(0)).when(digits, c.try_cast("bigint")).alias("long"),
        F.when(decimal, c.try_cast("double")).alias("double"),
        F.when(kind == "text", c).alias("text"))


def letter_words(c: Column) -> Column:
    """Array of pieces between non-letters, empty pieces included."""
    return F.split(c, "[^a-zA-Z]")


def before(c: Column, marker: str) -> Column:
    return F.substring_index(c, marker, 1)


def strip_unit(c: Column, unit: str) -> Column:
    return F.replace(c, F.lit(unit), F.lit(""))


def squeeze(c: Column) -> Column:
    """Text without spaces, newlines and tabs."""
    return F.regexp_replace(c, "[ \n\t]", "")


def script_runs(c: Column, pattern: str = CJK_RUN) -> Column:
    """Runs of one script joined by a space."""
    return F.array_join(F.regexp_extract_all(c, F.lit(pattern), 0), " ")


def words(c: Column) -> Column:
    """Lower-case words: runs of letters, marks and numbers of any script; a
    Chinese run becomes its character pairs."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(f"{WORD_RUN}|{HAN_RUN}"), 0)
    pairs = lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, 2))
    cut = lambda t: F.when(t.rlike(f"^{HAN_RUN}") & (F.length(t) > 1), pairs(t)).otherwise(F.array(t))
    return F.when(c.rlike(HAN_RUN), F.flatten(F.transform(tokens, cut))).otherwise(tokens)


def range_midpoint(c: Column) -> Column:
    """'5500' stays, '5000-6000' becomes its mean; odd forms become null."""
    text = c.cast("string")
    low, high = to_number(F.substring(text, 1, 4)), to_number(F.substring(text, 6, 4))
    return F.when(F.length(text) > 4, (low + high) / 2).otherwise(to_number(text))


def year_prefix(c: Column) -> Column:
    return whole(F.substring(c.cast("string"), 1, 4), "int")


def leading_small_int(c: Column) -> Column:
    """First two characters as a byte-sized number."""
    return whole(F.substring(c, 1, 2), "tinyint")


def named_numbers(c: Column, pattern: str, names: Sequence[str]) -> list[Column]:
    """One long column per group of ``pattern``; null where it does not match."""
    return [F.when(c.rlike(pattern), F.regexp_extract(c, pattern, i + 1)).try_cast("bigint").alias(name)
            for i, name in enumerate(names)]


def to_time(c: Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(c, F.lit(form))


def month_digits(c: Column) -> Column:
    """Month of a 'yyyyMMdd' text."""
    return whole(F.substring(c, 5, 2), "int")


def guarded_ratio(x: Column, views: Column) -> Column:
    return x / (views + 1)


def plain_ratio(x: Column, views: Column) -> Column:
    """Ratio, null at 0 views."""
    return F.try_divide(x, views)


def interaction(a: Column, b: Column, views: Column) -> Column:
    return (a + b) / F.log(views + 2)


def errors(actual: Column, predicted: Column) -> list[Column]:
    """Absolute and relative error."""
    gap = F.abs(predicted - actual)
    return [gap.alias("abs_err"), F.try_divide(gap, actual).alias("ape")]


def join_list(items: Column, separator: str = "、") -> Column:
    return F.array_join(items, separator)


def swap_separator(c: Column, old: str = "/", new: str = ".") -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def clean_id(c: Column) -> Column:
    """Lower case without leading or trailing a / v."""
    return F.regexp_replace(F.lower(c), "^[av]+|[av]+$", "")


def id_link(c: Column, base: str) -> Column:
    """Link of an item; a bare number gets the 'av' prefix."""
    known = reduce(lambda a, b: a | b, [c.startswith(p) for p in ID_LINK_PREFIXES])
    return F.concat(F.lit(base), F.when(known, c).otherwise(F.concat(F.lit("av"), c)))


def position_pair(c: Column) -> list[Column]:
    """Longitude and latitude texts of a position literal in page text."""
    return [F.get(F.regexp_extract_all(c, F.lit(POSITION), i), F.lit(0)).alias(name)
            for i, name in ((1, "longitude"), (2, "latitude"))]


def skip_label(c: Column, width: int = 4) -> Column:
    """Text after a fixed-width label, trimmed."""
    return F.trim(F.substring(c, width + 1, 2_000_000_000))


def unwrap_jsonp(c: Column) -> Column:
    """JSON object inside a callback call."""
    inner = F.regexp_extract(c, r"(?s)\((\{.*)\)\s*;?\s*$", 1)
    return F.when(inner != "", inner)


def open_between(c: Column, low: float, high: float) -> Column:
    return (c > low) & (c < high)


def price_band(c: Column) -> Column:
    """Band label; a price on an edge or outside all bands has none."""
    bands = [F.when(open_between(c, low, high), F.lit(label)) for low, high, label in PRICE_BANDS]
    return F.coalesce(*bands)


def any_zero(columns: Sequence[str]) -> Column:
    """True where any column is 0; null is not 0."""
    return reduce(lambda a, b: a | b, [F.col(c).eqNullSafe(F.lit(0)) for c in columns])
