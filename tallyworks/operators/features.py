"""Feature columns: codes, dummies, scaling, power transform, splits."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import lookup_join
from tallyworks.operators.ordering import number_rows
from tallyworks.session import materialize

# A result with one column per value has at most so many, unless the caller allows more; a
# column with more values is an error there. The sparse forms have no such limit.
WIDTH = 1000
# Length of the pieces by which texts are searched for tokens.
PIECE = 3


def category_codes(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add the position of each value among the sorted distinct ones; null is -1."""
    name = name or f"{column}_code"
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = number_rows(values, [column], name, first=0)
    return lookup_join(df, codes, [column]).withColumn(name, F.coalesce(name, F.lit(-1)).cast("int"))


def _up_to(values: DataFrame, width: int, column: str, other: str) -> list:
    """The values; more than ``width`` are an error."""
    rows = values.limit(width + 1).collect()
    if len(rows) > width:
        raise ValueError(f"column {column} has more than {width} values: allow more, or ask for form={other!r}")
    return [row[0] for row in rows]


def _known_form(form: str, *forms: str) -> None:
    if form not in forms:
        raise ValueError(f"form is one of {forms}, not {form!r}")


def code_vector(df: DataFrame, code: str, name: str) -> DataFrame:
    """A code as a sparse 0/1 vector; place 0 stands for code -1 (no value). The code goes."""
    shifted = df.withColumn("__place", (F.col(code) + 1).cast("double"))
    encoder = OneHotEncoder(inputCol="__place", outputCol=name, dropLast=False)
    return encoder.fit(shifted).transform(shifted).drop("__place", code)


def one_hot_by_appearance(df: DataFrame, column: str, key: str, form: str = "columns", width: int = WIDTH) -> DataFrame:
    """0/1 columns numbered by first appearance in key order; the source column goes.

    ``form`` "columns" gives a column per value, "vector" one sparse vector
    ``<column>_vector`` in the same order, whatever the number of values.
    """
    _known_form(form, "columns", "vector")
    seen = df.groupBy(column).agg(F.min(key).alias("__first"))
    if form == "vector":
        codes = number_rows(seen.where(F.col(column).isNotNull()), ["__first", column], "__code", first=0)
        coded = lookup_join(df, codes.select(column, "__code"), [column])
        return code_vector(coded.withColumn("__code", F.coalesce("__code", F.lit(-1))), "__code",
                           f"{column}_vector").drop(column)
    values = _up_to(seen.orderBy("__first").select(column), width, column, "vector")
    dummies = {f"{column}_{i + 1}": F.col(column).eqNullSafe(F.lit(v)).cast("int") for i, v in enumerate(values)}
    return df.withColumns(dummies).drop(column)


def dummies_by_value(df: DataFrame, columns: Sequence[str], form: str = "columns", width: int = WIDTH) -> DataFrame:
    """0/1 columns named after the value, in sorted order; null gives all 0.

    ``form`` "columns" gives a column per value, "vector" one sparse vector
    ``<column>_vector`` per column, over its values in sorted order.
    """
    _known_form(form, "columns", "vector")
    out = df
    for column in columns:
        if form == "vector":
            out = code_vector(category_codes(out, column, "__code"), "__code", f"{column}_vector").drop(column)
            continue
        values = _up_to(df.select(column).where(F.col(column).isNotNull()).distinct(), width, column, "vector")
        out = out.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
                               for v in sorted(values)}).drop(column)
    return out


def distinct_tokens(df: DataFrame, column: str, separator: str = " ") -> DataFrame:
    return df.select(F.explode(F.split(column, separator)).alias("token")).distinct()


def dummies_by_token(df: DataFrame, column: str, form: str = "columns", width: int = WIDTH) -> DataFrame:
    """One 0/1 column per token of any row: 1 where the text *contains* it.

    ``form`` "columns" gives a column per token, "list" one column ``<column>_tokens``,
    the sorted list of the tokens that the text contains (null for a null text).
    """
    _known_form(form, "columns", "list")
    if form == "list":
        return _contained_tokens(df, column)
    tokens = _up_to(distinct_tokens(df, column), width, column, "list")
    return df.withColumns({f"{column}_{t}": F.coalesce(F.col(column).contains(t), F.lit(False)).cast("int")
                           for t in sorted(tokens)}).drop(column)


def _pieces(text: Column, size: int) -> Column:
    """Distinct runs of ``size`` characters."""
    at = F.when(F.char_length(text) >= size, F.sequence(F.lit(1), F.char_length(text) - size + 1))
    return F.array_distinct(F.transform(F.coalesce(at, F.array().cast("array<int>")), lambda i: F.substring(text, i, F.lit(size))))


def containing(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(text, needle) for every distinct text and needle it contains; both tables have one column of distinct strings.

    Texts are indexed by their distinct pieces of ``PIECE`` characters, which are no more than
    their characters. A needle is looked up by the one of its pieces that the fewest texts have, and what that
    finds is checked. Shorter needles are looked up whole, among pieces of their size; an empty one is in all texts.
    """
    text, needle = texts.columns[0], needles.columns[0]
    sized = materialize(needles.select(F.col(needle).alias("__n"), F.char_length(needle).alias("__c")), "needles")
    small = sorted(r[0] for r in sized.where(F.col("__c") < PIECE).select("__c").distinct().collect())
    sizes = [PIECE, *[c for c in small if c > 0]]
    index = texts.select(F.col(text).alias("__t"), F.explode(F.flatten(F.array(*[_pieces(F.col(text), c) for c in sizes]))).alias("__p"))
    index = materialize(index, "pieces")
    held = index.groupBy("__p").agg(F.count(F.lit(1)).alias("__held"))
    asked = sized.where("__c > 0").select(
        "__n", F.explode(F.when(F.col("__c") < PIECE, F.array("__n")).otherwise(_pieces(F.col("__n"), PIECE))).alias("__p"))
    # a piece that no text has rules its needle out
    rarest = asked.join(held, "__p", "left").groupBy("__n").agg(
        F.min(F.struct(F.coalesce("__held", F.lit(0)).alias("held"), F.col("__p"))).alias("r")).where("r.held > 0")
    found = rarest.select("__n", F.col("r.__p").alias("__p")).join(index, "__p").where(F.contains(F.col("__t"), F.col("__n")))
    pairs = found.select(F.col("__t").alias("text"), F.col("__n").alias("needle"))
    if 0 in small:
        pairs = pairs.union(texts.select(F.col(text), F.lit("")))
    return pairs


def _contained_tokens(df: DataFrame, column: str) -> DataFrame:
    """A text contains a token exactly if one of its own tokens does, so distinct tokens are searched, not texts."""
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    tokens = materialize(distinct_tokens(rows, column), "tokens")
    found = containing(tokens, tokens).withColumnsRenamed({"text": "__own", "needle": "token"})
    own = rows.select("__row", F.explode(F.split(column, " ")).alias("__own")).distinct()
    lists = own.join(found, "__own").groupBy("__row").agg(F.sort_array(F.collect_set("token")).alias(f"{column}_tokens"))
    return rows.join(lists, "__row", "left").drop("__row", column)


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Numeric columns as one vector; a row with a null is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


def quadratic_terms(df: DataFrame, column: str = "features", name: str = "terms") -> DataFrame:
    """All products up to degree 2, without the constant term."""
    return PolynomialExpansion(degree=2, inputCol=column, outputCol=name).transform(df)


def standard_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(value - mean) / population standard deviation; a constant column gives 0."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return df.withColumns({
        c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0) for c in columns})


def scaled_like(known: DataFrame, columns: Sequence[str], *tables: DataFrame) -> list[DataFrame]:
    """Tables standardised by the means and deviations of ``known``."""
    stats = known.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(columns)
                        for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return [t.withColumns({c: (F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0)
                           for i, c in enumerate(columns)}) for t in tables]


def correlation_importances(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, importance): squared correlation of each column with the label, in one pass."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"r{i}")
                   for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(c).alias("feature"), (F.col(f"r{i}") * F.col(f"r{i}")).alias("importance"))
               for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*entries)))


def yeo_johnson(c: Column, power: Column) -> Column:
    """Power transform for any sign: with l = log(1 + |c|) and p the power (or
    2 - power below zero) it is sign(c) * (exp(p * l) - 1) / p."""
    return _from_log(F.log1p(F.abs(c)), c >= 0, power)


def _from_log(log: Column, positive: Column, power: Column) -> Column:
    p = F.when(positive, power).otherwise(2 - power)
    grown = F.when(F.abs(p) < 1e-12, log).otherwise(F.expm1(p * log) / p)
    return F.when(positive, grown).otherwise(-grown)


def power_grid(df: DataFrame, powers: Mapping[str, Sequence[float]]) -> DataFrame:
    """Log-likelihood of each column's powers, in one pass.

    A value meets every power in its own task; only one partial sum per column
    and power is shuffled.
    """
    columns = list(powers)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value").where("value is not null")
    logs = values.select("column", F.log1p(F.abs("value")).alias("log"), (F.col("value") >= 0).alias("positive"))
    own = F.coalesce(*[F.when(F.col("column") == c, F.array(*[F.lit(float(p)) for p in ps]))
                       for c, ps in powers.items()])
    tried = logs.withColumn("power", F.explode(own))
    fit = -F.count(F.lit(1)) / 2 * F.log(F.var_pop(_from_log(F.col("log"), F.col("positive"), F.col("power"))))
    jacobian = (F.col("power") - 1) * F.sum(F.when(F.col("positive"), F.col("log")).otherwise(-F.col("log")))
    return tried.groupBy("column", "power").agg((fit + jacobian).alias("fit"))


def best_powers(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Power with the highest likelihood per column, to ``digits`` decimals.

    Whole powers are tried first, on and on while the best one is the last one
    tried and the likelihood is finite beyond it; then the neighbourhood of the best at a tenth of the step, until the step is
    as fine as asked. Every pass is one aggregate over all columns. ``at_end``: powers
    beyond the one found overflow, so a better one may lie there.
    """
    tried: dict[str, dict[float, float]] = {c: {} for c in columns}
    places = dict.fromkeys(columns, 0)
    asked = {c: [float(p) for p in range(-2, 3)] for c in columns}
    while asked:
        for row in power_grid(df, asked).collect():
            if row["fit"] is not None and math.isfinite(row["fit"]):
                tried[row["column"]][row["power"]] = row["fit"]
        following = {}
        for c in asked:
            if not tried[c]:
                continue
            best = max(tried[c], key=lambda p: (tried[c][p], -abs(p)))
            if best in (min(asked[c]), max(asked[c])) and places[c] == 0 and abs(best) > 1:
                side = 1 if best > 0 else -1
                following[c] = [best + side * k for k in range(-1, int(min(64, max(5, abs(best)))))]
            elif places[c] < digits:
                places[c] += 1
                step = 10.0 ** -places[c]
                following[c] = [round(best + k * step, places[c]) for k in range(-10, 11)]
        asked = following
    rows = [(c, best, tried[c][best], best in (min(tried[c]), max(tried[c]))) for c in columns if tried[c]
            for best in [max(tried[c], key=lambda p: (tried[c][p], -abs(p)))]]
    return df.sparkSession.createDataFrame(rows, "column string, power double, fit double, at_end boolean")


def power_transformed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reduce skew by the best power of each column, then standardise."""
    powers = {row["column"]: row["power"] for row in best_powers(df, columns).collect()}
    changed = df.withColumns({c: yeo_johnson(F.col(c).cast("double"), F.lit(p)) for c, p in powers.items()})
    return standard_scaled(changed, columns)


def in_training_part(key: Column, share: float = 0.8) -> Column:
    """Repeatable split: true for about ``share`` of the keys, by their MD5."""
    digits = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return digits % 10_000 < math.floor(share * 10_000)


def important_features(importances: DataFrame, median: float) -> DataFrame:
    """Features at or above the median importance."""
    return importances.where(F.col("importance") >= median)
