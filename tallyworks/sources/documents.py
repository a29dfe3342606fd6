"""Collections whose documents have fields of their own: no schema is declared.

Documents are lines of JSON. Each one is kept as a variant value; ``found_schema`` finds the
schema of all of them in one aggregate, with every field that any document has. A field
whose type changes from document to document stays a variant, so no value is lost or forced
into another type; ``field_types`` counts what each field holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str, column: str = "doc") -> DataFrame:
    """(doc, malformed): each line as a variant; a line that is not JSON is null there and kept in ``malformed``."""
    return parse_documents(spark.read.text(path), "value", column).drop("value")


def parse_documents(df: DataFrame, text: str, column: str = "doc") -> DataFrame:
    parsed = df.withColumn(column, F.try_parse_json(text))
    return parsed.withColumn("malformed", F.when(F.col(column).isNull() & (F.trim(text) != ""), F.col(text)))


def write_documents(df: DataFrame, path: str, column: str = "doc") -> None:
    """Variants as lines of JSON; null ones are left out."""
    df.where(F.col(column).isNotNull()).select(F.to_json(column).alias("value")).write.text(path)


def found_schema(docs: DataFrame, column: str = "doc") -> str:
    """The least type that holds all documents, as Spark writes it; fields of changing type, or always null, are variants."""
    found = docs.agg(F.schema_of_variant_agg(column).alias("s")).first()["s"]
    if found in (None, "VOID"):
        return "STRUCT<>"
    return re.sub(r": VOID\b", ": VARIANT", re.sub(r"<VOID>", "<VARIANT>", re.sub(r"\bOBJECT<", "STRUCT<", found)))


def flattened(docs: DataFrame, column: str = "doc", schema: str | None = None) -> DataFrame:
    """A column per field of the documents, nested ones as structs, next to the other columns of ``docs``.

    A field that a document lacks is null. Variants stay variants (``as_text`` and ``type_name`` read them).
    """
    schema = schema or found_schema(docs, column)
    if not re.match(r"STRUCT<.", schema):
        return docs.drop(column) if schema == "STRUCT<>" else docs
    whole = F.try_variant_get(F.col(column), "$", schema).alias("__doc")
    rest = [c for c in docs.columns if c != column]
    return docs.select(*rest, whole).select(*rest, "__doc.*")


def as_text(value: Column) -> Column:
    """A variant as text: strings without quotes, everything else as JSON."""
    return F.coalesce(F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")), F.to_json(value))


def type_name(value: Column) -> Column:
    """What a variant holds, objects and arrays without their inside."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def field_types(docs: DataFrame, column: str = "doc", depth: int = 3) -> DataFrame:
    """(field, type, documents): how often each field, nested ones with dots, holds each type.

    Fields are counted level by level down to ``depth``; array elements are not taken apart.
    """
    level = docs.select(F.lit("").alias("__at"), F.col(column).alias("__v")).where(F.col("__v").isNotNull())
    every = None
    for _ in range(depth):
        level = level.where(type_name(F.col("__v")) == "OBJECT")
        rows = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("__v").outer())).select(
            F.concat("__at", "key").alias("field"), F.col("value").alias("__v"))
        counts = rows.groupBy("field", type_name(F.col("__v")).alias("type")).agg(F.count(F.lit(1)).alias("documents"))
        every = counts if every is None else every.union(counts)
        level = rows.select(F.concat("field", F.lit(".")).alias("__at"), "__v")
    return every
