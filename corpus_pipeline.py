"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes
each result as Parquet to the shared folder and reads it for the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import contamination, minhash, pieces, quality, substrings
from tallyworks.llm.queries import table
from tallyworks.session import materialize

# The stages fit models and tokenize; SQL cannot express them. Tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that repeat an earlier place; n_chars is counted anew."""
    return substrings.drop_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked against the sentencepiece library and by decoding."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.encode_texts(docs, model).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("piece encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
