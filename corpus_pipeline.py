"""A corpus pipeline: each stage works on all that the one before kept.

Stages, in order: quality rules, exact dedup, n-gram Jaccard join (one document
of each group stays), mixing sources to target weights, BPE encoding. Every
stage takes and returns rows with the columns of ``documents``, but the last,
which returns token counts and digests. A stage's result is written as Parquet
to the shared folder and read again by the next, so a lost executor costs one
stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightlake.llm import block_naming, bpe_codec, chosen_path, quality_rules, source_mix
from flightlake.llm.common import columns, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's adaptive thresholds."""
    return quality_rules.filter_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in either case) the row with the largest doc_id."""
    return block_naming.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each group linked by five-word
    shingle similarity of 0.8 or more."""
    return chosen_path.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents with repetitions, sources at their target weights."""
    return source_mix.mix(docs).select(*columns(docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, a row per mixed document."""
    return bpe_codec.encode_digests(docs, keep=["doc_id", "source"])


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("chosen_path_join", near_dedup),
    ("source_mix", mixed),
    ("bpe_codec", encoded),
]

# The later stages draw by hashes and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
