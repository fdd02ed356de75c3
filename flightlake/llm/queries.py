"""The operators applied to the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (anchor_dedup, block_naming, bpe_codec, chat_format, chosen_path, impact_search, length_histogram, license_scan,
               pairwise_quality, pii_surrogates, quality_rules, source_divergence, source_mix)
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_summary(license_scan.scan_licenses(table(spark, sf_dir, "documents")))


def op2_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = length_histogram.token_histogram(table(spark, sf_dir, "documents"))
    return length_histogram.with_quantiles(sums, "source")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.with_verdict(table(spark, sf_dir, "documents"), keep=["doc_id", "lang", "source"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in counts], F.col("quality_kept").alias("kept"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_summary(table(spark, sf_dir, "documents"))


def op5_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii_surrogates.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), pii_surrogates.session_key(spark))
    return done.select("doc_id", "text", F.col("pii.n_entities").alias("n_entities"), F.col("pii.kinds").alias("kinds"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_digests(table(spark, sf_dir, "documents"))


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.dedup_groups(table(spark, sf_dir, "documents")).drop("row")


def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similarity_classes(table(spark, sf_dir, "documents")).drop("row")


# A conversation whose texts hold control strings, added to every table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turn = F.col("id")  # two rows made by Spark itself
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"),
                                  F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat_format.round_trip(chat_format.format_conversations(chat_format.conversations(rows.unionByName(probe))))


def op11_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence_audit(table(spark, sf_dir, "documents"))


def op13_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_dedup.find_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_token_histogram, op3_quality_rules, op4_source_mix, op5_pairwise_quality,
                                op6_pii_surrogates, op7_bpe_codec, op8_block_naming, op9_chosen_path_join, op10_chat_format, op11_impact_search,
                                op12_source_divergence, op13_anchor_dedup)}
