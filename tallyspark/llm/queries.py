"""One query per operator over the whole of its table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import (
    bpe,
    chat,
    cotraining,
    dart_minhash,
    decontaminate,
    divergence,
    language_model,
    line_dedup,
    pii,
    quality_rules,
    secret_scan,
    vector_codes,
    warc,
)
from tallyspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by both views and together."""
    docs = table(spark, sf_dir, "documents")
    return cotraining.score(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


def op2_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the public byte-level vocabulary."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op3_quality_rules_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.score(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.windows(turns))


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies."""
    return dart_minhash.report(table(spark, sf_dir, "documents"))


def op6_line_dedup_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to Zstandard archives and read back."""
    records = warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op9_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document."""
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op10_decontaminate_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that leaked into it."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the terms of each source differ from those of the other sources of its language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by codebooks trained on all of them."""
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_cotraining": op1_quality_cotraining,
    "op2_bpe_prefix_dp": op2_bpe_prefix_dp,
    "op3_quality_rules_gbt": op3_quality_rules_gbt,
    "op4_chat_windows": op4_chat_windows,
    "op5_dart_minhash": op5_dart_minhash,
    "op6_line_dedup_minhash": op6_line_dedup_minhash,
    "op7_warc_zstd": op7_warc_zstd,
    "op8_pii_boosting": op8_pii_boosting,
    "op9_backoff_automaton": op9_backoff_automaton,
    "op10_decontaminate_spaced_seeds": op10_decontaminate_spaced_seeds,
    "op11_source_divergence": op11_source_divergence,
    "op12_vector_codes": op12_vector_codes,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES: dict[str, str] = {"op11_source_divergence": divergence.ORACLE, "op12_vector_codes": vector_codes.ORACLE}
