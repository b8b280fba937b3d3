"""The queries of this subpackage: thin layers over its operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, packing, quality, secrets, sharding, simhash, substring, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings_of(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = secrets.as_text(F.col("found"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("p_quality", 6).alias("p_quality"))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "first_word", "n_words", F.col("first_id").alias("first_doc_id"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits().alias("fingerprint"), F.col("component").alias("component_id"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.round("score", 6).alias("score"), F.round("question_overlap", 6).alias("question_overlap"), F.round("answer_overlap", 6).alias("answer_overlap"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~langid.held_out())
    return langid.identify(docs, model).select(F.col("id").alias("doc_id"), langid.held_out("id").alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_substring": op3_substring,
    "op4_sharding": op4_sharding,
    "op5_chat": op5_chat,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_langid": op9_langid,
    "op10_warc": op10_warc,
}

ORACLES: dict[str, str] = {
    "op1_secrets": secrets.SQL,
    "op5_chat": chat.SQL,
    "op10_warc": warc.SQL,
}
