"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontamination, html_text, lexical_search, line_dedup, quality, sharding, simhash_dedup, token_counts, token_file, tokenizer_alignment, toxicity, warc
from .tables import read, utf8_bytes

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sharding.new_path(spark)
    sharding.scatter(read(spark, sf_dir, "documents"), path)
    text = F.coalesce("record.text", F.lit(""))
    return sharding.shards(spark, path).select(
        "record.doc_id", (utf8_bytes(text) + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "lines_total", "lines_dropped", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_file.new_path(spark)
    token_file.write(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_file.with_starts(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash_dedup.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.top_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.new_path(spark)
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "place")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return tokenizer_alignment.align(read(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)


ALL = (
    op1_decontamination, op2_byte_bpe, op3_token_counts, op4_quality_rules, op5_sharding,
    op6_html_text, op7_line_dedup, op8_token_file, op9_toxicity, op10_simhash_dedup,
    op11_lexical_search, op12_warc, op13_tokenizer_alignment,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in ALL}
ORACLES: dict[str, str] = {"op1_decontamination": decontamination.ORACLE, "op11_lexical_search": lexical_search.ORACLE}
