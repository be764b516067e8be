"""Documents to tokens: quality rules, line dedup, near-duplicate removal, benchmark decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the columns of `documents`.

Defined results: a null or empty text fails the base rules and goes in the first stage; later stages, given such texts, keep them (line
dedup keeps nulls null, near-dedup keeps one document of all texts without words); repeated rows are judged alike, equal lines of one key and
text count as one document, and near-dedup keeps one row of a group, that of the smallest key (null keys last); texts of any length are
worked on whole; an empty table stays empty through all stages; extra columns of `documents` pass through under their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm import byte_bpe, decontamination, line_dedup, quality, simhash_dedup
from lociweave.llm.tables import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a learned rule go."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def fuzzy_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; every document stays, with its new length."""
    counts = {c: f"__own_{c}" for c in ("lines_total", "lines_dropped") if c in docs.columns}  # names that the operator adds
    kept = line_dedup.deduplicate_lines(docs.withColumnsRenamed(counts)).select(*[F.col(counts.get(c, c)).alias(c) for c in docs.columns])
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_dedup.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digests of the ids and of the bytes that they decode to."""
    out = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", fuzzy_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", tokens),
]

#: Learned rules, SimHash values and token ids are not SQL; tests compare with a serial version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
