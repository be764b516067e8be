"""Readers for interval calls, events, alignments, sequences and path tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as k
from ..operators.interval_join import interval_join
from ..operators.scan import ordered_scan
from ..session import materialize
from .text import numbered_lines, read_headerless, read_table

# Input column names in order.
GENOMES = ["hal_genome", "role", "cpgi_bed", "sv_tsv"]
PATHS = ["gfa_record_type", "gfa_sample", "gfa_haplotype", "gfa_sequence", "gfa_path_name", "hal_genome", "hal_sequence"]
EXCLUSIONS = ["hal_genome", "hal_sequence"]
EVENTS = ["ref_contig", "ref_pos1", "ref_end1", "sv_id", "sv_type", "asm_contig", "asm_start0", "asm_end0", "sv_length"]
BED = ["contig", "start0", "end0", "name", "length", "cpg_n", "gc_n", "pct_cpg", "pct_gc", "oe"]
PSL = [
    "fid", "matches", "mismatches", "rep_matches", "n_count", "q_num_ins", "q_base_ins", "t_num_ins", "t_base_ins",
    "strand", "q_name", "q_size", "q_start", "q_end", "t_name", "t_size", "t_start", "t_end", "block_count",
    "block_sizes", "q_starts", "t_starts",
]


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED10 rows as text; `contracts.inputs.bed_violations` lists what is wrong with them."""
    return read_headerless(spark, path, BED)


def typed_bed(bed: DataFrame) -> DataFrame:
    c = F.col
    return bed.select(
        "contig", c("start0").cast("long"), c("end0").cast("long"), "name",
        c("length").cast("double").cast("long").alias("length"), c("cpg_n").cast("double").cast("long").alias("cpg_n"),
        c("gc_n").cast("double").cast("long").alias("gc_n"),
        *[c(n).cast("double") for n in ("pct_cpg", "pct_gc", "oe")],
    )


def read_features(spark: SparkSession, path: str, genome_key: str) -> DataFrame:
    """BED10 with composite feature keys; `genome_key` is the `sample#haplotype` part."""
    bed = typed_bed(read_bed(spark, path))
    key = k.feature_key(F.concat(F.lit(genome_key + "#"), F.col("contig")), F.col("start0"), F.col("end0"))
    return bed.withColumn("fid", key)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, EVENTS, allow_empty=True)


def typed_events(events: DataFrame) -> DataFrame:
    """Event columns as used by the overlap join."""
    c = F.col
    return events.select(
        c("asm_contig").alias("contig"), "sv_id", "sv_type",
        k.whole_number(c("asm_start0")).alias("sv_start"), k.whole_number(c("asm_end0")).alias("sv_end"),
        k.signed_length(c("sv_length"), c("sv_type")).alias("sv_len"), c("ref_contig").alias("chrom"),
        k.whole_number(c("ref_pos1")).alias("pos1"), k.whole_number(c("ref_end1")).alias("ref_end1"),
    )


def event_index(events: DataFrame) -> DataFrame:
    """Events in retrieval order with the running maximum end on each contig."""
    order = ["sv_start", "sv_end", "sv_id", "sv_type"]
    return ordered_scan(events, ["contig"], order, {"ordinal": ("count", None), "max_end": ("max", "sv_end")})


def read_psl(spark: SparkSession, path: str) -> DataFrame:
    c = F.col
    raw = read_headerless(spark, path, PSL)
    blocks = F.filter(F.split(F.regexp_replace("block_sizes", ",+$", ""), ","), lambda b: b != "")
    return raw.select(
        F.trim("fid").alias("fid"),
        *[c(n).cast("long") for n in ("matches", "mismatches", "rep_matches")],
        "strand",
        k.key_length(F.trim("fid")).alias("fid_len"),
        c("t_name").alias("chrom"), c("t_start").cast("long").alias("start0"), c("t_end").cast("long").alias("end0"),
        c("block_count").cast("long").alias("block_n"), blocks.cast("array<bigint>").alias("block_sizes"),
    )


def read_known_psl(spark: SparkSession, path: str, features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alignments and their number per feature; an id that is no feature is an error."""
    psl = read_psl(spark, path)
    unknown = [r.fid for r in unknown_psl_ids(psl, features).orderBy("fid").limit(5).collect()]
    if unknown:
        raise ValueError(f"{path}: unknown feature ids {unknown}")
    counts = features.select("fid").join(psl.groupBy("fid").agg(F.count(F.lit(1)).alias("hit_n")), "fid", "left").na.fill(0, ["hit_n"])
    return psl, counts


def unknown_psl_ids(psl: DataFrame, features: DataFrame) -> DataFrame:
    return psl.select("fid").distinct().join(features.select("fid"), "fid", "left_anti")


def read_fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """FASTA as chunks: name, chunk order, start0 and end0 of the chunk in its sequence, upper-case bases.

    Sequences are never joined into one value, so a chromosome stays many rows.
    """
    lines = numbered_lines(spark, path).filter(F.trim("line") != "")
    head = F.when(F.startswith("line", F.lit(">")), F.struct("line_no", F.substring("line", 2, 2**31 - 1).alias("name")))
    named = ordered_scan(lines.withColumn("__h", head), [], ["line_no"], {"__name": ("max", "__h")})
    body = named.filter(F.col("__h").isNull()).select(
        F.coalesce(F.col("__name.name"), F.raise_error(F.lit("sequence before header"))).alias("name"),
        "line_no", F.upper(F.trim("line")).alias("bases"), F.length(F.trim("line")).cast("long").alias("n"),
    )
    placed = ordered_scan(body, ["name"], ["line_no"], {"end0": ("sum", "n")})
    return placed.select("name", "line_no", (F.col("end0") - F.col("n")).alias("start0"), "end0", "bases")


def read_single_fasta(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of a file that must hold one record."""
    chunks = read_fasta_lines(spark, path)
    names = [r.name for r in chunks.select("name").distinct().limit(2).collect()]
    headers = numbered_lines(spark, path, number=False).filter(F.startswith("line", F.lit(">"))).limit(2).count()
    if len(names) != 1 or headers != 1:
        raise ValueError(f"{path}: expected exactly one record with bases")
    return chunks


def read_fasta(spark: SparkSession, path: str, full_header: bool = False) -> DataFrame:
    """One row per record (short records: features and alleles), named by the first header word or the full header."""
    chunks = read_fasta_lines(spark, path)
    name = F.col("name") if full_header else F.get(F.split("name", r"\s+"), F.lit(0))
    grouped = chunks.groupBy(name.alias("name")).agg(F.array_sort(F.collect_list(F.struct("start0", "bases"))).alias("c"))
    return grouped.select("name", F.array_join(F.transform("c", lambda c: c["bases"]), "").alias("sequence"))


def extract_intervals(chunks: DataFrame, intervals: DataFrame) -> DataFrame:
    """Sequence of each interval (name, fid, lo, hi) from sequence chunks (name, start0, end0, bases)."""
    c = F.col
    intervals = materialize(intervals, "wanted")  # joined with the chunks and with what was found
    pairs = interval_join(intervals, chunks, ["name"], ("lo", "hi"), ("start0", "end0"))
    left = F.greatest(c("lo"), c("start0"))
    piece = F.substr(
        c("bases"), (left - c("start0") + 1).cast("int"), (F.least(c("hi"), c("end0")) - left).cast("int")
    )
    found = pairs.select("fid", "start0", piece.alias("piece")).groupBy("fid").agg(
        F.array_sort(F.collect_list(F.struct("start0", "piece"))).alias("p")
    )
    text = F.array_join(F.transform("p", lambda p: p["piece"]), "")
    return intervals.join(found, "fid", "left").select(
        "fid", "name", "lo", "hi", F.coalesce(text, F.lit("")).alias("sequence"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("observed_bp"),
    )


def incomplete_extractions(extracted: DataFrame) -> DataFrame:
    expected = F.col("hi") - F.col("lo")
    return extracted.filter(F.col("observed_bp") != expected).select(
        "fid",
        F.when(F.col("observed_bp") == 0, "missing_contig_or_interval").otherwise("sequence_length_mismatch").alias("reason"),
        expected.alias("expected_bp"),
        "observed_bp",
    )


def read_path_table(spark: SparkSession, path: str) -> DataFrame:
    """pathBED rows: contig, start0, end0, node text and reverse flag."""
    raw = read_headerless(spark, path, ["contig", "start0", "end0", "token"])
    return raw.select(
        "contig", F.col("start0").cast("long"), F.col("end0").cast("long"),
        F.substring("token", 2, 2**31 - 1).alias("node"),
        F.when(F.startswith("token", F.lit(">")), 0).when(F.startswith("token", F.lit("<")), 1)
        .otherwise(F.raise_error(F.lit("cannot parse path token"))).cast("long").alias("rev"),
    )


def genome_inventory(sequences: DataFrame, genomes: DataFrame) -> DataFrame:
    """Sequence count and total length per genome, keeping genomes without a sequence."""
    totals = sequences.groupBy("hal_genome").agg(
        F.count(F.lit(1)).alias("n_sequences"), F.sum("length_bp").alias("total_sequence_bp")
    )
    return genomes.join(totals, "hal_genome", "left").select(
        "hal_genome", F.coalesce("n_sequences", F.lit(0)).cast("long").alias("n_sequences"),
        F.coalesce("total_sequence_bp", F.lit(0)).cast("long").alias("total_sequence_bp"),
        F.when(F.col("n_sequences").isNull(), "no_sequences").otherwise("available").alias("sequence_status"),
    )


FEATURE_JSON = "fid string, label string, kind string, contig string, start0 long, end0 long, strand string, source_seq_len long, tokens array<string>"


def read_feature_json(spark: SparkSession, path: str, schema: str = FEATURE_JSON) -> DataFrame:
    """Features from JSON lines, plain or compressed; blank lines are no records, malformed ones are an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


# Fixed values of the input catalogue.
CATALOGUE_KINDS = ["reference_primary", "reference_comparison", "assembly"]
CATALOGUE_REQUIRED = ["label", "kind", "graph_sample", "graph_hap", "hal_genome", "bed", "cpgi_fa", "path_bed_dir"]


def catalogue_violations(catalogue: DataFrame) -> DataFrame:
    """label, problem of catalogue rows: empty required fields (events too for an assembly), unknown kind."""
    kind = F.col("kind")
    empty = [F.when(F.trim(c) == "", F.lit(c)) for c in CATALOGUE_REQUIRED]
    events = F.when((kind == "assembly") & (F.trim("sv_tsv") == ""), F.lit("sv_tsv"))
    missing = F.array_sort(F.array_compact(F.array(*empty, events)))
    problems = F.array_compact(
        F.array(
            F.when(F.size(missing) > 0, F.concat(F.lit("empty fields: "), F.array_join(missing, ","))),
            F.when((kind != "") & ~kind.isin(CATALOGUE_KINDS), F.concat(F.lit("unsupported kind: "), kind)),
        )
    )
    return catalogue.select("label", F.explode(problems).alias("problem"))


def read_catalogue(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The input catalogue; a row that breaks a rule is an error."""
    table = read_table(spark, path, columns)
    broken = catalogue_violations(table).orderBy("label", "problem").limit(5).collect()
    if broken:
        raise ValueError(f"{path}: " + ", ".join(f"{r.label or 'unlabelled'} ({r.problem})" for r in broken))
    return table
