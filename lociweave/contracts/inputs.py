"""Input contracts: genome roles, path assignments, interval calls and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as k
from ..operators.graph import ACCEPTED_STATUS
from . import rules as r


def _decimals(text: Column) -> Column:
    return F.when(F.contains(text, F.lit(".")), F.length(F.substring_index(text, ".", -1))).otherwise(0)


def bed_violations(bed: DataFrame, lengths: DataFrame) -> DataFrame:
    """Problems of BED10 text rows; lengths: contig, sequence_length."""
    c = F.col
    subject = F.concat_ws(":", "contig", F.concat_ws("-", "start0", "end0"))
    whole = ["start0", "end0", "length", "cpg_n", "gc_n"]
    bad_int = ~k.is_whole_number(c("start0"))
    for n in whole[1:]:
        bad_int = bad_int | ~k.is_whole_number(c(n))
    known = bed.join(lengths.select("contig", c("sequence_length").alias("__len")), "contig", "left")
    typed = known.select(
        "contig", "start0", "end0", "__len", bad_int.alias("bad_int"), c("pct_cpg").alias("t_cpg"), c("pct_gc").alias("t_gc"),
        *[c(n).try_cast("long").alias(m) for n, m in zip(whole, ("s", "e", "n", "cpg", "gc"), strict=True)],
        c("pct_cpg").try_cast("double").alias("p1"), c("pct_gc").try_cast("double").alias("p2"), c("oe").try_cast("double").alias("p3"),
    )
    span = (c("s") < c("e")) & (c("e") <= F.coalesce("__len", c("e"))) & (c("n") == c("e") - c("s"))
    counts = (2 * c("cpg") <= c("gc")) & (c("gc") <= c("n"))
    finite = F.lit(True)
    for n in ("p1", "p2", "p3"):
        finite = finite & F.coalesce((c(n) >= 0) & (c(n) < float("inf")), F.lit(False))
    finite = finite & (c("p1") <= 100) & (c("p2") <= 100)

    def off(value: Column, text: Column, target: Column) -> Column:
        slack = F.lit(0.5) * F.pow(F.lit(10.0), -_decimals(text)) + F.lit(1e-9)
        return F.abs(value - target) > slack

    wrong = off(c("p1"), c("t_cpg"), F.try_divide(200 * c("cpg"), c("n"))) | off(c("p2"), c("t_gc"), F.try_divide(100 * c("gc"), c("n")))
    good = ~c("bad_int")
    rows = r.row_checks(typed, subject, [
        (c("__len").isNull(), "unknown_sequence"),
        (c("bad_int"), "not_a_whole_number"),
        (good & ~span, "bad_span"),
        (good & ~counts, "bad_counts"),
        (good & ~finite, "bad_metric"),
        (good & span & counts & finite & wrong, "percentage_contradicts_counts"),
    ])
    return r.all_of([
        rows,
        r.duplicates(bed, ["contig", "start0", "end0"], "duplicate_interval"),
    ])


def event_violations(events: DataFrame, lengths: DataFrame, reference_lengths: DataFrame) -> DataFrame:
    """Problems of event rows; both length tables: contig, sequence_length."""
    c = F.col
    asm = lengths.select(c("contig").alias("asm_contig"), c("sequence_length").alias("__al"))
    ref = reference_lengths.select(c("contig").alias("ref_contig"), c("sequence_length").alias("__rl"))
    joined = events.join(asm, "asm_contig", "left").join(ref, "ref_contig", "left")
    numbers = ["ref_pos1", "ref_end1", "asm_start0", "asm_end0"]
    bad_int = ~k.is_whole_number(c(numbers[0]))
    for n in numbers[1:]:
        bad_int = bad_int | ~k.is_whole_number(c(n))
    p, e, s, t = (c(n).try_cast("long") for n in numbers)
    ins, dele = c("sv_type") == "INS", c("sv_type") == "DEL"
    known_type = ins | dele
    rows = r.row_checks(joined, c("sv_id"), [
        (c("sv_id") == "", "empty_id"),
        (~known_type, "unsupported_type"),
        (known_type & ~k.is_signed_length(c("sv_length"), c("sv_type")), "length_contradicts_type"),
        (c("__al").isNull() | c("__rl").isNull(), "undeclared_sequence"),
        (bad_int, "not_a_whole_number"),
        (~((p >= 1) & (p <= e) & (e <= c("__rl"))), "bad_reference_position"),
        (~((s <= t) & (t <= c("__al"))), "bad_assembly_interval"),
        (ins & ~((p == e) & (s < t)), "bad_insertion_geometry"),
        (dele & ~((p < e) & (s == t)), "bad_deletion_geometry"),
    ])
    return r.all_of([rows, r.duplicates(events, ["sv_id"], "duplicate_id")])


def role_violations(genomes: DataFrame) -> DataFrame:
    c = F.col
    totals = genomes.agg(
        F.count_if(c("role") == "primary_reference").alias("p"), F.count_if(c("role") == "comparison_reference").alias("q"),
        F.count_if(c("role") == "sample").alias("s"),
    )
    return r.all_of([
        r.where(totals, c("p") != 1, "needs_one_primary_reference", c("p")),
        r.where(totals, c("q") > 1, "too_many_comparison_references", c("q")),
        r.where(totals, c("s") == 0, "needs_a_sample", c("s")),
        r.where(genomes, ~c("role").isin(*r.ROLES), "unknown_role", c("hal_genome"), c("role")),
        r.where(genomes, (c("hal_genome") == "") | c("hal_genome").isin("locus_id", "allele_id"), "reserved_genome_name", c("hal_genome")),
        r.duplicates(genomes, ["hal_genome"], "duplicate_genome"),
    ])


def assignment_violations(genomes: DataFrame, paths: DataFrame, sequences: DataFrame, inventory: DataFrame,
                          exclusions: DataFrame) -> DataFrame:
    """Path assignments against the inventories.

    sequences: hal_genome, hal_sequence, length_bp; inventory as from `graph.inventory`; exclusions: genome, sequence.
    """
    c = F.col
    w_fields = ["gfa_sample", "gfa_haplotype", "gfa_sequence"]
    all_w = (c("gfa_sample") != "") & (c("gfa_haplotype") != "") & (c("gfa_sequence") != "")
    any_w = (c("gfa_sample") != "") | (c("gfa_haplotype") != "") | (c("gfa_sequence") != "")
    kind = c("gfa_record_type")
    good = ((kind == "W") & all_w & (c("gfa_path_name") == "")) | ((kind == "P") & ~any_w & (c("gfa_path_name") != ""))
    path_id = F.when(kind == "W", k.path_id(kind, [c(n) for n in w_fields])).otherwise(k.path_id(kind, [c("gfa_path_name")]))
    named = paths.withColumn("gfa_path_id", path_id)
    selected = sequences.join(genomes.select("hal_genome"), "hal_genome", "left_semi")
    subject = F.concat_ws("|", "hal_genome", "hal_sequence")
    joined = named.join(inventory, "gfa_path_id", "left").join(selected, ["hal_genome", "hal_sequence"], "left")
    covered = named.select("hal_genome", "hal_sequence").unionByName(exclusions.select("hal_genome", "hal_sequence"))
    wrong_span = (c("start0") != 0) | (F.coalesce("end0", "length_bp") != c("length_bp")) | (
        F.coalesce("path_length_bp", "length_bp") != c("length_bp")
    )
    keys = ["hal_genome", "hal_sequence"]
    return r.all_of([
        r.where(paths, ~good, "bad_path_fields", subject),
        r.where(joined, c("record_type").isNull(), "unknown_path", subject),
        r.where(joined, c("length_bp").isNull(), "unknown_sequence", subject),
        r.where(joined, ~c("overlap_status").isin(*ACCEPTED_STATUS), "unsupported_overlap", subject, c("overlap_status")),
        r.where(joined, wrong_span, "path_does_not_cover_sequence", subject),
        r.duplicates(named, ["gfa_path_id"], "path_assigned_twice"),
        r.duplicates(named, keys, "sequence_assigned_twice"),
        r.duplicates(exclusions, keys, "duplicate_exclusion"),
        r.violation(exclusions.join(selected, keys, "left_anti"), "unknown_exclusion", subject),
        r.violation(exclusions.join(named, keys, "left_semi"), "exclusion_is_assigned", subject),
        r.violation(selected.join(covered, keys, "left_anti"), "missing_assignment", subject),
        r.violation(genomes.join(named, "hal_genome", "left_anti"), "genome_without_path", c("hal_genome")),
    ])


def mapping_candidates(sequences: DataFrame, inventory: DataFrame) -> DataFrame:
    """Literal name matches between sequences and graph paths, with a status; a path name counts for a unique sequence."""
    c = F.col
    walks = inventory.filter("record_type = 'W'").select(
        c("w_sample_id").alias("hal_genome"), c("sequence_id").alias("hal_sequence"), "gfa_path_id"
    )
    unique = sequences.groupBy("hal_sequence").agg(F.count(F.lit(1)).alias("n"), F.min("hal_genome").alias("hal_genome")).filter("n = 1")
    named = inventory.filter("record_type = 'P'").select(c("raw_path_name").alias("hal_sequence"), "gfa_path_id").join(
        unique.select("hal_sequence", "hal_genome"), "hal_sequence"
    )
    found = walks.unionByName(named).groupBy("hal_genome", "hal_sequence").agg(
        F.count(F.lit(1)).alias("candidate_count"), F.min("gfa_path_id").alias("only")
    )
    joined = sequences.join(found, ["hal_genome", "hal_sequence"], "left")
    n = F.coalesce("candidate_count", F.lit(0))
    return joined.select(
        *sequences.columns, n.cast("long").alias("candidate_count"),
        F.when(n == 0, "no_exact_literal_match").when(n == 1, "exact_literal_candidate")
        .otherwise("multiple_exact_literal_matches").alias("candidate_status"),
        F.when(n == 1, c("only")).otherwise("").alias("candidate_gfa_path_id"),
    )


def confirmed_mapping_violations(contigs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Contig rows that are not confirmed, unknown to the inventory, unsupported or repeated."""
    c = F.col
    joined = contigs.join(inventory.select("gfa_path_id", "overlap_status"), "gfa_path_id", "left")
    subject = F.concat_ws("|", "genome_id", "contig_id")
    return r.all_of([
        r.where(contigs, c("mapping_status") != "confirmed", "not_confirmed", subject),
        r.where(joined, c("overlap_status").isNull(), "unknown_path", subject),
        r.where(joined, ~c("overlap_status").isin(*ACCEPTED_STATUS), "unsupported_overlap", subject),
        r.duplicates(contigs, ["gfa_path_id"], "path_mapped_twice"),
        r.duplicates(contigs, ["genome_id", "contig_id"], "contig_mapped_twice"),
    ])


def path_total_violations(totals: DataFrame, expected: DataFrame) -> DataFrame:
    """Unfolded paths against their expected lengths; both have path_id, the second length_bp."""
    joined = expected.join(totals, "path_id", "full")
    return r.all_of([
        r.where(joined, F.col("length_bp").isNull(), "unexpected_path", F.col("path_id")),
        r.where(joined, F.col("span_bp").isNull(), "missing_path", F.col("path_id")),
        r.where(joined, (F.col("span_bp") != F.col("length_bp")) | (F.col("end0") != F.col("length_bp")),
                "span_mismatch", F.col("path_id"), F.col("span_bp")),
    ])
