"""Association of features with primary-reference intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import intervals as iv
from ..session import materialize
from .interval_join import interval_join
from .scan import top_per_key


def _half_open(df: DataFrame, start1: str, end1: str, lo: str, hi: str) -> DataFrame:
    return df.withColumn(lo, F.col(start1) - 1).withColumn(hi, F.col(end1))


def reference_overlaps(queries: DataFrame, references: DataFrame) -> DataFrame:
    """All references overlapping each query.

    queries: chrom, fid, start1, end1 (and more); references: chrom, ref_fid, ref_start1, ref_end1; all 1-based inclusive.
    """
    lhs = _half_open(queries, "start1", "end1", "__ql", "__qh")
    rhs = _half_open(references, "ref_start1", "ref_end1", "__rl", "__rh")
    return interval_join(lhs, rhs, ["chrom"], ("__ql", "__qh"), ("__rl", "__rh")).drop("__ql", "__qh", "__rl", "__rh")


def best_reference(queries: DataFrame, references: DataFrame) -> DataFrame:
    """Best and second reference per query: overlap, reciprocal overlap, size ratio, gap, reference length, id."""
    c = F.col
    pairs = reference_overlaps(queries.select("chrom", "fid", "start1", "end1"), references)
    q_len = F.greatest(F.lit(1), c("end1") - c("start1") + 1)
    r_len = F.greatest(F.lit(1), c("ref_end1") - c("ref_start1") + 1)
    scored = pairs.select(
        "fid",
        "ref_fid",
        iv.overlap1(c("start1"), c("end1"), c("ref_start1"), c("ref_end1")).cast("long").alias("overlap_bp"),
        (iv.overlap1(c("start1"), c("end1"), c("ref_start1"), c("ref_end1")) / F.least(q_len, r_len)).alias("ro"),
        (F.least(q_len, r_len) / F.greatest(q_len, r_len)).alias("size_ratio"),
        iv.gap1(c("start1"), c("end1"), c("ref_start1"), c("ref_end1")).alias("gap"),
        r_len.alias("ref_len"),
    )
    scored = materialize(scored, "candidates")  # ranked and counted
    order = [
        c("overlap_bp").desc(), c("ro").desc(), c("size_ratio").desc(), c("gap").asc(), c("ref_len").asc(),
        c("ref_fid").desc(),
    ]
    return _best_and_second(scored, order, ["ref_fid", "overlap_bp", "ro", "size_ratio"])


def _best_and_second(scored: DataFrame, order: list[Column], fields: list[str]) -> DataFrame:
    two = top_per_key(scored, ["fid"], order, 2)
    wide = two.groupBy("fid").agg(
        *[F.max(F.when(F.col("rank") == 1, F.col(n))).alias(f"best_{n}") for n in fields],
        *[F.max(F.when(F.col("rank") == 2, F.col(n))).alias(f"second_{n}") for n in fields],
    )
    counted = scored.groupBy("fid").agg(F.count(F.lit(1)).alias("candidate_n"))
    return wide.join(counted, "fid")


def best_reference_by_insertion(insertions: DataFrame, references: DataFrame) -> DataFrame:
    """Reference at an insertion site: the longest insertion with any reference, then the reference with most margin.

    insertions: fid, chrom, pos1, sv_id, sv_len, overlap_bp, span_bp (one row per feature and insertion).
    """
    c = F.col
    points = insertions.withColumn("start1", c("pos1")).withColumn("end1", c("pos1"))
    pairs = reference_overlaps(points, references)
    scored = pairs.withColumn("length", F.abs("sv_len")).withColumn(
        "margin", F.least(c("pos1") - c("ref_start1"), c("ref_end1") - c("pos1"))
    ).withColumn("ref_len", c("ref_end1") - c("ref_start1") + 1)
    scored = materialize(
        scored.select("fid", "length", "overlap_bp", "span_bp", "sv_id", "pos1", "margin", "ref_len", "ref_fid"), "candidates"
    )
    order = [
        c("length").desc(), c("overlap_bp").desc(), c("span_bp").desc(), c("sv_id").desc(),
        c("margin").desc(), c("ref_len").asc(), c("ref_fid").desc(),
    ]
    two = top_per_key(scored, ["fid"], order, 2)
    chosen = F.struct("sv_id", "pos1", "ref_fid")
    wide = two.groupBy("fid").agg(
        F.max(F.when(c("rank") == 1, chosen)).alias("a"), F.max(F.when(c("rank") == 2, chosen)).alias("b")
    )
    # Distinct first, so that the count and the list hold each reference once and combine before the shuffle.
    matched = scored.select("fid", "ref_fid").distinct().groupBy("fid").agg(
        F.count(F.lit(1)).alias("candidate_n"), F.sort_array(F.collect_list("ref_fid")).alias("matched_refs")
    )
    same = c("a.sv_id") == c("b.sv_id")
    return wide.join(matched, "fid").select(
        "fid",
        c("a.ref_fid").alias("best_ref_fid"),
        F.when(same & (c("a.pos1") == c("b.pos1")), c("b.ref_fid")).alias("second_ref_fid"),
        c("a.sv_id").alias("reference_ins_id"),
        c("a.pos1").alias("insert_site1"),
        "candidate_n",
        "matched_refs",
    )


def associate(features: DataFrame, by_insertion: DataFrame, by_hit: DataFrame, seeds: DataFrame) -> DataFrame:
    """Anchor per feature: itself on the primary reference, then insertion site, then projection, else novel.

    features: fid, kind; by_insertion and by_hit as above; seeds: fid, seed_locus_id.
    """
    c = F.col
    ins = by_insertion.select(
        "fid", c("best_ref_fid").alias("ins_ref"), c("second_ref_fid").alias("ins_second"),
        c("candidate_n").alias("ins_n"), "reference_ins_id", "matched_refs",
    )
    hit = by_hit.select(
        "fid", c("best_ref_fid").alias("hit_ref"), c("second_ref_fid").alias("hit_second"),
        c("candidate_n").alias("hit_refs"), c("best_overlap_bp").alias("hit_overlap"),
        c("best_ro").alias("hit_ro"), c("best_size_ratio").alias("hit_size"),
    )
    joined = features.join(ins, "fid", "left").join(hit, "fid", "left").join(seeds, "fid", "left")
    primary = c("kind") == "reference_primary"
    by_ins, by_proj = c("ins_ref").isNotNull(), c("hit_ref").isNotNull()
    ref = F.when(primary, c("fid")).when(by_ins, c("ins_ref")).when(by_proj, c("hit_ref"))
    rule = (
        F.when(primary, F.lit("self_primary_ref"))
        .when(by_ins & (c("ins_n") == 1), F.lit("sv_insert_ref_overlap"))
        .when(by_ins, F.lit("sv_insert_multi_ref_best"))
        .when(by_proj & (c("hit_refs") == 1), F.lit("hal_ref_overlap"))
        .when(by_proj, F.lit("hal_multi_ref_best"))
        .otherwise(F.lit("no_primary_ref_overlap"))
    )
    confidence = (
        F.when(primary, F.lit("self_ref"))
        .when(by_ins & (c("ins_n") == 1), F.lit("sv_insert_ref"))
        .when(by_ins, F.lit("sv_insert_ref_ambiguous"))
        .when(by_proj & (c("hit_refs") == 1), F.lit("hal_ref"))
        .when(by_proj, F.lit("hal_ref_ambiguous"))
        .otherwise(F.lit("nonref"))
    )
    seed = F.coalesce(c("seed_locus_id").cast("string"), c("fid"))
    return joined.select(
        *features.columns,
        "seed_locus_id",
        F.coalesce(F.concat(F.lit("REF::"), ref), F.concat(F.lit("NR::"), seed)).alias("anchor_key"),
        F.when(ref.isNotNull(), F.lit("primary_ref")).otherwise(F.lit("nonref")).alias("anchor_type"),
        F.coalesce(ref, F.lit("")).alias("anchor_ref_fid"),
        rule.alias("anchor_assign_rule"),
        confidence.alias("anchor_confidence"),
        F.when(primary, 1).when(by_ins, c("ins_n")).otherwise(F.coalesce("hit_refs", F.lit(0))).cast("long").alias(
            "ref_overlap_n"
        ),
        F.when(primary, F.lit(None).cast("string")).when(by_ins, c("ins_second")).otherwise(c("hit_second")).alias(
            "second_ref_fid"
        ),
        F.when(~primary & by_ins, c("reference_ins_id")).otherwise(F.lit("")).alias("reference_ins_id"),
        F.when(~primary & by_ins, c("matched_refs")).otherwise(F.array().cast("array<string>")).alias("matched_refs"),
    )
