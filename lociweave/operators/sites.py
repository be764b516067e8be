"""One-dimensional site clusters and the global order of loci."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as sc
from .scan import global_rank, ordered_scan


def site_seed(
    best_ins: Column, best_del: Column, label: Column, chrom: Column, start1: Column, end1: Column, coverage: Column,
    least: float,
) -> Column:
    """Site of an unanchored feature: its insertion; with a deletion or alone, its projection if that is usable."""
    usable = sc.hit_usable_for_novel(label, chrom, start1, end1, coverage, least)

    def site(source: Column, c: Column, s: Column, e: Column) -> Column:
        return F.struct(source.alias("source"), c.alias("chrom"), s.alias("start1"), e.alias("end1"))

    return (
        F.when(
            best_ins.isNotNull(),
            site(
                F.when(usable, F.lit("sv+hal")).otherwise(F.lit("sv_only")),
                best_ins["chrom"], best_ins["pos1"], best_ins["ref_end1"],
            ),
        )
        .when(usable & best_del.isNotNull(), site(F.lit("sv+hal"), chrom, start1, end1))
        .when(usable, site(F.lit("hal_only"), chrom, start1, end1))
    )


def cluster_sites(sites: DataFrame, window_bp: int) -> DataFrame:
    """Single-linkage clusters of `chrom, start1, end1, ordinal, source`, numbered over (chrom, low, high, first row).

    A site joins while its start is at most the running end plus the window; a negative window links nothing.
    """
    order = ["start1", "end1", "ordinal"]
    if window_bp < 0:
        headed = sites.withColumn("__head", F.struct(*order))
    else:
        seen = ordered_scan(sites, ["chrom"], order, {"__end": ("max_before", "end1")}, keep_slices=True)
        fresh = F.col("__end").isNull() | (F.col("start1") > F.col("__end") + window_bp)
        marked = seen.withColumn("__start", F.when(fresh, F.struct(*order))).drop("__end")
        headed = ordered_scan(marked, ["chrom"], order, {"__head": ("max", "__start")}).drop("__start")
    key = ["chrom", "__head"]
    by_source = headed.groupBy(*key, "source").agg(
        F.count(F.lit(1)).alias("n"), F.min("start1").alias("low"), F.max("end1").alias("high"),
        F.min("ordinal").alias("first"),
    )
    clusters = by_source.groupBy(*key).agg(
        F.sum("n").alias("cluster_n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first").alias("first"),
        F.max_by("source", F.struct(F.col("n"), -F.col("first"))).alias("cluster_source"),
    )
    numbered = global_rank(clusters, ["chrom", "low", "high", "first"], "cluster_ord")
    return headed.join(numbered, key).select(
        *sites.columns, "cluster_ord", "cluster_n", "low", "high", "cluster_source",
        F.concat(F.lit("NRSITE::"), F.col("chrom"), F.lit("::"), F.col("cluster_ord").cast("string")).alias("anchor_key"),
        F.when(F.col("cluster_n") > 1, F.lit("nonref_projected_site_cluster"))
        .otherwise(F.lit("nonref_projected_site_single")).alias("anchor_assign_rule"),
    )


def number_loci(loci: DataFrame) -> DataFrame:
    """Sequential locus ids: reference loci by place, then site clusters, then seeds (numbers before text).

    loci: anchor_key and, for reference and site loci, chrom, start1, end1 (null otherwise).
    """
    c = F.col
    tail = F.substring_index("anchor_key", "::", -1)
    ref, site = F.startswith("anchor_key", F.lit("REF::")), F.startswith("anchor_key", F.lit("NRSITE::"))
    rest = F.regexp_replace("anchor_key", "^(REF|NR)::", "")
    digits = rest.rlike("^[0-9]+$")
    keyed = (
        loci.withColumn("__g", F.when(ref, 0).when(site, 1).otherwise(2))
        .withColumn("__c", F.when(ref | site, c("chrom")).otherwise(F.when(digits, F.lit("0")).otherwise(F.lit("1"))))
        .withColumn("__s", F.when(ref | site, c("start1")).otherwise(F.when(digits, rest.try_cast("long")).otherwise(0)))
        .withColumn("__e", F.when(ref | site, c("end1")).otherwise(F.lit(0)))
        .withColumn("__o", F.when(site, tail.try_cast("long")).otherwise(F.lit(0)))
        .withColumn("__t", F.when(site, F.lit("")).otherwise(rest))
    )
    order = ["__g", "__c", "__s", "__e", "__o", "__t", "anchor_key"]
    return global_rank(keyed, order, "locus_id").drop(*order[:-1])
