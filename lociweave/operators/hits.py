"""Best-hit resolution of alignment hits with ambiguity labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HitRules
from .scan import ordered_scan, top_per_key


def hit_metrics(psl: DataFrame, length: str = "fid_len") -> DataFrame:
    """Identity, coverage and aligned bases from the columns of an alignment record."""
    c = F.col
    total = c("matches") + c("mismatches") + c("rep_matches")
    blocks = F.aggregate("block_sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    aligned = F.when(F.size("block_sizes") > 0, blocks).otherwise(F.greatest(F.lit(0), total))
    return psl.select(
        "fid",
        ((c("matches") + c("rep_matches")) / F.greatest(F.lit(1), total)).alias("identity"),
        (aligned / F.greatest(F.lit(1), c(length))).alias("coverage"),
        aligned.cast("long").alias("aligned_bp"),
        c("block_n"),
        F.greatest(F.lit(1), c("end0") - c("start0")).cast("long").alias("span_bp"),
        "chrom",
        "start0",
        "end0",
        "strand",
    )


def hit_order() -> list:
    """Best first: identity, coverage, aligned bases down; blocks and span up; chromosome down; positions up."""
    c = F.col
    return [
        c("identity").desc(), c("coverage").desc(), c("aligned_bp").desc(), c("block_n").asc(), c("span_bp").asc(),
        c("chrom").desc(), c("start0").asc(), c("end0").asc(),
    ]


def resolve_hits(hits: DataFrame, rules: HitRules = HitRules()) -> DataFrame:
    """One row per fid.  A near tie of the two best hits overrides every other label; unresolved hits lose their place."""
    fields = ["identity", "coverage", "aligned_bp", "block_n", "span_bp", "chrom", "start0", "end0", "strand"]
    best_two = top_per_key(hits, ["fid"], hit_order(), 2)
    pairs = best_two.groupBy("fid").agg(
        F.max(F.when(F.col("rank") == 1, F.struct(*fields))).alias("b"),
        F.max(F.when(F.col("rank") == 2, F.struct(*fields))).alias("s"),
    )
    counted = hits.groupBy("fid").agg(F.count(F.lit(1)).alias("hit_n"))
    b, s = (lambda n: F.col(f"b.{n}")), (lambda n: F.col(f"s.{n}"))
    near = (
        (F.abs(b("identity") - s("identity")) <= rules.tie_identity)
        & (F.abs(b("coverage") - s("coverage")) <= rules.tie_coverage)
        & (F.abs(b("aligned_bp") - s("aligned_bp")) <= rules.tie_aligned_bp)
    )
    low = (b("coverage") < rules.min_coverage) | (b("identity") < rules.min_identity)
    label = (
        F.when(F.col("s").isNotNull() & near, F.lit("ambiguous_tie"))
        .when(low, F.lit("low_quality"))
        .when(F.col("hit_n") == 1, F.lit("unique"))
        .otherwise(F.lit("multi_clear_primary"))
    )
    placed = F.col("label").isin("unique", "multi_clear_primary")
    return pairs.join(counted, "fid").withColumn("label", label).select(
        "fid",
        "label",
        "hit_n",
        F.when(placed, b("chrom")).alias("chrom"),
        F.when(placed, b("start0")).alias("start0"),
        F.when(placed, b("end0")).alias("end0"),
        F.when(placed, b("strand")).alias("strand"),
        b("identity").alias("identity"),
        b("coverage").alias("coverage"),
        b("aligned_bp").alias("aligned_bp"),
        b("span_bp").alias("span_bp"),
        b("block_n").alias("block_n"),
    )


def ranked_hits(hits: DataFrame) -> DataFrame:
    """Every hit with its rank inside its fid, in long form; a fid with very many hits is spread over slices."""
    keyed = (
        hits.withColumn("__i", -F.col("identity"))
        .withColumn("__c", -F.col("coverage"))
        .withColumn("__a", -F.col("aligned_bp"))
        .withColumn("__h", F.transform(F.split(F.coalesce("chrom", F.lit("")), ""), lambda ch: -F.ascii(ch)))
        .withColumn("__h", F.concat("__h", F.array(F.lit(1))))
    )
    order = ["__i", "__c", "__a", "block_n", "span_bp", "__h", "start0", "end0"]
    return ordered_scan(keyed, ["fid"], order, {"rank": ("count", None)}).drop("__i", "__c", "__a", "__h")


def self_projection(features: DataFrame) -> DataFrame:
    """Primary-reference features project onto themselves."""
    span = (F.col("end0") - F.col("start0")).cast("long")
    return features.select(
        "fid",
        F.lit("self_primary").alias("label"),
        F.lit(1).cast("long").alias("hit_n"),
        F.col("contig").alias("chrom"),
        "start0",
        "end0",
        F.lit("+").alias("strand"),
        F.lit(1.0).alias("identity"),
        F.lit(1.0).alias("coverage"),
        span.alias("aligned_bp"),
        span.alias("span_bp"),
        F.lit(1).cast("long").alias("block_n"),
    )


def hits_for_features(features: DataFrame, resolved: DataFrame) -> DataFrame:
    """Projection per feature: itself on the primary reference, else the resolved hit, else `no_hal`."""
    primary = features.filter(F.col("kind") == "reference_primary")
    other = features.filter(F.col("kind") != "reference_primary").select("fid")
    projected = other.join(resolved, "fid", "left").withColumns(
        {"label": F.coalesce("label", F.lit("no_hal")), "hit_n": F.coalesce("hit_n", F.lit(0)).cast("long")}
    )
    return self_projection(primary).unionByName(projected)


def projection_report(features: DataFrame, psl: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per-label totals, unmapped feature ids, and ids with several records."""
    counts = psl.groupBy("fid").agg(F.count(F.lit(1)).alias("record_n"))
    joined = features.select("label", "fid").join(counts, "fid", "left")
    n = F.coalesce("record_n", F.lit(0))
    summary = joined.groupBy("label").agg(
        F.count(F.lit(1)).alias("input_intervals"),
        F.sum(n).cast("long").alias("psl_records"),
        F.count_if(n > 0).alias("mapped_ids"),
        F.count_if(n == 0).alias("unmapped_ids"),
        F.count_if(n > 1).alias("multimap_ids"),
    )
    return summary, joined.filter(n == 0).select("label", "fid"), joined.filter(n > 1).select("label", "fid", "record_n")
