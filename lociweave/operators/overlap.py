"""Features against insertion and deletion events: pairs, per-feature summary, mechanism, folded text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import intervals as iv
from .interval_join import interval_join

EVENT_COLUMNS = ["sv_id", "sv_type", "sv_start", "sv_end", "sv_len", "chrom", "pos1", "ref_end1"]


def event_pairs(features: DataFrame, events: DataFrame, on: Sequence[str] = ("contig",)) -> DataFrame:
    """One row per feature and event that hits it.

    `features` has the `on` columns, fid, start0, end0; `events` has the `on` columns and EVENT_COLUMNS.  Events that
    repeat (id, type, start, end) count once.
    """
    on = list(on)
    f = F.col
    unique = events.dropDuplicates([*on, "sv_id", "sv_type", "sv_start", "sv_end"])
    hit = iv.event_hit(f("start0"), f("end0"), f("sv_type"), f("sv_start"), f("sv_end"))
    pairs = interval_join(features, unique, on, ("start0", "end0"), ("sv_start", "sv_end"), hit)
    overlap = iv.overlap0(f("start0"), f("end0"), f("sv_start"), f("sv_end"))
    span = f("sv_end") - f("sv_start")
    return (
        pairs.withColumn("class", iv.overlap_class(f("start0"), f("end0"), f("sv_type"), f("sv_start"), f("sv_end")))
        .withColumn("relationship", iv.relationship(f("class")))
        .withColumn("overlap_bp", overlap.cast("long"))
        .withColumn("span_bp", span.cast("long"))
        .withColumn("fraction_feature", overlap / F.greatest(F.lit(1), f("end0") - f("start0")))
        .withColumn("fraction_sv", F.when(span > 0, F.try_divide(overlap, span)))
    )


def _seen(klass: str) -> Column:
    return F.coalesce(F.bool_or(F.col("class") == klass), F.lit(False))


def summarize_pairs(pairs: DataFrame, keys: Sequence[str] = ("fid",)) -> DataFrame:
    """Counts, class flags and the chosen insertion and deletion per feature; combines before the shuffle."""
    c = F.col
    ins, dele = c("sv_type") == "INS", c("sv_type") == "DEL"
    length = F.abs("sv_len")
    site = F.struct("chrom", "pos1", "ref_end1", "sv_id")
    by_overlap = F.struct(c("overlap_bp"), length, c("sv_id"))
    by_length = F.struct(length, c("overlap_bp"), c("span_bp"), c("sv_id"))
    return pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sv_n"),
        F.count_if(ins).alias("ins_n"),
        _seen("inside_ins").alias("has_inside"),
        _seen("partial_ins").alias("has_partial"),
        _seen("contains_ins").alias("has_contains"),
        _seen("contains_del").alias("has_del"),
        F.max_by(F.when(ins, site), F.when(ins, by_overlap)).alias("best_ins"),
        F.max_by(F.when(dele, site), F.when(dele, by_overlap)).alias("best_del"),
        F.max_by(F.when(ins, F.struct("chrom", "pos1", "ref_end1", "sv_id", length.alias("length"))),
                 F.when(ins, by_length)).alias("longest_ins"),
    )


def with_event_summary(features: DataFrame, summary: DataFrame, keys: Sequence[str] = ("fid",)) -> DataFrame:
    """Features with their summary; features without an event get zero counts and the non-SV label."""
    joined = features.join(summary, list(keys), "left")
    flags = {n: F.coalesce(F.col(n), F.lit(False)) for n in ("has_inside", "has_partial", "has_contains", "has_del")}
    counts = {n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in ("sv_n", "ins_n")}
    joined = joined.withColumns({**flags, **counts})
    return joined.withColumn(
        "ins_class", iv.insertion_class(F.col("has_inside"), F.col("has_partial"), F.col("has_contains"))
    ).withColumn(
        "mechanism_class",
        iv.mechanism_class(F.col("has_inside"), F.col("has_partial"), F.col("has_contains"), F.col("has_del")),
    )


def fold_pairs(pairs: DataFrame, keys: Sequence[str] = ("fid",)) -> DataFrame:
    """Semicolon-joined detail columns per feature, best first.

    The text of one feature is one cell of an output file; `event_pairs` has the same rows in long form.
    """
    c = F.col
    keys = list(keys)
    detail = F.struct(
        (-c("overlap_bp")).alias("k1"),
        (-F.abs("sv_len")).alias("k2"),
        (-c("span_bp")).alias("k3"),
        c("sv_id"), c("sv_type"), c("class"), c("chrom"), c("pos1"), c("ref_end1"), c("sv_start"), c("sv_end"),
        c("overlap_bp"), c("fraction_feature"), c("fraction_sv"),
    )
    grouped = pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(detail)).alias("d"))

    def text(fn) -> Column:
        return F.array_join(F.transform("d", fn), ";")

    return grouped.select(
        *keys,
        F.size("d").cast("long").alias("sv_overlap_n"),
        text(lambda d: d["sv_id"]).alias("sv_overlap_ids"),
        text(lambda d: d["sv_type"]).alias("sv_overlap_types"),
        text(lambda d: d["class"]).alias("sv_overlap_classes"),
        text(lambda d: F.concat_ws(":", d["chrom"], d["pos1"].cast("string"))).alias("sv_overlap_primary_sites"),
        text(
            lambda d: F.concat(d["chrom"], F.lit(":"), d["pos1"].cast("string"), F.lit("-"), d["ref_end1"].cast("string"))
        ).alias("sv_overlap_primary_intervals"),
        text(lambda d: d["overlap_bp"].cast("string")).alias("sv_overlap_bp"),
        text(lambda d: F.format_string("%.6f", d["fraction_feature"])).alias("sv_overlap_pct_feature"),
        text(
            lambda d: F.when(d["fraction_sv"].isNull(), F.lit("NA")).otherwise(F.format_string("%.6f", d["fraction_sv"]))
        ).alias("sv_overlap_pct_sv"),
    )
