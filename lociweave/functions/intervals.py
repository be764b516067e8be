"""Interval arithmetic, overlap classes and mechanism labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import _reject

# Relationship label per overlap class.
RELATIONSHIPS = {
    "inside_ins": "INS-internal",
    "partial_ins": "INS-junction",
    "contains_ins": "INS-spanning",
    "contains_del": "DEL-junction",
}


def overlap0(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Shared bases of two half-open ranges."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def overlap1(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Shared bases of two 1-based inclusive ranges."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start) + 1)


def gap1(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (
        F.when(a_end < b_start, b_start - a_end - 1).when(b_end < a_start, a_start - b_end - 1).otherwise(F.lit(0))
    )


def event_hit(start0: Column, end0: Column, sv_type: Column, sv_start: Column, sv_end: Column) -> Column:
    """An insertion hits on half-open overlap, a deletion junction only strictly inside."""
    return F.when(sv_type == "DEL", (start0 < sv_start) & (sv_start < end0)).otherwise(
        (sv_start < end0) & (start0 < sv_end)
    )


def overlap_class(start0: Column, end0: Column, sv_type: Column, sv_start: Column, sv_end: Column) -> Column:
    inside = (start0 >= sv_start) & (end0 <= sv_end)
    contains = (sv_start >= start0) & (sv_end <= end0)
    return (
        F.when(sv_type == "DEL", F.lit("contains_del"))
        .when(inside, F.lit("inside_ins"))
        .when(contains, F.lit("contains_ins"))
        .otherwise(F.lit("partial_ins"))
    )


def relationship(klass: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, label in RELATIONSHIPS.items():
        out = out.when(klass == name, F.lit(label))
    return out.otherwise(F.raise_error(F.lit("unsupported event relationship")))


def insertion_class(has_inside: Column, has_partial: Column, has_contains: Column) -> Column:
    return (
        F.when(has_inside, F.lit("inside_ins"))
        .when(has_partial, F.lit("partial_ins"))
        .when(has_contains, F.lit("contains_ins"))
        .otherwise(F.lit("outside_ins"))
    )


def mechanism_class(has_inside: Column, has_partial: Column, has_contains: Column, has_del: Column) -> Column:
    """One label per feature: internal before junction before spanning, joined with deletions when both occur."""
    any_ins = has_inside | has_partial | has_contains
    return (
        F.when(any_ins & has_del, F.lit("INS+DEL"))
        .when(has_inside, F.lit("INS-internal"))
        .when(has_partial, F.lit("INS-junction"))
        .when(has_contains, F.lit("INS-spanning"))
        .when(has_del, F.lit("DEL-junction"))
        .otherwise(F.lit("non-SV"))
    )


def mechanism(role: Column, event_n: Column, klass: Column) -> Column:
    """Struct of group, class and status; reference roles carry blanks and must have no events."""
    sample = F.struct(
        F.when(klass == "non-SV", F.lit("non-SV")).otherwise(F.lit("SV-related")).alias("mechanism_group"),
        klass.alias("mechanism_class"),
        F.lit("evaluated_supplied_ins_del").alias("mechanism_status"),
    )
    blank = F.struct(
        F.lit("").alias("mechanism_group"),
        F.lit("").alias("mechanism_class"),
        F.lit("not_applicable_reference_role").alias("mechanism_status"),
    )
    return F.when(role == "sample", sample).otherwise(
        _reject(event_n == 0, blank, "reference-role member has unexpected events")
    )


def node_coordinates(reverse: Column, row_start: Column, row_end: Column, lo: Column, hi: Column) -> Column:
    """Clipped path segment in the coordinates of its node."""
    return F.struct(
        F.when(reverse == 0, lo - row_start).otherwise(row_end - hi).alias("s"),
        F.when(reverse == 0, hi - row_start).otherwise(row_end - lo).alias("e"),
    )


def insertion_envelope(start0: Column, end0: Column, insertions: Column) -> Column:
    """Feature range widened by the insertions (array of structs s, e) that overlap it."""
    used = F.filter(insertions, lambda r: (r["e"] > start0) & (r["s"] < end0))
    return F.struct(
        F.coalesce(F.least(start0, F.array_min(F.transform(used, lambda r: r["s"]))), start0).alias("start0"),
        F.coalesce(F.greatest(end0, F.array_max(F.transform(used, lambda r: r["e"]))), end0).alias("end0"),
        F.size(used).cast("long").alias("n"),
    )
