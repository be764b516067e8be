"""Result contracts: genotype closure, frequencies, event geometry, decisions, accounting and record comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import intervals as iv
from . import rules as r


def closure_violations(loci: DataFrame, alleles: DataFrame) -> DataFrame:
    """Locus cells that do not follow from their alleles: 1 with a 1 and no NA, 0 with zeros only, NA with NA only."""
    c = F.col
    seen = alleles.groupBy("locus_id", "genome").agg(
        F.bool_or(c("gt") == "1").alias("one"), F.bool_or(c("gt") == "NA").alias("na"),
        F.every(c("gt") == "0").alias("zeros"), F.every(c("gt") == "NA").alias("all_na"),
    )
    joined = loci.join(seen, ["locus_id", "genome"], "left")
    good = ((c("gt") == "1") & c("one") & ~c("na")) | ((c("gt") == "0") & c("zeros")) | ((c("gt") == "NA") & c("all_na"))
    return r.where(joined, ~F.coalesce(good, F.lit(False)), "propagation_mismatch", F.concat_ws("|", c("locus_id").cast("string"), "genome"), c("gt"))


def frequency_violations(stated: DataFrame, counts: DataFrame, key: str, tolerance: float = 1e-9) -> DataFrame:
    """Stated frequencies against recomputed counts (ac, n_called, sample_haplotype_n)."""
    c = F.col
    joined = stated.join(counts.select(key, *[c(n).alias(f"__{n}") for n in ("ac", "n_called", "sample_haplotype_n")]), key)
    count_off = (c("ac") != c("__ac")) | (c("n_called") != c("__n_called")) | (c("sample_haplotype_n") != c("__sample_haplotype_n"))
    af = F.try_divide(c("__ac"), c("__n_called"))
    af_off = F.when(af.isNull(), c("af").isNotNull()).otherwise(c("af").isNull() | (F.abs(c("af") - af) > tolerance))
    rate_off = F.abs(c("call_rate") - c("__n_called") / c("__sample_haplotype_n")) > tolerance
    return r.all_of([
        r.where(joined, count_off, "count_mismatch", c(key)),
        r.where(joined, rate_off, "call_rate_mismatch", c(key)),
        r.where(joined, af_off, "frequency_mismatch", c(key)),
    ])


def event_geometry_violations(events: DataFrame) -> DataFrame:
    """Member events: an insertion shares bases with the member, a deletion junction lies strictly inside it."""
    c = F.col
    subject = F.concat_ws("|", "member_id", "sv_id")
    shared = iv.overlap0(c("start0"), c("end0"), c("asm_start0"), c("asm_end0"))
    inside = (c("start0") < c("asm_start0")) & (c("asm_start0") < c("end0")) & (c("asm_start0") == c("asm_end0"))
    return r.all_of([
        r.where(events, (c("sv_type") == "INS") & (shared <= 0), "bad_insertion_overlap", subject),
        r.where(events, (c("sv_type") == "DEL") & ~inside, "bad_deletion_junction", subject),
    ])


def decision_violations(decisions: DataFrame, margin: float) -> DataFrame:
    """Decisions that contradict their own scores, and scores that cannot be."""
    c = F.col
    subject = F.concat_ws("|", "locus_id", "genome", "model")
    lead = F.coalesce(F.try_divide(c("best_score") - c("runner_score"), c("best_score")), F.lit(0.0))
    accepted = (c("placements") > 0) & (c("best_score") > 0) & (c("best_score") > c("runner_score")) & (lead >= margin)
    return r.all_of([
        r.where(decisions, accepted != (c("call") == "0"), "decision_contradicts_scores", subject, c("placements")),
        r.where(decisions, (c("runner_score") > c("best_score")) | (c("best_score") < 0), "bad_scores", subject, c("placements")),
    ])


def source_set_violations(decisions: DataFrame, expected: DataFrame) -> DataFrame:
    """Sources that were evaluated but not expected for a cell, or the other way round."""
    return r.set_difference(decisions, expected, ["locus_id", "genome", "model"], "source_set")


def representative_violations(alleles: DataFrame, members: DataFrame) -> DataFrame:
    """Alleles whose representative is unknown, sits in another allele or differs in its copied properties."""
    c = F.col
    rep = members.select(
        c("member_id").alias("representative_member_id"), c("allele_id").alias("__allele"), c("length_bp").alias("__len"), c("mechanism_class").alias("__mech")
    )
    joined = alleles.join(rep, "representative_member_id", "left")
    return r.all_of([
        r.where(joined, c("__allele").isNull(), "unknown_representative", c("allele_id")),
        r.where(joined, c("__allele") != c("allele_id"), "representative_in_other_allele", c("allele_id")),
        r.where(joined, (c("__len") != c("length_bp")) | (c("__mech") != c("mechanism_class")), "representative_differs", c("allele_id")),
    ])


def changed_records(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Records of a stored table that are missing, extra or different by ordinal."""
    c = F.col
    joined = source.select("ordinal", c("record").alias("a"), F.lit(True).alias("in_a")).join(
        stored.select("ordinal", c("record").alias("b"), F.lit(True).alias("in_b")), "ordinal", "full"
    )
    problem = F.when(c("in_b").isNull(), "missing").when(c("in_a").isNull(), "extra").when(~c("a").eqNullSafe(c("b")), "changed")
    return joined.select("ordinal", problem.alias("problem")).filter("problem is not null")


def accounting(inputs: DataFrame, accepted: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Counts of input, accepted and excluded members, and whether they close: disjoint, complete, no repeats."""
    parts = [
        df.select(key, F.lit(int(i == 0)).alias("i"), F.lit(int(i == 1)).alias("a"), F.lit(int(i == 2)).alias("e"))
        for i, df in enumerate((inputs, accepted, excluded))
    ]
    per_key = r.all_of(parts).groupBy(key).agg(F.sum("i").alias("i"), F.sum("a").alias("a"), F.sum("e").alias("e"))
    return per_key.agg(
        F.sum("i").alias("input_n"), F.sum("a").alias("accepted_n"), F.sum("e").alias("excluded_n"),
        F.every((F.col("i") == 1) & (F.col("a") + F.col("e") == 1)).alias("closed"),
    )
