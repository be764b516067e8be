"""Evidence records re-derived from their own decisions, scores and the sources a locus must have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import evidence as ev
from . import rules as r


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")) & (value >= 0)


def evidence_violations(records: DataFrame, cells: DataFrame, sources: DataFrame, margin: float) -> DataFrame:
    """Everything in `records` that does not follow from what else they say.

    cells: locus_id, genome (all that must have a record); sources: locus_id, source (all that a locus must decide on).
    Row rules are one scan of the records and one of their decisions; the sets are compared by one aggregation.
    """
    c, e = F.col, F.col("evidence")
    subject = F.concat_ws("|", c("locus_id").cast("string"), c("genome").cast("string"))
    observed = c("genotype") == "1"
    decisions, supporting = e["source_decisions"], e["supporting_sources"]
    certified = F.transform(F.filter(decisions, lambda d: d["callability"] == ev.CALLABLE), lambda d: d["source"])
    yes = F.size(certified) > 0
    blank = decisions.isNull() & supporting.isNull() & e["source_model_n"].isNull() & e["certified_source_n"].isNull()
    observed_form = (e["callability"] == ev.NOT_EVALUATED) & (e["reason"] == ev.OBSERVED) & blank
    other = ~observed
    in_record = r.row_checks(records, subject, [
        (~F.coalesce(c("genotype").isin("0", "1", "NA"), F.lit(False)), "unknown_genotype", c("genotype")),
        (observed & ~F.coalesce(observed_form, F.lit(False)), "observed_record_has_evidence"),
        (other & (decisions.isNull() | supporting.isNull()), "missing_evidence"),
        (other & (F.coalesce(e["source_model_n"], F.lit(-1)) != F.size(decisions)), "source_count_mismatch", e["source_model_n"]),
        (other & (F.coalesce(e["certified_source_n"], F.lit(-1)) != F.size(certified)), "certified_count_mismatch", e["certified_source_n"]),
        (other & (F.size(F.array_distinct(F.transform(decisions, lambda d: d["source"]))) != F.size(decisions)), "duplicate_source"),
        (other & (supporting != certified), "supporting_sources_mismatch"),
        (other & (c("genotype") != F.when(yes, "0").otherwise("NA")), "genotype_mismatch", c("genotype")),
        (other & (e["callability"] != F.when(yes, ev.CALLABLE).otherwise(ev.UNRESOLVED)), "callability_mismatch", e["callability"]),
        (other & (e["reason"] != F.when(yes, ev.CERTIFIED).otherwise(ev.NONE_CERTIFIED)), "reason_mismatch", e["reason"]),
    ])
    each = records.filter(other).select("locus_id", "genome", F.explode(decisions).alias("d"))
    d = F.col("d")
    best, runner, n, place = d["best_score"], d["runner_score"], d["placements"], d["placement"]
    taken = ev.accepted(best, runner, n, margin)
    named = F.concat_ws("|", subject, d["source"].cast("string"))
    in_decision = r.row_checks(each, named, [
        (~_finite(best) | ~_finite(runner) | (runner > best) | n.isNull() | (n < 0), "bad_scores", best),
        (d["reason"] != ev.reason_of(taken, n), "decision_reason_mismatch", d["reason"]),
        (d["callability"] != F.when(taken, ev.CALLABLE).otherwise(ev.UNRESOLVED), "decision_contradicts_scores", d["callability"]),
        ((n == 0) & ((best != 0) | (runner != 0) | place.isNotNull()), "unsupported_decision_has_placement"),
        ((n > 0) & place.isNull(), "missing_placement"),
        (place.isNotNull() & (place["genome"] != c("genome")), "placement_in_other_genome", place["genome"]),
        (place.isNotNull() & (~place["direction"].isin(-1, 1) | (place["start0"] > place["end0"])), "bad_placement", place["start0"]),
    ])
    have = each.select("locus_id", "genome", d["source"].alias("source"), F.lit(1).alias("have"), F.lit(0).alias("want"))
    open_cells = records.filter(other).select("locus_id", "genome")
    want = open_cells.join(sources.select("locus_id", "source").distinct(), "locus_id").select("locus_id", "genome", "source", F.lit(0).alias("have"), F.lit(1).alias("want"))
    both = have.unionByName(want).groupBy("locus_id", "genome", "source").agg(F.max("have").alias("have"), F.max("want").alias("want"))
    sets = r.where(both, c("have") != c("want"), "source_set_mismatch", F.concat_ws("|", subject, c("source").cast("string")), F.when(c("have") == 1, "extra").otherwise("missing"))
    keys = ["locus_id", "genome"]
    return r.all_of([in_record, in_decision, sets, r.duplicates(records, keys, "duplicate_record"), r.set_difference(records, cells, keys, "cell_set_mismatch")])
