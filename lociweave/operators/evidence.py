"""Evidence records: per locus and genome the decisions of all its source models, and why the cell is called as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons and callabilities of decisions and cells.
OBSERVED, NOT_EVALUATED = "observed_member", "not_evaluated_observed"
DOMINANT, COMPETING, UNSUPPORTED = "dominant_ordered_placement", "competing_placements", "no_supported_placement"
CERTIFIED, NONE_CERTIFIED = "at_least_one_certified_source", "no_certified_source"
CALLABLE, UNRESOLVED = "callable", "unresolved"


def accepted(best: Column, runner: Column, placements: Column, margin: float) -> Column:
    """Whether a source's best placement leads far enough."""
    lead = F.coalesce(F.try_divide(best - runner, best), F.lit(0.0))
    return (placements > 0) & (best > 0) & (best > runner) & (lead >= margin)


def reason_of(taken: Column, placements: Column) -> Column:
    return F.when(taken, DOMINANT).when(placements > 0, COMPETING).otherwise(UNSUPPORTED)


def evidence_records(cells: DataFrame, decisions: DataFrame, margin: float) -> DataFrame:
    """locus_id, genome, genotype, evidence.

    cells: locus_id, genome, observed.  decisions: locus_id, genome, source (any orderable value), best_score, runner_score,
    placements, placement (a struct, null without placements).  A cell holds as many decisions as its locus has sources;
    cells and decisions meet in one aggregation over (locus, genome), and nothing else is shuffled.
    """
    c = F.col
    taken = accepted(c("best_score"), c("runner_score"), c("placements"), margin)
    decision = F.struct(
        "source", F.when(taken, CALLABLE).otherwise(UNRESOLVED).alias("callability"), reason_of(taken, c("placements")).alias("reason"),
        "best_score", "runner_score", "placements", "placement",
    )
    rows = decisions.select("locus_id", "genome", decision.alias("decision"), F.lit(None).cast("boolean").alias("observed")).unionByName(
        cells.select("locus_id", "genome", "observed"), allowMissingColumns=True
    )
    grouped = rows.groupBy("locus_id", "genome").agg(
        F.bool_or("observed").alias("observed"), F.count("observed").alias("cell_n"), F.array_sort(F.collect_list("decision")).alias("decisions")
    ).filter("cell_n > 0")
    certified = F.transform(F.filter("decisions", lambda d: d["callability"] == CALLABLE), lambda d: d["source"])
    found = grouped.withColumn("certified", certified)
    yes = F.size("certified") > 0
    seen = c("observed")

    def unless_seen(value: Column) -> Column:
        return F.when(~seen, value)

    evidence = F.struct(
        F.when(seen, NOT_EVALUATED).when(yes, CALLABLE).otherwise(UNRESOLVED).alias("callability"),
        F.when(seen, OBSERVED).when(yes, CERTIFIED).otherwise(NONE_CERTIFIED).alias("reason"),
        unless_seen(F.size("decisions").cast("long")).alias("source_model_n"), unless_seen(F.size("certified").cast("long")).alias("certified_source_n"),
        unless_seen(c("certified")).alias("supporting_sources"), unless_seen(c("decisions")).alias("source_decisions"),
    )
    return found.select("locus_id", "genome", F.when(seen, "1").when(yes, "0").otherwise("NA").alias("genotype"), evidence.alias("evidence"))
