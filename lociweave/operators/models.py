"""Source models of each locus: which intervals speak for it, and their context on the source walk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .interval_join import interval_join
from .scan import ordered_scan


def source_models(loci: DataFrame, alleles: DataFrame) -> DataFrame:
    """Models per locus in rank order; the same interval counts once, in its first role.

    loci: locus_id, anchor_type, anchor_ref_fid; alleles: locus_id, allele_id, rep_fid.
    """
    c = F.col
    tag = c("locus_id").cast("string")
    anchor = loci.filter("anchor_type = 'primary_ref'").select(
        "locus_id", c("anchor_ref_fid").alias("model"), F.lit("primary_reference_anchor").alias("model_role"), F.lit(0).alias("o"), F.lit("").alias("a")
    )
    reps = alleles.select(
        "locus_id", c("rep_fid").alias("model"), F.lit("allele_representative").alias("model_role"), F.lit(1).alias("o"), c("allele_id").alias("a")
    )
    context = loci.filter("anchor_type <> 'primary_ref'").select(
        "locus_id", F.concat(F.lit("main_reference_context:"), tag).alias("model"), F.lit("main_reference_context").alias("model_role"),
        F.lit(2).alias("o"), F.lit("").alias("a"),
    )
    every = anchor.unionByName(reps).unionByName(context)
    first = every.groupBy("locus_id", "model").agg(F.min(F.struct("o", "a", "model_role")).alias("f")).select(
        "locus_id", "model", "f.model_role", "f.o", "f.a"
    )
    ranked = ordered_scan(first, ["locus_id"], ["o", "a", "model"], {"rank": ("count", None)})
    return ranked.select("locus_id", "model", "model_role", "rank")


def model_context(models: DataFrame, walks: DataFrame, context_bp: int) -> DataFrame:
    """Body and flank steps of each model on its own walk, clipped to the context.

    models: locus_id, model, genome, contig, env_start0, env_end0, body_start0, body_end0;
    walks: genome, contig, ordinal, start0, end0, node, rev.
    """
    c = F.col
    ends = walks.groupBy("genome", "contig").agg(F.max("end0").alias("walk_end"))
    placed = models.join(ends, ["genome", "contig"])
    inside = (c("env_start0") >= 0) & (c("env_start0") < c("env_end0")) & (c("env_end0") <= c("walk_end"))
    sides = F.array(
        F.struct(F.lit("body").alias("side"), c("body_start0").alias("lo"), c("body_end0").alias("hi")),
        F.struct(F.lit("left").alias("side"), F.greatest(F.lit(0), c("env_start0") - context_bp).alias("lo"), c("env_start0").alias("hi")),
        F.struct(F.lit("right").alias("side"), c("env_end0").alias("lo"), F.least(c("walk_end"), c("env_end0") + context_bp).alias("hi")),
    )
    checked = F.when(inside, sides).otherwise(F.raise_error(F.lit("source envelope is outside the path")))
    spans = placed.select("genome", "contig", "locus_id", "model", F.explode(checked).alias("p")).select(
        "genome", "contig", "locus_id", "model", "p.side", "p.lo", "p.hi"
    ).filter("lo < hi")
    pairs = interval_join(spans, walks, ["genome", "contig"], ("lo", "hi"), ("start0", "end0"))
    a, b = F.greatest("lo", "start0"), F.least("hi", "end0")
    pairs = materialize(pairs, "context")
    first = pairs.groupBy("locus_id", "model", "side").agg(F.min("ordinal").alias("__first"))
    return pairs.join(first, ["locus_id", "model", "side"]).select(
        "locus_id", "model", "side", (c("ordinal") - c("__first")).alias("idx"), "node", "rev",
        F.when(c("rev") == 0, a - c("start0")).otherwise(c("end0") - b).alias("s"),
        F.when(c("rev") == 0, b - c("start0")).otherwise(c("end0") - a).alias("e"),
    )
