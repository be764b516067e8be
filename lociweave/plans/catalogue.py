"""The whole catalogue: from interval calls, walks, events, alignments and sequences to loci, alleles and genotypes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AlleleRules, CallRules, FeatureRules, HitRules, LocusRules
from ..functions import intervals as iv
from ..functions import keys as k
from ..functions import scalars as sc
from ..operators import alleles as al
from ..operators import genotype as gt
from ..operators import graph as g
from ..operators import hits as h
from ..operators import loci as lo
from ..operators import models as md
from ..operators import overlap as ov
from ..operators import reference as rf
from ..operators import similarity as sim
from ..operators import sites as st
from ..operators import stats as s
from ..operators.scan import global_rank
from ..session import materialize
from ..sources import genome as src


@dataclass(frozen=True)
class Inputs:
    """Input tables.  Names that hold `#` go through `keys.storage_id` first.

    genomes: genome, role; intervals: genome, contig, start0, end0, ordinal (input order) and the call metrics;
    walks: genome, contig, ordinal, start0, end0, node, rev; events: genome, contig and the event columns;
    hits: fid, identity, coverage, aligned_bp, block_n, span_bp, chrom, start0, end0, strand;
    chunks: name (`genome#0#contig`), start0, end0, bases.
    """

    genomes: DataFrame
    intervals: DataFrame
    walks: DataFrame
    events: DataFrame
    hits: DataFrame
    chunks: DataFrame


@dataclass(frozen=True)
class Rules:
    feature: FeatureRules = FeatureRules()
    hit: HitRules = HitRules()
    locus: LocusRules = LocusRules()
    allele: AlleleRules = AlleleRules()
    call: CallRules = CallRules()


def _kind(role: Column) -> Column:
    return (
        F.when(role == "primary_reference", "reference_primary").when(role == "comparison_reference", "reference_comparison")
        .otherwise("assembly")
    )


def walks_from_graph(lines: DataFrame, paths: DataFrame) -> DataFrame:
    """Walks of the assigned graph paths (gfa_path_id, genome, contig); one job per graph. A path that breaks a rule is an error."""
    segs = g.segments(lines)
    dense = g.segment_statistics(segs).first()["dense_numeric"]
    nodes = materialize(g.number_segments(segs, dense), "nodes")
    records = materialize(g.path_records(lines).join(paths.select("gfa_path_id"), "gfa_path_id", "left_semi"), "records")
    absent = paths.join(records, "gfa_path_id", "left_anti").select("gfa_path_id", F.lit("missing_path").alias("problem"))
    broken = g.path_violations(records, nodes, g.link_table(g.links(lines))).unionByName(absent).orderBy("gfa_path_id", "problem").limit(10).collect()
    if broken:
        raise ValueError("paths cannot be unfolded: " + ", ".join(f"{r.gfa_path_id} ({r.problem})" for r in broken))
    unfolded = g.unfold(g.record_steps(records), nodes, "path_id", ("line_no", "pos"))
    return unfolded.join(paths.withColumnRenamed("gfa_path_id", "path_id"), "path_id").drop("path_id")


def build_features(x: Inputs, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Accepted features, excluded ones with a reason, body steps and event pairs."""
    c = F.col
    place = F.concat_ws("#", "genome", F.lit("0"), "contig")
    named = x.intervals.join(x.genomes, "genome").withColumns(
        {"kind": _kind(c("role")), "place": place, "fid": k.feature_key(place, c("start0"), c("end0"))}
    )
    ranked = global_rank(named, ["ordinal"], "ord").withColumn(
        "member_id", F.concat(F.lit("M"), F.lpad(c("ord").cast("string"), 9, "0"))
    )
    members = materialize(ranked, "members")
    spans = members.select(c("place").alias("contig"), "fid", c("start0").alias("lo"), c("end0").alias("hi"))
    walk = x.walks.select(F.concat_ws("#", "genome", F.lit("0"), "contig").alias("contig"), "ordinal", "start0", "end0", "node", "rev")
    steps = materialize(g.map_features(spans, walk, rules.feature.flank_bp), "steps")
    mapped = g.mapping_summary(spans, steps)

    located = members.filter("kind = 'assembly'").select(c("place").alias("contig"), "fid", "start0", "end0")
    events = x.events.withColumn("contig", F.concat_ws("#", "genome", F.lit("0"), "contig")).drop("genome")
    pairs = materialize(ov.event_pairs(located, events), "pairs")
    with_events = ov.with_event_summary(members, ov.summarize_pairs(pairs))

    hit_names = ["label", "hit_n", "chrom", "start0", "end0", "strand", "identity", "coverage"]
    placed = h.hits_for_features(members, h.resolve_hits(x.hits, rules.hit)).select("fid", *[c(n).alias(f"hit_{n}") for n in hit_names])
    full = with_events.join(mapped, "fid").join(placed, "fid").withColumn("adm", sc.admission(c("hit_label"), c("ins_n") > 0))
    primary = c("kind") == "reference_primary"
    reason = (
        F.when(c("graph_nsteps") == 0, F.lit("no_path_overlap"))
        .when(c("graph_cov") < rules.feature.min_graph_coverage, F.lit(f"graph_cov_lt_{rules.feature.min_graph_coverage}"))
        .when(~primary & ~c("adm.admit"), c("adm.reason")).otherwise(F.lit(""))
    )
    judged = materialize(full.withColumns({"reason": reason, "admit_rule": F.when(primary, "self_primary").otherwise(c("adm.rule"))}).drop("adm"), "judged")
    wanted = members.select("fid", c("place").alias("name"), c("start0").alias("lo"), c("end0").alias("hi"))
    seqs = src.extract_intervals(x.chunks, wanted)
    whole = F.when(c("observed_bp") == c("hi") - c("lo"), c("sequence")).otherwise(F.raise_error(F.lit("sequence of a feature is incomplete")))
    body = steps.filter("side = 'body'")
    token = F.concat(F.when(c("rev") == 1, "<").otherwise(">"), c("node").cast("string"))
    tokens = body.groupBy("fid").agg(F.array_sort(F.collect_list(F.struct("ordinal", token.alias("t")))).alias("a")).select(
        "fid", F.transform("a", lambda v: v["t"]).alias("tokens")
    )
    ready = judged.filter("reason = ''").join(seqs.select("fid", whole.alias("seq")), "fid").join(tokens, "fid")
    feats = ready.withColumns(
        {"label": c("genome"), "seq_len": F.length("seq").cast("long"), "bp": F.length("seq").cast("long"), "placed": c("hit_chrom").isNotNull()}
    )
    features = materialize(sim.with_anchors(feats, rules.locus), "features")
    return features, judged.filter("reason <> ''").select("fid", "genome", "kind", "reason"), body, pairs


def build_loci(features: DataFrame, body: DataFrame, pairs: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """Members with their final locus, and the loci with medoid and coordinates."""
    c = F.col
    shingles = materialize(sim.weighted_shingles(features), "weighted")
    nodes = materialize(g.merge_node_ranges(body.select("fid", "node", "s", "e"), ["fid", "node"]), "nodes")
    seeds = materialize(lo.cluster_loci(features, shingles, nodes, rules.locus), "seeds")
    groups = seeds.select(c("locus_id").alias("group_id"), "fid", c("ord").alias("member_ord"))
    medoid = sim.medoids(groups, features, shingles, nodes, rules.locus).select(c("group_id").alias("locus_id"), "medoid_fid")
    by_fid = global_rank(features.drop("ord"), ["fid"], "ord")
    polished = lo.polish_loci(seeds, materialize(medoid, "medoid"), by_fid, shingles, nodes, rules.locus)

    refs = features.filter("kind = 'reference_primary'").select(
        c("contig").alias("chrom"), c("fid").alias("ref_fid"), (c("start0") + 1).alias("ref_start1"), c("end0").alias("ref_end1")
    )
    kept = pairs.join(features.select("fid"), "fid", "left_semi")
    ins = kept.filter("sv_type = 'INS'").select("fid", "chrom", "pos1", "sv_id", "sv_len", "overlap_bp", "span_bp")
    usable = sc.hit_usable_for_reference(c("hit_label"), c("hit_chrom"), c("hit_start0"), c("hit_end0"))
    queries = features.filter(usable).select(c("hit_chrom").alias("chrom"), "fid", (c("hit_start0") + 1).alias("start1"), c("hit_end0").alias("end1"))
    anchored = materialize(
        rf.associate(
            features.select("fid", "kind", "ord"), rf.best_reference_by_insertion(ins, refs), rf.best_reference(queries, refs),
            polished.select("fid", c("locus_id").alias("seed_locus_id")),
        ),
        "anchored",
    )
    seed = st.site_seed(
        c("best_ins"), c("best_del"), c("hit_label"), c("hit_chrom"), c("hit_start0") + 1, c("hit_end0"), c("hit_coverage"), rules.hit.min_coverage
    )
    loose = features.join(anchored.filter("anchor_type = 'nonref'").select("fid"), "fid", "left_semi")
    at = loose.select("fid", "ord", seed.alias("s")).filter("s is not null")
    sites = at.select("fid", c("s.chrom").alias("chrom"), c("s.start1").alias("start1"), c("s.end1").alias("end1"), c("ord").alias("ordinal"), c("s.source").alias("source"))
    clustered = materialize(st.cluster_sites(sites, rules.locus.site_window_bp), "sites").select(
        "fid", c("anchor_key").alias("site_key"), c("chrom").alias("site_chrom"), c("low").alias("site_start1"), c("high").alias("site_end1"), "cluster_source"
    )
    keyed = materialize(anchored.join(clustered, "fid", "left").withColumn("anchor_key", F.coalesce("site_key", "anchor_key")), "keyed")
    placed = keyed.select("anchor_key", "anchor_ref_fid", "anchor_type", "site_chrom", "site_start1", "site_end1", "cluster_source").groupBy("anchor_key").agg(
        *[F.min(n).alias(n) for n in ("anchor_type", "anchor_ref_fid", "site_chrom", "site_start1", "site_end1", "cluster_source")]
    ).join(refs.withColumnRenamed("ref_fid", "anchor_ref_fid"), "anchor_ref_fid", "left")
    numbered = st.number_loci(
        placed.withColumns(
            {"chrom": F.coalesce("chrom", "site_chrom"), "start1": F.coalesce("ref_start1", "site_start1"), "end1": F.coalesce("ref_end1", "site_end1")}
        )
    )
    loci = materialize(numbered, "loci")
    members = materialize(keyed.join(loci.select("anchor_key", "locus_id"), "anchor_key").drop("ord", "kind"), "locus_members")
    pool = members.join(features.select("fid", "kind", "ord"), "fid").withColumn("asm", ~sc.is_reference_kind(c("kind")))
    has_asm = pool.groupBy("locus_id").agg(F.bool_or("asm").alias("any_asm"))
    chosen = pool.join(has_asm, "locus_id").filter(c("asm") | ~c("any_asm")).select(c("locus_id").alias("group_id"), "fid", c("ord").alias("member_ord"))
    medoids = sim.medoids(chosen, features, shingles, nodes, rules.locus).select(c("group_id").alias("locus_id"), "medoid_fid")
    return members, materialize(loci.join(medoids, "locus_id"), "loci_medoid")


def build_alleles(features: DataFrame, members: DataFrame, loci: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Members with their allele; sequences are turned to their locus medoid first."""
    c = F.col
    pairs = members.select("fid", "locus_id").join(loci.select("locus_id", "medoid_fid"), "locus_id")
    weights = materialize(sim.shingle_weights(sim.shingle_frequencies(features), features.count()), "weights")
    turned = sim.orientation(features.select("fid", "tokens", "shingles"), pairs.select("fid", "medoid_fid"), weights, rules.locus)
    joined = pairs.join(turned.select("fid", "orientation"), "fid").join(features.select("fid", "label", "kind", "placed", "seq"), "fid")
    seq = F.when(c("orientation") == -1, sc.reverse_complement(c("seq"))).otherwise(c("seq"))
    ready = joined.withColumns({"is_medoid": c("fid") == c("medoid_fid"), "seq": seq}).drop("medoid_fid", "orientation")
    return materialize(al.cluster_alleles(ready, rules.allele), "alleles")


def build_genotypes(x: Inputs, features: DataFrame, pairs: DataFrame, loci: DataFrame, alleles: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Long genotype tables of loci and alleles, and the decision per source and genome."""
    c = F.col
    reps = alleles.filter("is_rep").select("locus_id", "allele_id", c("fid").alias("rep_fid"))
    models = md.source_models(loci, reps)
    ins = pairs.filter("sv_type = 'INS'").groupBy("fid").agg(F.min("sv_start").alias("i0"), F.max("sv_end").alias("i1"))
    body = features.select(c("fid").alias("model"), "genome", "contig", "start0", "end0").join(ins.withColumnRenamed("fid", "model"), "model", "left")
    own = models.join(body, "model").select(
        "locus_id", "model", "genome", "contig", F.least(c("start0"), F.coalesce("i0", "start0")).alias("env_start0"),
        F.greatest(c("end0"), F.coalesce("i1", "end0")).alias("env_end0"), c("start0").alias("body_start0"), c("end0").alias("body_end0"),
    )
    primary = x.genomes.filter("role = 'primary_reference'").first()["genome"]
    context = models.filter("model_role = 'main_reference_context'").join(loci.select("locus_id", "site_chrom", "site_start1", "site_end1"), "locus_id").filter(
        c("site_chrom").isNotNull()
    ).select(
        "locus_id", "model", F.lit(primary).alias("genome"), c("site_chrom").alias("contig"), (c("site_start1") - 1).alias("env_start0"), c("site_end1").alias("env_end0"),
        (c("site_start1") - 1).alias("body_start0"), c("site_end1").alias("body_end0"),
    )
    placed = materialize(own.unionByName(context), "models")
    steps = materialize(md.model_context(placed, x.walks, rules.call.context_bp), "context")
    size = c("e") - c("s")
    lengths = steps.groupBy("locus_id", "model").agg(
        F.sum(F.when(c("side") == "left", size).otherwise(0)).alias("left_flank_len"), F.sum(F.when(c("side") == "right", size).otherwise(0)).alias("right_flank_len")
    )
    names = [r["genome"] for r in x.genomes.select("genome").collect()]
    observed = alleles.select("locus_id", "allele_id", c("label").alias("genome")).distinct()
    cells = placed.select("locus_id", "model", (c("env_end0") - c("env_start0")).alias("envelope_len")).join(lengths, ["locus_id", "model"]).withColumn(
        "genome", F.explode(F.array(*[F.lit(n) for n in names]))
    ).join(observed.select("locus_id", "genome").distinct(), ["locus_id", "genome"], "left_anti")
    targets = x.walks.select("genome", c("contig").alias("chrom"), "ordinal", "node", "rev", c("start0").alias("t_start"), c("end0").alias("t_end"))
    decisions = materialize(gt.evaluate(steps, targets, materialize(cells, "cells"), rules.call), "decisions")
    locus, allele = gt.genotypes(loci.select("locus_id"), reps, x.genomes.select("genome"), observed, gt.locus_calls(decisions))
    return locus, allele, decisions


def build_catalogue(x: Inputs, rules: Rules = Rules()) -> dict[str, DataFrame]:
    """All result tables."""
    c = F.col
    features, excluded, body, pairs = build_features(x, rules)
    members, loci = build_loci(features, body, pairs, rules)
    alleles = build_alleles(features, members, loci, rules)
    locus_gt, allele_gt, decisions = build_genotypes(x, features, pairs, loci, alleles, rules)
    locus_gt, allele_gt = materialize(locus_gt, "locus_gt"), materialize(allele_gt, "allele_gt")
    n_asm = x.genomes.filter("role = 'sample'").count()
    rep = features.select(
        c("fid").alias("allele_id"), k.public_allele_id(c("genome"), c("contig"), c("start0"), c("end0")).alias("public_id"), c("member_id").alias("representative_member_id"),
        "mechanism_class", c("role").alias("rep_role"), c("sv_n").alias("rep_sv_n"), "seq",
    )
    note = iv.mechanism(c("role"), c("sv_n"), c("mechanism_class"))
    catalogue = al.allele_catalogue(alleles, n_asm).join(rep, "allele_id").withColumn("m", iv.mechanism(c("rep_role"), c("rep_sv_n"), c("mechanism_class")))
    stats = s.call_statistics(allele_gt, x.genomes, "allele_id")
    allele_table = catalogue.select("*", "m.mechanism_group", c("m.mechanism_class").alias("rep_mechanism"), "m.mechanism_status").drop("m", "mechanism_class", "seq").withColumnRenamed(
        "rep_mechanism", "mechanism_class"
    ).join(stats, "allele_id")
    composition = s.mechanism_json(s.mechanism_composition(allele_table.select("locus_id", "mechanism_class")))
    member_table = (
        features.join(members.select("fid", "locus_id", "anchor_assign_rule", "reference_ins_id", "matched_refs"), "fid")
        .join(alleles.select("fid", "allele_id"), "fid").join(rep.select("allele_id", "public_id"), "allele_id").withColumn("m", note)
        .select(
            "member_id", "fid", "genome", "contig", "start0", "end0", "role", "locus_id", "public_id", c("seq_len").alias("length_bp"), "graph_cov", "graph_nsteps", "m.mechanism_group",
            "m.mechanism_class", "m.mechanism_status", c("hit_label").alias("mapping_status"), c("hit_chrom").alias("primary_sequence"), c("hit_start0").alias("primary_start0"),
            c("hit_end0").alias("primary_end0"), sc.relative_strand(F.coalesce("hit_strand", F.lit(""))).alias("primary_strand"), "anchor_assign_rule", "reference_ins_id", "matched_refs",
        )
    )
    return {
        "members": member_table,
        "member_sv": pairs.join(member_table.select("fid", "member_id", "locus_id", "public_id", "genome"), "fid").drop("start0", "end0"),
        "loci": loci.join(s.call_statistics(locus_gt, x.genomes, "locus_id"), "locus_id").join(composition, "locus_id"),
        "alleles": allele_table,
        "allele_sequences": catalogue.select(c("public_id").alias("name"), c("seq").alias("sequence")),
        "locus_genotypes": locus_gt,
        "allele_genotypes": allele_gt.join(rep.select("allele_id", "public_id"), "allele_id"),
        "decisions": decisions,
        "excluded": excluded,
    }
