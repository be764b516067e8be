"""Member, locus, allele and genotype statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as k
from ..functions import scalars as sc
from .scan import ordered_scan, top_per_key


def member_order(members: DataFrame, group: str = "locus_id", order: Sequence[str] = ("ordinal",)) -> DataFrame:
    """Members with their position inside their group, in input order (long form of the member lists)."""
    return ordered_scan(members, [group], list(order), {"position": ("count", None)})


def member_counts(members: DataFrame, group: str = "locus_id", selected: DataFrame | None = None) -> DataFrame:
    kept = members if selected is None else members.join(selected.select(group), group, "left_semi")
    return kept.groupBy(group).agg(F.count(F.lit(1)).alias("member_n"))


def dominant_value(values: DataFrame, keys: Sequence[str], value: str, ordinal: str) -> DataFrame:
    """Most frequent non-blank value per key; on ties the one seen first."""
    counted = values.filter(F.col(value).isNotNull() & ~F.col(value).isin("", ".")).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"), F.min(ordinal).alias("first")
    )
    return counted.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("n"), -F.col("first"))).alias(value))


def exact_median(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median per key, rounded half to even; a key with very many values is ranked over slices, not in one task."""
    ranked = ordered_scan(values.select(*keys, value), list(keys), [value], {"__rn": ("count", None)})
    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    middle = ranked.join(sizes, list(keys)).filter(
        (F.col("__rn") == F.floor((F.col("__n") + 1) / 2)) | (F.col("__rn") == F.floor((F.col("__n") + 2) / 2))
    )
    return middle.groupBy(*keys).agg(F.bround(F.avg(value)).cast("long").alias(f"{value}_median"))


def placement_summary(members: DataFrame) -> DataFrame:
    """Dominant chromosome of the placed members of each locus and the medians of start, middle and end on it.

    members: locus_id, fid, ordinal, chrom (null or blank when unplaced), start1, end1.
    """
    placed = members.filter(F.length("chrom") > 0)
    main = dominant_value(placed, ["locus_id"], "chrom", "ordinal")
    kept = placed.join(main, ["locus_id", "chrom"]).withColumn("mid1", k.midpoint(F.col("start1"), F.col("end1")))
    out = kept.groupBy("locus_id", "chrom").agg(F.count(F.lit(1)).alias("n_annotated"))
    for name in ("start1", "mid1", "end1"):
        out = out.join(exact_median(kept, ["locus_id"], name), "locus_id")
    return out


def locus_description(members: DataFrame, medoids: DataFrame) -> DataFrame:
    """Counts, reference flags, site extent and medoid per locus.

    members: locus_id, fid, label, kind, placed, anchor_key, has_insert_anchor, site_start1, site_end1.
    Labels are reduced per (locus, label) first, so no distinct list is built in one place.
    """
    c = F.col
    ref = sc.is_reference_kind(c("kind"))
    per_label = members.groupBy("locus_id", "label").agg(
        F.count(F.lit(1)).alias("n"), F.max((~ref).cast("int")).alias("asm"), F.max(ref.cast("int")).alias("ref"),
        F.count_if(c("kind") == "reference_primary").alias("p"), F.count_if(c("kind") == "reference_comparison").alias("q"),
        F.max(c("placed").cast("int")).alias("placed"), F.count_if(c("has_insert_anchor")).alias("ins"),
        F.min("site_start1").alias("lo"), F.max("site_end1").alias("hi"), F.min("anchor_key").alias("anchor_key"),
    )
    out = per_label.groupBy("locus_id").agg(
        F.min("anchor_key").alias("anchor_key"), F.sum("n").alias("member_n"), F.count(F.lit(1)).alias("hap_n"),
        F.sum("asm").alias("asm_hap_n"), F.sum("ref").alias("ref_hap_n"), F.sum("p").alias("primary_ref_member_n"),
        F.sum("q").alias("comparison_ref_member_n"), F.max("placed").cast("long").alias("has_any_primary_annot"),
        F.sum("ins").alias("insert_anchor_member_n"), F.min("lo").alias("site_start1"), F.max("hi").alias("site_end1"),
    )
    is_ref = F.startswith("anchor_key", F.lit("REF::"))
    return out.join(medoids, "locus_id", "left").withColumns(
        {
            "anchor_type": F.when(is_ref, "primary_ref").otherwise("nonref"),
            "anchor_ref_fid": F.when(is_ref, F.substring("anchor_key", 6, 2**31 - 1)).otherwise(""),
            "nonref_only_locus": F.when(is_ref, 0).otherwise(1).cast("long"),
            "site_cluster": F.startswith("anchor_key", F.lit("NRSITE::")).cast("long"),
        }
    )


def call_statistics(matrix: DataFrame, roles: DataFrame, key: str) -> DataFrame:
    """Frequencies over sample genomes from a long matrix (key, genome, gt) and roles (genome, role)."""
    samples = roles.filter("role = 'sample'").select("genome")
    n_samples = samples.count()
    counted = matrix.join(roles, "genome").groupBy(key).agg(
        F.count_if((F.col("role") == "sample") & (F.col("gt") == "1")).alias("ac"),
        F.count_if((F.col("role") == "sample") & (F.col("gt") != "NA")).alias("n_called"),
    )
    af = F.try_divide(F.col("ac"), F.col("n_called"))
    return counted.select(
        key, F.lit(n_samples).cast("long").alias("sample_haplotype_n"), "ac", "n_called",
        (F.lit(n_samples) - F.col("n_called")).cast("long").alias("n_missing"),
        (F.col("n_called") / F.lit(n_samples)).alias("call_rate"), af.alias("af"), F.least(af, 1 - af).alias("maf"),
        (F.col("ac") > 0).cast("long").alias("in_sample_set"),
    )


def call_counts(matrix: DataFrame, roles: DataFrame, key: str) -> DataFrame:
    """Counts of 1, 0, NA and callable cells among assemblies and among all genomes."""
    joined = matrix.join(roles, "genome")
    aggs: list[Column] = []
    for scope, inside in (("asm", F.col("role") == "sample"), ("total", F.lit(True))):
        aggs.append(F.count_if(inside & (F.col("gt") != "NA")).alias(f"callable_{scope}_n"))
        for value in ("1", "0", "NA"):
            aggs.append(F.count_if(inside & (F.col("gt") == value)).alias(f"gt_{value.lower()}_{scope}_n"))
    return joined.groupBy(key).agg(*aggs)


def matrix_problems(matrix: DataFrame, ids: DataFrame, genomes: DataFrame, key: str) -> DataFrame:
    """Ids without exactly one valid cell per genome, and ids that are not in the catalogue."""
    n = genomes.count()
    per_id = matrix.groupBy(key).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(~F.col("gt").isin("0", "1", "NA")).alias("bad"),
        F.countDistinct("genome").alias("genomes"),
    )
    joined = ids.select(key, F.lit(1).alias("known")).join(per_id, key, "full")
    problem = (
        F.when(F.col("known").isNull(), "unknown_id").when(F.col("cells").isNull(), "missing_id")
        .when(F.col("bad") > 0, "invalid_cell")
        .when((F.col("cells") != n) | (F.col("genomes") != n), "wrong_genome_set")
    )
    return joined.select(key, problem.alias("problem")).filter("problem is not null")


def genotype_matrix(matrix: DataFrame, key: str, genomes: Sequence[str]) -> DataFrame:
    """Wide matrix for the sink: one column per genome in the given order."""
    return matrix.groupBy(key).pivot("genome", list(genomes)).agg(F.first("gt"))


def mechanism_composition(alleles: DataFrame) -> DataFrame:
    """Alleles per locus and mechanism in long form; reference-role alleles have their own label."""
    label = F.when(F.col("mechanism_class") == "", "not_applicable_reference_role").otherwise(F.col("mechanism_class"))
    return alleles.groupBy("locus_id", label.alias("mechanism_class")).agg(F.count(F.lit(1)).alias("allele_n"))


def mechanism_json(composition: DataFrame) -> DataFrame:
    """Composition as one JSON object per locus; there are at most seven labels."""
    entry = F.struct("mechanism_class", "allele_n")
    sorted_map = F.map_from_entries(F.array_sort(F.collect_list(entry)))
    return composition.groupBy("locus_id").agg(F.to_json(sorted_map).alias("allele_mechanism_counts"))


def reason_counts(evidence: DataFrame, keys: Sequence[str] = ("genotype", "reason")) -> DataFrame:
    return evidence.groupBy(*keys).agg(F.count(F.lit(1)).alias("cells"))


def select_loci(loci: DataFrame, start: int | None = None, end: int | None = None, shard_count: int = 0,
                shard_index: int = 0, mode: str = "contiguous", explicit: DataFrame | None = None) -> DataFrame:
    """Slice and shard of the ordered locus ids; adds `index` within the selection and, for shards, the shard rule."""
    kept = loci.select("locus_id").distinct()
    if explicit is not None:
        kept = kept.join(explicit.select("locus_id"), "locus_id", "left_semi")
    number, value, text = sc.locus_id_order(F.col("locus_id"))
    keyed = kept.withColumns({"__g": number, "__v": F.coalesce(value, F.lit(0))})
    ranked = ordered_scan(keyed, [], ["__g", "__v", "locus_id"], {"__rn": ("count", None)}).withColumn(
        "index", F.col("__rn") - 1
    ).select("locus_id", "index")
    if start is not None or end is not None:
        lo = start or 0
        ranked = ranked.filter(F.col("index") >= lo)
        if end is not None:
            ranked = ranked.filter(F.col("index") < end)
        ranked = ranked.withColumn("index", F.col("index") - lo)
    if shard_count <= 0:
        return ranked
    if mode == "modulo":
        return ranked.filter(F.col("index") % shard_count == shard_index)
    n = ranked.count()
    lo, hi = n * shard_index // shard_count, n * (shard_index + 1) // shard_count
    return ranked.filter((F.col("index") >= lo) & (F.col("index") < hi))


def shard_of(index: Column, n: Column, shard_count: int) -> Column:
    """Contiguous shard that holds a position: the shards are [n*i/k, n*(i+1)/k) in whole numbers."""
    return F.floor(((index + 1) * shard_count - 1) / n).cast("long")


def merge_shards(shards: Sequence[DataFrame], order: DataFrame) -> DataFrame:
    """Union of shard tables in catalogue order (locus_id, rank); an unknown locus or a locus in two shards is an error."""
    parts = None
    for i, shard in enumerate(shards):
        part = shard.withColumn("__shard", F.lit(i))
        parts = part if parts is None else parts.unionByName(part)
    owners = parts.groupBy("locus_id").agg(F.min("__shard").alias("a"), F.max("__shard").alias("b")).join(order, "locus_id", "left")
    checked = owners.withColumn(
        "rank",
        F.when(F.col("rank").isNull(), F.raise_error(F.lit("locus is not in the catalogue")).cast("long"))
        .when(F.col("a") != F.col("b"), F.raise_error(F.lit("locus occurs in several shards")).cast("long"))
        .otherwise(F.col("rank")),
    ).select("locus_id", "rank")
    return parts.join(checked, "locus_id").drop("__shard")


def medoid_of_locus(loci: DataFrame) -> DataFrame:
    def filled(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    return loci.filter("locus_id <> ''").select(
        "locus_id", F.coalesce(filled("medoid_fid"), filled("lead_fid"), filled("display_fid")).alias("medoid_fid")
    )


def first_order(values: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Distinct values with the place of their first occurrence."""
    return values.filter(F.length(key) > 0).groupBy(key).agg(F.min(ordinal).alias("first"))


def label_kinds(catalogue: DataFrame, features: DataFrame) -> DataFrame:
    """Kind of each label, from the catalogue first, else from the features; the earliest entry counts."""
    def first_kind(df: DataFrame, source: int) -> DataFrame:
        return df.filter((F.length("label") > 0) & (F.length("kind") > 0)).groupBy("label").agg(
            F.min_by("kind", "ordinal").alias("kind")
        ).withColumn("source", F.lit(source))

    both = first_kind(catalogue, 0).unionByName(first_kind(features, 1))
    return both.groupBy("label").agg(F.min_by("kind", "source").alias("kind"))


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(rows, keys, list(order), 1).drop("rank")


def bounded_groups(members: DataFrame, key: str, limit: int) -> DataFrame:
    """Group sizes; a group above the limit is an error, never a shorter group."""
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn(
        "n", F.when(F.col("n") <= limit, F.col("n")).otherwise(F.raise_error(F.lit("group exceeds its limit")).cast("long"))
    )


def merged_table(alleles: DataFrame, loci: DataFrame, allele_calls: DataFrame, locus_calls: DataFrame, matrix: DataFrame,
                 genomes: Sequence[str], total_assemblies: int) -> DataFrame:
    """Wide allele table: allele and locus counts, call counts of both levels and one genotype column per genome.

    alleles, loci: catalogue rows by allele_id and locus_id; *_calls: `call_counts`; matrix: long allele genotypes.
    """
    locus = loci.select("locus_id", *[F.col(c).alias(f"locus_{c}") for c in loci.columns if c != "locus_id"])
    per_allele = allele_calls.select("allele_id", *[F.col(c).alias(f"allele_{c}") for c in allele_calls.columns if c != "allele_id"])
    per_locus = locus_calls.select("locus_id", *[F.col(c).alias(f"locus_{c}") for c in locus_calls.columns if c != "locus_id"])
    wide = genotype_matrix(matrix, "allele_id", genomes)
    freq = F.try_divide(F.col("asm_hap_n"), F.lit(total_assemblies))
    return (
        alleles.withColumn("allele_freq", freq).join(locus, "locus_id").join(per_locus, "locus_id")
        .join(per_allele, "allele_id").join(wide, "allele_id")
    )
