"""Member, locus, allele and genotype statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import alleles as al
from ..operators import models as m
from ..operators import stats as s
from ..session import materialize
from . import bridges as b
from .registry import query

CELLS = """
sn AS (SELECT l_partkey, s_nationkey, max(l_quantity > 25) AS big FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
cell AS (SELECT p_partkey AS locus_id, 'NATION_' || n_nationkey AS genome, CASE WHEN big THEN '1' WHEN NOT big THEN '0' ELSE 'NA' END AS gt,
                CASE n_nationkey WHEN 0 THEN 'primary_reference' WHEN 1 THEN 'comparison_reference' ELSE 'sample' END AS role
         FROM part CROSS JOIN nation LEFT JOIN sn ON l_partkey = p_partkey AND s_nationkey = n_nationkey)
"""
MEMBERS = """
ln AS (SELECT l_partkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, min(l_suppkey) AS l_suppkey, min(l_returnflag) AS flag, min(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3),
mem AS (SELECT l_partkey AS locus_id, l_partkey || ':' || l_orderkey || ':' || l_linenumber AS fid, 'NATION_' || s_nationkey AS label,
               CASE s_nationkey WHEN 0 THEN 'reference_primary' WHEN 1 THEN 'reference_comparison' ELSE 'assembly' END AS kind, l_partkey || '_' || flag AS allele_id,
               l_orderkey * 100 + l_linenumber AS ordinal, CAST(floor(qty) AS BIGINT) AS length, qty > 10 AS placed, 'chr' || l_suppkey % 3 AS chrom,
               l_orderkey * 10 + 1 AS start1, l_orderkey * 10 + CAST(floor(qty) AS BIGINT) AS end1
        FROM ln JOIN supplier ON l_suppkey = s_suppkey)
"""


@query("a13_call_statistics", f"""
WITH {CELLS},
c AS (SELECT locus_id, count(*) FILTER (gt = '1') AS ac, count(*) FILTER (gt <> 'NA') AS n, count(*) AS total FROM cell WHERE role = 'sample' GROUP BY 1)
SELECT locus_id, total AS sample_haplotype_n, ac, n AS n_called, total - n AS n_missing, n / total AS call_rate, CASE WHEN n > 0 THEN ac / n END AS af,
       CASE WHEN n > 0 THEN least(ac / n, 1 - ac / n) END AS maf, CAST(ac > 0 AS BIGINT) AS in_sample_set FROM c""")
def call_statistics(spark, d):
    return s.call_statistics(b.cells(spark, d), b.roles(spark, d), "locus_id")


@query("a25_call_counts", f"""
WITH {CELLS}
SELECT locus_id, count(*) FILTER (role = 'sample' AND gt <> 'NA') AS callable_asm_n, count(*) FILTER (role = 'sample' AND gt = '1') AS gt_1_asm_n,
       count(*) FILTER (role = 'sample' AND gt = '0') AS gt_0_asm_n, count(*) FILTER (role = 'sample' AND gt = 'NA') AS gt_na_asm_n,
       count(*) FILTER (gt <> 'NA') AS callable_total_n, count(*) FILTER (gt = '1') AS gt_1_total_n, count(*) FILTER (gt = '0') AS gt_0_total_n,
       count(*) FILTER (gt = 'NA') AS gt_na_total_n FROM cell GROUP BY 1""")
def call_counts(spark, d):
    return s.call_counts(b.cells(spark, d), b.roles(spark, d), "locus_id")


MATRIX_COLUMNS = ", ".join(f"max(CASE WHEN genome = 'NATION_{i}' THEN gt END) AS NATION_{i}" for i in range(25))


@query("a15_genotype_matrix", f"""
WITH {CELLS} SELECT locus_id, {MATRIX_COLUMNS} FROM cell GROUP BY locus_id""")
def genotype_matrix(spark, d):
    names = [r[0] for r in b.table(spark, d, "nation").select("n_name").orderBy("n_nationkey").collect()]
    return s.genotype_matrix(b.cells(spark, d), "locus_id", names)


@query("a25_matrix_problems", f"""
WITH {CELLS}, x AS (SELECT locus_id, count(*) AS n, count(*) FILTER (gt = '1') AS ones FROM cell WHERE NOT (gt = '0' AND genome = 'NATION_2') GROUP BY 1)
SELECT coalesce(x.locus_id, i.locus_id) AS locus_id, CASE WHEN i.locus_id IS NULL THEN 'unknown_id' WHEN x.locus_id IS NULL THEN 'missing_id' ELSE 'wrong_genome_set' END AS problem
FROM x FULL JOIN (SELECT p_partkey AS locus_id FROM part WHERE p_size > 3) i ON x.locus_id = i.locus_id
WHERE i.locus_id IS NULL OR x.locus_id IS NULL OR n <> (SELECT count(*) FROM nation)""")
def matrix_problems(spark, d):
    cells = b.cells(spark, d).filter("not (gt = '0' and genome = 'NATION_2')")
    ids = b.table(spark, d, "part").filter("p_size > 3").select(F.col("p_partkey").alias("locus_id"))
    return s.matrix_problems(cells, ids, b.table(spark, d, "nation"), "locus_id")


@query("p58_propagated_genotypes", f"""
WITH {CELLS},
a AS (SELECT DISTINCT l_partkey AS locus_id, l_partkey || '_' || l_returnflag AS allele_id FROM lineitem),
o AS (SELECT DISTINCT l_partkey AS locus_id, l_partkey || '_' || l_returnflag AS allele_id, 'NATION_' || s_nationkey AS genome FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 25)
SELECT allele_id, genome, CASE WHEN o.allele_id IS NOT NULL THEN '1' WHEN gt = 'NA' THEN 'NA' ELSE '0' END AS gt
FROM a JOIN cell USING (locus_id) LEFT JOIN o USING (locus_id, allele_id, genome)""")
def propagated_genotypes(spark, d):
    c = F.col
    li, sup = b.table(spark, d, "lineitem"), b.table(spark, d, "supplier")
    allele = F.concat_ws("_", c("l_partkey").cast("string"), c("l_returnflag"))
    alleles = li.select(c("l_partkey").alias("locus_id"), allele.alias("allele_id")).distinct()
    seen = li.filter("l_quantity > 25").join(sup, c("l_suppkey") == c("s_suppkey")).select(
        c("l_partkey").alias("locus_id"), allele.alias("allele_id"), F.concat(F.lit("NATION_"), c("s_nationkey").cast("string")).alias("genome"),
        F.lit(True).alias("seen"),
    ).distinct()
    joined = alleles.join(b.cells(spark, d), "locus_id").join(seen, ["locus_id", "allele_id", "genome"], "left")
    return joined.select("allele_id", "genome", sc.genotype_of_allele(F.coalesce("seen", F.lit(False)), c("gt")).alias("gt"))


@query("a08_member_positions", f"WITH {MEMBERS} SELECT locus_id, fid, row_number() OVER (PARTITION BY locus_id ORDER BY ordinal) AS position FROM mem")
def member_positions(spark, d):
    return s.member_order(b.locus_members(spark, d)).select("locus_id", "fid", "position")


@query("a10_member_counts", f"WITH {MEMBERS} SELECT locus_id, count(*) AS member_n FROM mem WHERE locus_id IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY') GROUP BY 1")
def member_counts(spark, d):
    chosen = b.table(spark, d, "part").filter("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("locus_id"))
    return s.member_counts(b.locus_members(spark, d), "locus_id", chosen)


@query("j22_selected_features", f"WITH {MEMBERS} SELECT fid, locus_id, length FROM mem WHERE locus_id IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2')")
def selected_features(spark, d):
    wanted = b.table(spark, d, "part").filter("p_brand = 'Brand#2'").select(F.col("p_partkey").alias("locus_id"))
    return b.locus_members(spark, d).join(wanted, "locus_id", "left_semi").select("fid", "locus_id", "length")


@query("a12_placement_summary", f"""
WITH {MEMBERS},
p AS (SELECT * FROM mem WHERE placed),
m AS (SELECT locus_id, arg_max(chrom, (n, -f)) AS chrom FROM (SELECT locus_id, chrom, count(*) AS n, min(ordinal) AS f FROM p GROUP BY 1, 2) GROUP BY 1),
q AS (SELECT p.*, CAST(round_even((start1 + end1) / 2.0, 0) AS BIGINT) AS mid1 FROM p JOIN m USING (locus_id, chrom))
SELECT locus_id, chrom, count(*) AS n_annotated, CAST(round_even(quantile_cont(start1, 0.5), 0) AS BIGINT) AS start1_median,
       CAST(round_even(quantile_cont(mid1, 0.5), 0) AS BIGINT) AS mid1_median, CAST(round_even(quantile_cont(end1, 0.5), 0) AS BIGINT) AS end1_median FROM q GROUP BY 1, 2""")
def placement_summary(spark, d):
    members = b.locus_members(spark, d)
    return s.placement_summary(members.withColumn("chrom", F.when(F.col("placed"), F.col("chrom"))))


@query("a11_locus_description", f"""
WITH {MEMBERS},
x AS (SELECT *, CASE WHEN locus_id % 3 = 0 THEN 'REF::r' || locus_id WHEN locus_id % 3 = 1 THEN 'NRSITE::chr1::' || locus_id ELSE 'NR::' || locus_id END AS anchor_key FROM mem)
SELECT locus_id, min(anchor_key) AS anchor_key, count(*) AS member_n, count(DISTINCT label) AS hap_n, count(DISTINCT label) FILTER (kind = 'assembly') AS asm_hap_n,
       count(DISTINCT label) FILTER (kind <> 'assembly') AS ref_hap_n, count(*) FILTER (kind = 'reference_primary') AS primary_ref_member_n,
       count(*) FILTER (kind = 'reference_comparison') AS comparison_ref_member_n, CAST(max(placed) AS BIGINT) AS has_any_primary_annot,
       count(*) FILTER (length > 40) AS insert_anchor_member_n, min(start1) AS site_start1, max(end1) AS site_end1, arg_max(fid, (length, fid)) AS medoid_fid,
       CASE WHEN locus_id % 3 = 0 THEN 'primary_ref' ELSE 'nonref' END AS anchor_type, CASE WHEN locus_id % 3 = 0 THEN 'r' || locus_id ELSE '' END AS anchor_ref_fid,
       CAST(locus_id % 3 <> 0 AS BIGINT) AS nonref_only_locus, CAST(locus_id % 3 = 1 AS BIGINT) AS site_cluster FROM x GROUP BY locus_id""")
def locus_description(spark, d):
    c = F.col
    members = b.locus_members(spark, d)
    tag = c("locus_id").cast("string")
    key = (
        F.when(c("locus_id") % 3 == 0, F.concat(F.lit("REF::r"), tag))
        .when(c("locus_id") % 3 == 1, F.concat(F.lit("NRSITE::chr1::"), tag)).otherwise(F.concat(F.lit("NR::"), tag))
    )
    medoids = members.groupBy("locus_id").agg(F.max_by("fid", F.struct("length", "fid")).alias("medoid_fid"))
    rows = members.withColumns(
        {"anchor_key": key, "has_insert_anchor": c("length") > 40, "site_start1": c("start1"), "site_end1": c("end1")}
    )
    return s.locus_description(rows, medoids)


ALLELES = f"""
{MEMBERS},
rep AS (SELECT locus_id, allele_id, max(length) AS rep_len FROM mem GROUP BY 1, 2),
ac AS (SELECT locus_id, allele_id, count(*) AS member_n, count(DISTINCT label) AS hap_n, count(DISTINCT label) FILTER (kind = 'assembly') AS asm_hap_n,
              count(DISTINCT label) FILTER (kind <> 'assembly') AS ref_hap_n, count(*) FILTER (kind = 'assembly') AS asm_member_n, count(*) FILTER (kind <> 'assembly') AS ref_member_n,
              CAST(bool_or(kind = 'reference_primary') AS BIGINT) AS has_primary_ref, CAST(bool_or(kind = 'reference_comparison') AS BIGINT) AS has_comparison_ref,
              max(length) AS rep_len FROM mem GROUP BY 1, 2),
mj AS (SELECT *, CAST(row_number() OVER (PARTITION BY locus_id ORDER BY asm_hap_n DESC, asm_member_n DESC, hap_n DESC, member_n DESC, rep_len DESC, allele_id DESC) = 1 AS BIGINT) AS major_allele FROM ac)
"""
FREQ_CLASS = """CASE WHEN asm_hap_n <= 0 THEN CASE WHEN ref_member_n > 0 THEN 'ref_only' ELSE 'absent' END WHEN asm_hap_n = 1 THEN 'singleton'
       WHEN asm_hap_n >= 23 THEN 'shared' WHEN major_allele = 1 THEN 'major' ELSE 'polymorphic' END"""


@query("a14_allele_catalogue", f"WITH {ALLELES} SELECT *, {FREQ_CLASS} AS freq_class FROM mj")
def allele_catalogue(spark, d):
    members = b.locus_members(spark, d)
    longest = members.groupBy("locus_id", "allele_id").agg(F.max_by("fid", F.struct("length", "fid")).alias("rep"))
    flagged = members.join(longest, ["locus_id", "allele_id"]).withColumn("is_rep", F.col("fid") == F.col("rep"))
    return al.allele_catalogue(flagged, 23)


@query("p37_frequency_classes", f"WITH {ALLELES} SELECT {FREQ_CLASS} AS freq_class, count(*) AS n FROM mj GROUP BY 1")
def frequency_classes(spark, d):
    return allele_catalogue(spark, d).groupBy("freq_class").agg(F.count(F.lit(1)).alias("n"))


@query("p50_dominant_priority", """
SELECT o_custkey, arg_max(o_orderpriority, (n, -f)) AS o_orderpriority FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2) GROUP BY 1""")
def dominant_priority(spark, d):
    return s.dominant_value(b.table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("p51_medians", """
SELECT l_suppkey, CAST(round_even(quantile_cont(l_orderkey, 0.5), 0) AS BIGINT) AS l_orderkey_median FROM lineitem GROUP BY 1""")
def medians(spark, d):
    return s.exact_median(b.table(spark, d, "lineitem"), ["l_suppkey"], "l_orderkey")


@query("a22_reason_counts", f"""
WITH {CELLS} SELECT gt AS genotype, CASE WHEN gt = '1' THEN 'observed_member' WHEN gt = '0' THEN 'at_least_one_certified_source' ELSE 'no_certified_source' END AS reason, count(*) AS cells FROM cell GROUP BY 1, 2""")
def reason_counts(spark, d):
    reason = F.when(F.col("gt") == "1", "observed_member").when(F.col("gt") == "0", "at_least_one_certified_source").otherwise("no_certified_source")
    return s.reason_counts(b.cells(spark, d).select(F.col("gt").alias("genotype"), reason.alias("reason")))


@query("a23_locus_composition", """
WITH a AS (SELECT p_brand AS locus_id, CASE p_type WHEN 'ECONOMY' THEN '' ELSE p_type END AS m FROM part),
c AS (SELECT locus_id, CASE WHEN m = '' THEN 'not_applicable_reference_role' ELSE m END AS m, count(*) AS n FROM a GROUP BY 1, 2)
SELECT locus_id, '{' || string_agg('"' || m || '":' || n, ',' ORDER BY m) || '}' AS allele_mechanism_counts FROM c GROUP BY 1""")
def locus_composition(spark, d):
    alleles = b.table(spark, d, "part").select(
        F.col("p_brand").alias("locus_id"), F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.col("p_type")).alias("mechanism_class")
    )
    return s.mechanism_json(s.mechanism_composition(alleles))


@query("p64_label_kinds", """
WITH c AS (SELECT o_clerk AS label, arg_min(kind, o_orderkey) AS kind FROM (SELECT o_orderkey, 'L' || o_custkey % 40 AS o_clerk, o_orderstatus AS kind FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1),
f AS (SELECT label, arg_min(kind, o_orderkey) AS kind FROM (SELECT o_orderkey, 'L' || o_custkey % 60 AS label, o_orderpriority AS kind FROM orders) GROUP BY 1)
SELECT coalesce(c.label, f.label) AS label, coalesce(c.kind, f.kind) AS kind FROM c FULL JOIN f ON c.label = f.label""")
def label_kinds(spark, d):
    orders = b.table(spark, d, "orders")
    catalogue = orders.filter("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("L"), b.text("o_custkey % 40")).alias("label"), F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").alias("ordinal")
    )
    feats = orders.select(
        F.concat(F.lit("L"), b.text("o_custkey % 60")).alias("label"), F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").alias("ordinal")
    )
    return s.label_kinds(catalogue, feats)


@query("s37_label_order", "SELECT l_returnflag || l_linestatus AS label, min(l_orderkey) AS first FROM lineitem GROUP BY 1")
def label_order(spark, d):
    rows = b.table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("label"), F.col("l_orderkey").alias("ordinal"))
    return s.first_order(rows, "label", "ordinal")


@query("s32_locus_medoids", """
SELECT CAST(p_partkey AS VARCHAR) AS locus_id, coalesce(CASE WHEN p_size % 3 = 0 THEN p_name END, CASE WHEN p_size % 3 = 1 THEN p_brand END, p_type) AS medoid_fid FROM part""")
def locus_medoids(spark, d):
    c = F.col
    loci = b.table(spark, d, "part").select(
        c("p_partkey").cast("string").alias("locus_id"), F.when(c("p_size") % 3 == 0, c("p_name")).otherwise("").alias("medoid_fid"),
        F.when(c("p_size") % 3 == 1, c("p_brand")).otherwise("").alias("lead_fid"), c("p_type").alias("display_fid"),
    )
    return s.medoid_of_locus(loci)


LOCI = "lo AS (SELECT DISTINCT CASE WHEN o_custkey % 4 = 0 THEN 'X' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS locus_id FROM orders)"
RANKED = f"{LOCI}, rk AS (SELECT locus_id, row_number() OVER (ORDER BY regexp_full_match(locus_id, '[0-9]+') DESC, TRY_CAST(locus_id AS BIGINT), locus_id) - 1 AS index FROM lo)"


def _loci(spark, d):
    c = F.col
    key = F.when(c("o_custkey") % 4 == 0, F.concat(F.lit("X"), c("o_custkey").cast("string"))).otherwise(c("o_custkey").cast("string"))
    return b.table(spark, d, "orders").select(key.alias("locus_id"))


@query("t04_locus_order", f"WITH {RANKED} SELECT * FROM rk")
def locus_order(spark, d):
    return s.select_loci(_loci(spark, d))


@query("t05_contiguous_shards", f"""
WITH {RANKED}, n AS (SELECT count(*) AS n FROM rk)
SELECT locus_id, index, CASE WHEN index >= n * 1 // 3 AND index < n * 2 // 3 THEN TRUE ELSE FALSE END AS in_second FROM rk, n WHERE index >= n * 1 // 3 AND index < n * 2 // 3""")
def contiguous_shards(spark, d):
    return s.select_loci(_loci(spark, d), shard_count=3, shard_index=1).withColumn("in_second", F.lit(True))


@query("t05_modulo_shards", f"WITH {RANKED} SELECT locus_id, index FROM rk WHERE index % 4 = 2")
def modulo_shards(spark, d):
    return s.select_loci(_loci(spark, d), shard_count=4, shard_index=2, mode="modulo")


@query("t07_chunk_members", f"""
WITH {MEMBERS}, r AS (SELECT locus_id, row_number() OVER (ORDER BY locus_id) - 1 AS index, count(*) OVER () AS n FROM (SELECT DISTINCT locus_id FROM mem)),
c AS (SELECT locus_id, (SELECT max(k) FROM range(5) t(k) WHERE index >= n * k // 5) AS chunk FROM r)
SELECT chunk, count(*) AS members, count(DISTINCT locus_id) AS loci FROM mem JOIN c USING (locus_id) GROUP BY 1""")
def chunk_members(spark, d):
    members = b.locus_members(spark, d).withColumn("locus_id", F.col("locus_id").cast("string"))
    ranked = s.select_loci(members)
    chunk = s.shard_of(F.col("index"), F.lit(ranked.count()), 5)
    joined = members.join(ranked.select("locus_id", chunk.alias("chunk")), "locus_id")
    per_locus = joined.groupBy("chunk", "locus_id").agg(F.count(F.lit(1)).alias("n"))
    return per_locus.groupBy("chunk").agg(F.sum("n").alias("members"), F.count(F.lit(1)).alias("loci"))


@query("j20_merged_shards", "SELECT p_partkey AS locus_id, p_name AS name, p_partkey * 2 AS rank FROM part")
def merged_shards(spark, d):
    rows = b.table(spark, d, "part").select(F.col("p_partkey").alias("locus_id"), F.col("p_name").alias("name"))
    shards = [rows.filter(F.col("locus_id") % 3 == i) for i in range(3)]
    return s.merge_shards(shards, rows.select("locus_id", (F.col("locus_id") * 2).alias("rank"))).select("locus_id", "name", "rank")


@query("t03_bounded_groups", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1")
def bounded_groups(spark, d):
    return s.bounded_groups(b.table(spark, d, "lineitem"), "l_orderkey", 1_000_000_000)


@query("j21_source_models", f"""
WITH {ALLELES},
sp AS (SELECT locus_id, 'r' || locus_id AS fid, 'primary_reference_anchor' AS role, 0 AS o, '' AS a FROM (SELECT DISTINCT locus_id FROM mem) WHERE locus_id % 3 = 0
       UNION ALL SELECT locus_id, CASE WHEN major_allele = 1 AND locus_id % 2 = 0 THEN 'r' || locus_id ELSE allele_id END, 'allele_representative', 1, allele_id FROM mj
       UNION ALL SELECT locus_id, 'main_reference_context:' || locus_id, 'main_reference_context', 2, '' FROM (SELECT DISTINCT locus_id FROM mem) WHERE locus_id % 3 <> 0),
k AS (SELECT *, row_number() OVER (PARTITION BY locus_id, fid ORDER BY o, a) AS nth FROM sp)
SELECT locus_id, fid AS model, role AS model_role, row_number() OVER (PARTITION BY locus_id ORDER BY o, a) AS rank FROM k WHERE nth = 1""")
def source_models(spark, d):
    c = F.col
    catalogue = allele_catalogue(spark, d)
    loci = catalogue.select("locus_id").distinct().select(
        "locus_id", F.when(c("locus_id") % 3 == 0, "primary_ref").otherwise("nonref").alias("anchor_type"),
        F.concat(F.lit("r"), c("locus_id").cast("string")).alias("anchor_ref_fid"),
    )
    shared = (c("major_allele") == 1) & (c("locus_id") % 2 == 0)
    reps = catalogue.select(
        "locus_id", "allele_id", F.when(shared, F.concat(F.lit("r"), c("locus_id").cast("string"))).otherwise(c("allele_id")).alias("rep_fid")
    )
    return m.source_models(loci, reps)


@query("j12_merged_alleles", f"""
WITH {ALLELES}, {CELLS},
ob AS (SELECT DISTINCT l_partkey AS locus_id, l_partkey || '_' || l_returnflag AS allele_id, 'NATION_' || s_nationkey AS genome FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 25),
al AS (SELECT a.locus_id, a.allele_id, c.genome, c.role, CASE WHEN ob.allele_id IS NOT NULL THEN '1' WHEN gt = 'NA' THEN 'NA' ELSE '0' END AS gt
       FROM ac a JOIN cell c ON a.locus_id = c.locus_id LEFT JOIN ob ON ob.allele_id = a.allele_id AND ob.genome = c.genome),
lc AS (SELECT locus_id, count(*) AS locus_member_n, count(DISTINCT label) AS locus_hap_n FROM mem GROUP BY 1),
k1 AS (SELECT allele_id, count(*) FILTER (role = 'sample' AND gt <> 'NA') AS allele_callable_asm_n, count(*) FILTER (gt = '1') AS allele_gt_1_total_n FROM al GROUP BY 1),
k2 AS (SELECT locus_id, count(*) FILTER (role = 'sample' AND gt <> 'NA') AS locus_callable_asm_n, count(*) FILTER (gt = '1') AS locus_gt_1_total_n FROM cell GROUP BY 1),
pv AS (SELECT allele_id, {MATRIX_COLUMNS} FROM al GROUP BY allele_id)
SELECT mj.locus_id, member_n, major_allele, asm_hap_n / 23 AS allele_freq, locus_member_n, locus_hap_n, allele_callable_asm_n, allele_gt_1_total_n, locus_callable_asm_n, locus_gt_1_total_n, pv.*
FROM mj JOIN lc ON lc.locus_id = mj.locus_id JOIN k1 ON k1.allele_id = mj.allele_id JOIN k2 ON k2.locus_id = mj.locus_id JOIN pv ON pv.allele_id = mj.allele_id""")
def merged_alleles(spark, d):
    c = F.col
    names = [r[0] for r in b.table(spark, d, "nation").select("n_name").orderBy("n_nationkey").collect()]
    roles = b.roles(spark, d)
    members = b.locus_members(spark, d)
    per_label = members.groupBy("locus_id", "label").agg(F.count(F.lit(1)).alias("n"))
    loci = per_label.groupBy("locus_id").agg(F.sum("n").alias("member_n"), F.count(F.lit(1)).alias("hap_n"))
    calls = materialize(propagated_genotypes(spark, d), "calls")
    out = s.merged_table(
        allele_catalogue(spark, d), loci, s.call_counts(calls, roles, "allele_id"), s.call_counts(b.cells(spark, d), roles, "locus_id"), calls, names, 23
    )
    return out.select(
        "locus_id", "member_n", "major_allele", "allele_freq", "locus_member_n", "locus_hap_n", "allele_callable_asm_n", "allele_gt_1_total_n",
        "locus_callable_asm_n", "locus_gt_1_total_n", "allele_id", *[c(n) for n in names],
    )
