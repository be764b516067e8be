"""Contract queries: each lists violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import inputs as ic
from ..contracts import results as rc
from ..contracts import rules as r
from ..functions import keys as k
from . import bridges as b
from .registry import query
from .scalars import FEATURES


@query("v01_role_violations", """
WITH g AS (SELECT n_name AS hal_genome, CASE WHEN n_regionkey = 0 THEN 'primary_reference' WHEN n_regionkey = 1 THEN 'comparison_reference' WHEN n_regionkey = 2 THEN 'sample' ELSE r_name END AS role
           FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT 'needs_one_primary_reference' AS rule, CAST(count(*) AS VARCHAR) AS subject, '' AS detail FROM g WHERE role = 'primary_reference' HAVING count(*) <> 1
UNION ALL SELECT 'too_many_comparison_references', CAST(count(*) AS VARCHAR), '' FROM g WHERE role = 'comparison_reference' HAVING count(*) > 1
UNION ALL SELECT 'unknown_role', hal_genome, role FROM g WHERE role NOT IN ('primary_reference', 'comparison_reference', 'sample')""")
def role_violations(spark, d):
    c = F.col
    role = F.when(c("n_regionkey") == 0, "primary_reference").when(c("n_regionkey") == 1, "comparison_reference").when(c("n_regionkey") == 2, "sample").otherwise(c("r_name"))
    joined = b.table(spark, d, "nation").join(b.table(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    return ic.role_violations(joined.select(c("n_name").alias("hal_genome"), role.alias("role")))


@query("v05_duplicate_keys", """
SELECT 'duplicate_line' AS rule, l_orderkey || '|' || l_linenumber AS subject, CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark, d):
    return r.duplicates(b.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "duplicate_line")


@query("t10_set_differences", """
SELECT 'labels' AS rule, CAST(doc_id AS VARCHAR) AS subject, 'only_left' AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'labels', CAST(doc_id AS VARCHAR), 'only_right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'lines', CAST(o_orderkey AS VARCHAR), 'only_left' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def set_differences(spark, d):
    orders = b.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    lines = b.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    return r.set_difference(b.table(spark, d, "documents"), b.table(spark, d, "labels"), ["doc_id"], "labels").unionByName(
        r.set_difference(orders, lines, ["k"], "lines")
    )


@query("v03_missing_parents", """
SELECT 'part' AS rule, CAST(l_partkey AS VARCHAR) AS subject, '' AS detail FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY l_partkey
UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR), '' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""")
def missing_parents(spark, d):
    parts = b.table(spark, d, "part").filter("p_size > 5")
    customers = b.table(spark, d, "customer").filter("c_acctbal >= 0")
    return r.all_of([
        r.missing_parent(b.table(spark, d, "lineitem"), "l_partkey", parts, "p_partkey", "part"),
        r.missing_parent(b.table(spark, d, "orders"), "o_custkey", customers, "c_custkey", "customer"),
    ])


@query("v02_cell_checks", """
WITH t AS (SELECT event_id, CAST(value AS VARCHAR) AS value, props, event_type, CASE WHEN event_id % 9 = 0 THEN '' ELSE CAST(user_id - 5 AS VARCHAR) END AS user_id FROM events)
SELECT 'events:user_id:missing_value' AS rule, CAST(event_id AS VARCHAR) AS subject, user_id AS detail FROM t WHERE user_id = ''
UNION ALL SELECT 'events:user_id:not_a_whole_number', CAST(event_id AS VARCHAR), user_id FROM t WHERE user_id <> '' AND NOT regexp_full_match(user_id, '[0-9]+')
UNION ALL SELECT 'events:value:fraction_above_one', CAST(event_id AS VARCHAR), value FROM t WHERE CAST(value AS DOUBLE) > 1
UNION ALL SELECT 'events:event_type:value_not_allowed', CAST(event_id AS VARCHAR), event_type FROM t WHERE event_type NOT IN ('view', 'click', 'error')
UNION ALL SELECT 'events:props:not_a_json_array', CAST(event_id AS VARCHAR), props FROM t WHERE json_type(props) <> 'ARRAY'""")
def cell_checks(spark, d):
    c = F.col
    cells = b.table(spark, d, "events").select(
        "event_id", c("value").cast("string"), "props", "event_type", F.when(c("event_id") % 9 == 0, "").otherwise((c("user_id") - 5).cast("string")).alias("user_id")
    )
    fields = {
        "user_id": {"kind": "integer"}, "value": {"kind": "number", "unit": "fraction"}, "props": {"kind": "json_array"},
        "event_type": {"kind": "string", "allowed": ["view", "click", "error"]},
    }
    return r.check_cells(cells, fields, c("event_id"), "events")


BED = f"""
{FEATURES},
bd AS (SELECT CAST(l_suppkey % 10 AS VARCHAR) AS contig, l_orderkey * 50 + CAST(l_linenumber AS BIGINT) * 7 AS s, l_orderkey * 50 + CAST(l_linenumber AS BIGINT) * 7 + CAST(floor(l_quantity) AS BIGINT) AS e,
              CAST(floor(l_quantity) AS BIGINT) + CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END AS n, CAST(floor(l_quantity) AS BIGINT) // 4 + CASE WHEN l_partkey % 13 = 0 THEN 30 ELSE 0 END AS cpg,
              CAST(floor(l_quantity) AS BIGINT) // 2 + 1 AS gc, CASE WHEN l_partkey % 11 = 0 THEN 12.5 ELSE NULL END AS odd FROM lineitem),
bt AS (SELECT *, contig || ':' || s || '-' || e AS subject, coalesce(odd, round(200 * cpg / n, 1)) AS p1, round(100 * gc / n, 2) AS p2 FROM bd),
bc AS (SELECT *, n = e - s AS span, 2 * cpg <= gc AND gc <= n AS counts, p1 <= 100 AND p2 <= 100 AS fin,
              abs(p1 - 200 * cpg / n) > CASE WHEN odd IS NULL THEN 0.05 ELSE 0.05 END + 1e-9 OR abs(p2 - 100 * gc / n) > 0.005 + 1e-9 AS off FROM bt)
"""


@query("s06_bed_violations", f"""
WITH {BED}
SELECT rule, subject, count(*) AS n FROM (
  SELECT 'bad_span' AS rule, subject FROM bc WHERE NOT span
  UNION ALL SELECT 'bad_counts', subject FROM bc WHERE NOT counts
  UNION ALL SELECT 'bad_metric', subject FROM bc WHERE NOT fin
  UNION ALL SELECT 'percentage_contradicts_counts', subject FROM bc WHERE span AND counts AND fin AND off
  UNION ALL SELECT 'duplicate_interval', contig || '|' || s || '|' || e FROM bt GROUP BY contig, s, e HAVING count(*) > 1) GROUP BY 1, 2""")
def bed_violations(spark, d):
    c = F.col
    qty = c("l_quantity").cast("long")
    start = (c("l_orderkey") * 50 + c("l_linenumber") * 7).cast("long")
    n = qty + F.when(c("l_partkey") % 17 == 0, 1).otherwise(0)
    cpg = F.floor(qty / 4) + F.when(c("l_partkey") % 13 == 0, 30).otherwise(0)
    gc = F.floor(qty / 2) + 1
    p1 = F.when(c("l_partkey") % 11 == 0, "12.5").otherwise(F.format_string("%.1f", F.round(200 * cpg / n, 1)))
    bed = b.table(spark, d, "lineitem").select(
        b.text("l_suppkey % 10").alias("contig"), start.cast("string").alias("start0"), (start + qty).cast("string").alias("end0"), F.lit("CGI").alias("name"),
        n.cast("string").alias("length"), cpg.cast("string").alias("cpg_n"), gc.cast("string").alias("gc_n"), p1.alias("pct_cpg"),
        F.format_string("%.2f", F.round(100 * gc / n, 2)).alias("pct_gc"), F.lit("1.0").alias("oe"),
    )
    lengths = b.table(spark, d, "supplier").select(b.text("s_suppkey % 10").alias("contig")).distinct().withColumn("sequence_length", F.lit(10**12))
    return ic.bed_violations(bed, lengths).groupBy("rule", "subject").agg(F.count(F.lit(1)).alias("n"))


@query("s08_event_violations", """
WITH e AS (SELECT 'sv' || o_orderkey % 12000 AS sv_id, CASE o_orderkey % 7 WHEN 0 THEN 'INV' WHEN 1 THEN 'DEL' WHEN 2 THEN 'DEL' ELSE 'INS' END AS t, o_orderkey AS k, CAST(o_custkey % 12 AS VARCHAR) AS asm,
                  o_orderkey + 1 AS p, o_orderkey + 1 + CASE WHEN o_orderkey % 7 = 1 OR o_custkey % 19 = 0 THEN 5 ELSE 0 END AS q, o_orderkey AS s, o_orderkey + CASE WHEN o_orderkey % 7 IN (1, 2) THEN 0 ELSE 9 END AS z,
                  CASE WHEN o_custkey % 23 = 0 THEN 0 WHEN o_orderkey % 7 IN (1, 2) THEN -5 ELSE 9 END AS n FROM orders)
SELECT rule, subject, count(*) AS n FROM (
  SELECT 'duplicate_id' AS rule, sv_id AS subject FROM e GROUP BY sv_id HAVING count(*) > 1
  UNION ALL SELECT 'unsupported_type', sv_id FROM e WHERE t = 'INV'
  UNION ALL SELECT 'length_contradicts_type', sv_id FROM e WHERE (t = 'INS' AND n <= 0) OR (t = 'DEL' AND n >= 0)
  UNION ALL SELECT 'undeclared_sequence', sv_id FROM e WHERE CAST(asm AS INT) >= 10
  UNION ALL SELECT 'bad_insertion_geometry', sv_id FROM e WHERE t = 'INS' AND NOT (p = q AND s < z)
  UNION ALL SELECT 'bad_deletion_geometry', sv_id FROM e WHERE t = 'DEL' AND NOT (p < q AND s = z)) GROUP BY 1, 2""")
def event_violations(spark, d):
    c = F.col
    key = c("o_orderkey")
    dele = (key % 7).isin(1, 2)
    events = b.table(spark, d, "orders").select(
        F.lit("chr1").alias("ref_contig"), (key + 1).cast("string").alias("ref_pos1"),
        (key + 1 + F.when((key % 7 == 1) | (c("o_custkey") % 19 == 0), 5).otherwise(0)).cast("string").alias("ref_end1"),
        F.concat(F.lit("sv"), (key % 12000).cast("string")).alias("sv_id"), F.when(key % 7 == 0, "INV").when(dele, "DEL").otherwise("INS").alias("sv_type"),
        b.text("o_custkey % 12").alias("asm_contig"), key.cast("string").alias("asm_start0"), (key + F.when(dele, 0).otherwise(9)).cast("string").alias("asm_end0"),
        F.when(c("o_custkey") % 23 == 0, "0").when(dele, "-5").otherwise("9").alias("sv_length"),
    )
    lengths = b.table(spark, d, "supplier").select(b.text("s_suppkey % 10").alias("contig")).distinct().withColumn("sequence_length", F.lit(10**12))
    refs = lengths.select(F.lit("chr1").alias("contig"), "sequence_length").distinct()
    return ic.event_violations(events, lengths, refs).groupBy("rule", "subject").agg(F.count(F.lit(1)).alias("n"))


@query("j13_mapping_candidates", """
WITH s AS (SELECT source AS g, lang AS q, count(*) AS n FROM documents GROUP BY 1, 2),
w AS (SELECT source AS g, lang AS q, doc_id FROM documents WHERE n_chars > 2500),
c AS (SELECT g, q, count(*) AS n, min('W' || doc_id) AS o FROM w GROUP BY 1, 2)
SELECT s.g AS hal_genome, s.q AS hal_sequence, coalesce(c.n, 0) AS candidate_count,
       CASE WHEN c.n IS NULL THEN 'no_exact_literal_match' WHEN c.n = 1 THEN 'exact_literal_candidate' ELSE 'multiple_exact_literal_matches' END AS candidate_status,
       CASE WHEN c.n = 1 THEN o ELSE '' END AS candidate_gfa_path_id FROM s LEFT JOIN c USING (g, q)""")
def mapping_candidates(spark, d):
    docs = b.table(spark, d, "documents")
    sequences = docs.select(F.col("source").alias("hal_genome"), F.col("lang").alias("hal_sequence")).distinct()
    inventory = docs.filter("n_chars > 2500").select(
        F.lit("W").alias("record_type"), F.col("source").alias("w_sample_id"), F.col("lang").alias("sequence_id"), F.lit("").alias("raw_path_name"),
        F.concat(F.lit("W"), F.col("doc_id").cast("string")).alias("gfa_path_id"),
    )
    return ic.mapping_candidates(sequences, inventory)


@query("j14_confirmed_mapping", """
WITH c AS (SELECT o_orderkey, 'P' || o_orderkey % 14000 AS path, o_orderstatus AS st FROM orders)
SELECT rule, subject, count(*) AS n FROM (
  SELECT 'not_confirmed' AS rule, 'g|' || o_orderkey AS subject FROM c WHERE st <> 'F'
  UNION ALL SELECT 'unknown_path', 'g|' || o_orderkey FROM c WHERE CAST(substr(path, 2) AS BIGINT) NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'path_mapped_twice', path FROM c GROUP BY path HAVING count(*) > 1) GROUP BY 1, 2""")
def confirmed_mapping(spark, d):
    c = F.col
    contigs = b.table(spark, d, "orders").select(
        F.lit("g").alias("genome_id"), c("o_orderkey").cast("string").alias("contig_id"), F.concat(F.lit("P"), b.text("o_orderkey % 14000")).alias("gfa_path_id"),
        F.when(c("o_orderstatus") == "F", "confirmed").otherwise("draft").alias("mapping_status"),
    )
    inventory = b.table(spark, d, "lineitem").select(F.concat(F.lit("P"), c("l_orderkey").cast("string")).alias("gfa_path_id")).distinct()
    found = ic.confirmed_mapping_violations(contigs, inventory.withColumn("overlap_status", F.lit("zero")))
    return found.groupBy("rule", "subject").agg(F.count(F.lit(1)).alias("n"))


@query("j15_renamed_inputs", """
SELECT 'G' || sha256('["' || n_name || '"]') || '#0#C' || sha256('["' || s_name || '"]') || ':' || s_suppkey || '-' || (s_suppkey + 10) AS fid, n_name AS hal_genome, s_name AS hal_sequence
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def renamed_inputs(spark, d):
    c = F.col
    joined = b.table(spark, d, "supplier").join(b.table(spark, d, "nation"), c("n_nationkey") == c("s_nationkey"))
    contig = F.concat(k.storage_id("G", c("n_name")), F.lit("#0#"), k.storage_id("C", c("s_name")))
    return joined.select(
        k.feature_key(contig, c("s_suppkey"), c("s_suppkey") + 10).alias("fid"), c("n_name").alias("hal_genome"), c("s_name").alias("hal_sequence")
    )


@query("v10_path_totals", """
WITH t AS (SELECT o_custkey AS k, CAST(sum(o_orderkey) AS BIGINT) AS span FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1), e AS (SELECT c_custkey AS k, c_custkey * 10 AS n FROM customer WHERE c_acctbal > 0)
SELECT rule, subject FROM (SELECT 'unexpected_path' AS rule, CAST(k AS VARCHAR) AS subject FROM t WHERE k NOT IN (SELECT k FROM e)
  UNION ALL SELECT 'missing_path', CAST(k AS VARCHAR) FROM e WHERE k NOT IN (SELECT k FROM t)
  UNION ALL SELECT 'span_mismatch', CAST(t.k AS VARCHAR) FROM t JOIN e ON t.k = e.k WHERE span <> n)""")
def path_total_violations(spark, d):
    c = F.col
    urgent = b.table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    totals = urgent.groupBy(c("o_custkey").alias("path_id")).agg(F.sum("o_orderkey").alias("span_bp")).withColumn("end0", c("span_bp"))
    expected = b.table(spark, d, "customer").filter("c_acctbal > 0").select(c("c_custkey").alias("path_id"), (c("c_custkey") * 10).alias("length_bp"))
    return ic.path_total_violations(totals, expected).select("rule", "subject")


@query("v03_genotype_closure", """
WITH a AS (SELECT l_partkey AS locus_id, l_returnflag AS allele_id, CAST(l_suppkey % 5 AS VARCHAR) AS genome, CASE WHEN max(l_quantity) > 45 THEN '1' WHEN max(l_quantity) > 20 THEN '0' ELSE 'NA' END AS gt FROM lineitem GROUP BY 1, 2, 3),
l AS (SELECT l_partkey AS locus_id, CAST(l_suppkey % 5 AS VARCHAR) AS genome, CASE WHEN max(l_quantity) > 45 THEN '1' WHEN max(l_quantity) > 20 THEN '0' ELSE 'NA' END AS gt FROM lineitem GROUP BY 1, 2),
c AS (SELECT locus_id, genome, l.gt, bool_or(a.gt = '1') AS one, bool_or(a.gt = 'NA') AS na, bool_and(a.gt = '0') AS zero, bool_and(a.gt = 'NA') AS allna FROM l JOIN a USING (locus_id, genome) GROUP BY 1, 2, 3)
SELECT locus_id || '|' || genome AS subject, gt AS detail FROM c WHERE NOT ((gt = '1' AND one AND NOT na) OR (gt = '0' AND zero) OR (gt = 'NA' AND allna))""")
def genotype_closure(spark, d):
    c = F.col
    rows = b.table(spark, d, "lineitem").select(
        c("l_partkey").alias("locus_id"), c("l_returnflag").alias("allele_id"), b.text("l_suppkey % 5").alias("genome"), "l_quantity"
    )
    gt = F.when(F.max("l_quantity") > 45, "1").when(F.max("l_quantity") > 20, "0").otherwise("NA").alias("gt")
    return rc.closure_violations(rows.groupBy("locus_id", "genome").agg(gt), rows.groupBy("locus_id", "allele_id", "genome").agg(gt)).select("subject", "detail")


@query("v03_frequency_recomputation", """
WITH m AS (SELECT l_partkey AS id, CASE WHEN l_quantity > 25 THEN '1' WHEN l_quantity > 5 THEN '0' ELSE 'NA' END AS gt FROM lineitem),
t AS (SELECT id, count(*) AS total, count(*) FILTER (gt = '1') AS ac, count(*) FILTER (gt <> 'NA') AS n FROM m GROUP BY 1)
SELECT 'frequency_mismatch' AS rule, CAST(id AS VARCHAR) AS subject FROM t WHERE n > 0 AND id % 3 = 0""")
def frequency_recomputation(spark, d):
    c = F.col
    counts = b.table(spark, d, "lineitem").groupBy(c("l_partkey").alias("id")).agg(
        F.count_if(c("l_quantity") > 25).alias("ac"), F.count_if(c("l_quantity") > 5).alias("n_called"), F.count(F.lit(1)).alias("sample_haplotype_n")
    )
    stated = counts.select(
        "id", "ac", "n_called", "sample_haplotype_n", (c("n_called") / c("sample_haplotype_n")).alias("call_rate"),
        (F.try_divide(c("ac"), c("n_called")) + F.when(c("id") % 3 == 0, 0.001).otherwise(0.0)).alias("af"),
    )
    return rc.frequency_violations(stated, counts, "id").select("rule", "subject")


@query("v03_event_geometry", """
WITH e AS (SELECT o_orderkey AS k, o_orderkey % 3 <> 0 AS ins, o_custkey % 40 AS a, o_custkey % 40 + CASE WHEN o_orderkey % 3 <> 0 THEN 1 + o_orderkey % 60 ELSE 0 END AS z, 10 AS cs, 45 AS ce FROM orders)
SELECT CASE WHEN ins THEN 'bad_insertion_overlap' ELSE 'bad_deletion_junction' END AS rule, CAST(k AS VARCHAR) AS subject FROM e
WHERE CASE WHEN ins THEN least(z, ce) - greatest(a, cs) <= 0 ELSE NOT (cs < a AND a < ce) END""")
def event_geometry(spark, d):
    c = F.col
    ins = c("o_orderkey") % 3 != 0
    a = c("o_custkey") % 40
    events = b.table(spark, d, "orders").select(
        c("o_orderkey").cast("string").alias("member_id"), F.lit("").alias("sv_id"), F.when(ins, "INS").otherwise("DEL").alias("sv_type"), a.alias("asm_start0"),
        F.when(ins, a + 1 + c("o_orderkey") % 60).otherwise(a).alias("asm_end0"), F.lit(10).cast("long").alias("start0"), F.lit(45).cast("long").alias("end0"),
    )
    return rc.event_geometry_violations(events).select("rule", F.split("subject", "\\|")[0].alias("subject"))


@query("v04_evidence_decisions", """
WITH d AS (SELECT l_orderkey AS k, l_linenumber AS n, count(*) - 1 AS p, round(max(l_discount) * 10, 2) AS best, round(min(l_discount) * 10, 2) AS runner, bool_or(l_returnflag = 'A') AS said FROM lineitem GROUP BY 1, 2)
SELECT k || '|' || n AS subject, p || '' AS detail FROM d WHERE said <> (p > 0 AND best > 0 AND best > runner AND (best - runner) / best >= 0.02)""")
def evidence_decisions(spark, d):
    c = F.col
    rows = b.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        (F.count(F.lit(1)) - 1).alias("placements"), F.round(F.max("l_discount") * 10, 2).alias("best_score"), F.round(F.min("l_discount") * 10, 2).alias("runner_score"),
        F.bool_or(c("l_returnflag") == "A").alias("said"),
    )
    stated = rows.select(
        c("l_orderkey").cast("string").alias("locus_id"), c("l_linenumber").cast("string").alias("genome"), F.lit("").alias("model"), "placements", "best_score", "runner_score",
        F.when(c("said"), "0").otherwise("NA").alias("call"),
    )
    found = rc.decision_violations(stated, 0.02)
    return found.select(F.concat_ws("|", F.split("subject", "\\|")[0], F.split("subject", "\\|")[1]).alias("subject"), "detail")


@query("v17_changed_records", """
SELECT p_partkey AS ordinal, CASE WHEN p_size <= 10 THEN 'missing' ELSE 'changed' END AS problem FROM part WHERE p_size <= 10 OR p_brand = 'Brand#2'""")
def changed_records(spark, d):
    part = b.table(spark, d, "part")
    source = part.select(F.col("p_partkey").alias("ordinal"), F.col("p_name").alias("record"))
    stored = part.filter("p_size > 10").select(F.col("p_partkey").alias("ordinal"), F.when(F.col("p_brand") == "Brand#2", "x").otherwise(F.col("p_name")).alias("record"))
    return rc.changed_records(source, stored)


@query("k12_accounting", f"""
WITH {FEATURES}, a AS (SELECT fid, end0 - start0 AS n FROM feat)
SELECT count(*) AS input_n, count(*) FILTER (n >= 10) AS accepted_n, count(*) FILTER (n < 10) AS excluded_n, TRUE AS closed FROM a""")
def accounting(spark, d):
    feats = b.features(spark, d)
    short = (F.col("end0") - F.col("start0")) < 10
    return rc.accounting(feats, feats.filter(~short), feats.filter(short), "fid")
