"""Walk, segment and link queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import FeatureRules
from ..operators import genotype as gt
from ..operators import graph as g
from ..operators.scan import ordered_scan
from ..session import materialize
from . import bridges as b
from .registry import query

WALK = """
st AS (SELECT CAST(l_suppkey % 10 AS VARCHAR) AS path_id, l_partkey AS node, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS rev, CAST(p_size AS BIGINT) AS length,
              row_number() OVER w - 1 AS ordinal, CAST(sum(p_size) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end0
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WINDOW w AS (PARTITION BY l_suppkey % 10 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)),
wk AS (SELECT path_id, ordinal, end0 - length AS start0, end0, node, rev FROM st)
"""


@query("g02_unfold_walks", f"WITH {WALK} SELECT * FROM wk")
def unfold_walks(spark, d):
    return b.walks(spark, d)


@query("g04_path_totals", f"WITH {WALK} SELECT path_id, count(*) AS node_rows, CAST(sum(end0 - start0) AS BIGINT) AS span_bp, max(end0) AS end0 FROM wk GROUP BY 1")
def path_totals(spark, d):
    return g.path_totals(b.walks(spark, d))


@query("p54_prefix_bases", """
SELECT l_orderkey, l_linenumber, CAST(sum(q) OVER w AS BIGINT) AS prefix_bp, row_number() OVER w AS n
FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, sum(CAST(floor(l_quantity) AS BIGINT)) AS q FROM lineitem GROUP BY 1, 2)
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING)""")
def prefix_bases(spark, d):
    rows = b.table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("q")
    )
    return ordered_scan(rows, ["l_orderkey"], ["l_linenumber"], {"prefix_bp": ("sum", "q"), "n": ("count", None)}).drop("q")


@query("g01_segment_numbers", """
WITH s AS (SELECT p_partkey, p_name || '/' || p_partkey AS segment, CAST(p_size AS BIGINT) AS length FROM part)
SELECT segment, row_number() OVER (ORDER BY p_partkey) - 1 AS node, length FROM s""")
def segment_numbers(spark, d):
    segs = b.table(spark, d, "part").select(
        F.concat("p_name", F.lit("/"), F.col("p_partkey").cast("string")).alias("segment"), F.col("p_size").cast("long").alias("length"),
        F.col("p_partkey").alias("line_no"),
    )
    return g.number_segments(segs, False)


@query("s20_segment_statistics", """
SELECT count(*) AS n_segments, max(p_partkey) AS max_numeric, TRUE AS all_numeric, max(p_partkey) <= greatest(1024, count(*) * 2) AS dense_numeric FROM part""")
def segment_statistics(spark, d):
    return g.segment_statistics(b.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("segment")))


@query("s21_segment_lengths", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE length(text) END AS length FROM documents""")
def segment_lengths(spark, d):
    c = F.col
    name, flat = c("doc_id").cast("string"), F.translate("text", "\t\n\r", "   ")
    line = F.when(
        c("doc_id") % 3 == 0, F.concat_ws("\t", F.lit("S"), name, F.lit("*"), F.concat(F.lit("LN:i:"), c("n_chars").cast("string")))
    ).otherwise(F.concat_ws("\t", F.lit("S"), name, flat))
    lines = b.table(spark, d, "documents").select(line.alias("line"), c("doc_id").alias("line_no"))
    return g.segments(lines).select(c("segment").cast("long").alias("doc_id"), "length")


EDGES = """
sg AS (SELECT *, CAST(l_partkey AS VARCHAR) AS segment, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS sign FROM lineitem),
eg AS (SELECT l_orderkey, l_linestatus, lag(segment) OVER w AS a, lag(sign) OVER w AS sa, segment AS b, sign AS sb FROM sg
       WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)),
ky AS (SELECT l_orderkey, l_linestatus, least((a, sa, b, sb), (b, translate(sb, '+-', '-+'), a, translate(sa, '+-', '-+'))) AS k FROM eg WHERE a IS NOT NULL),
ks AS (SELECT l_orderkey, l_linestatus, k[1] AS from_name, k[2] AS from_sign, k[3] AS to_name, k[4] AS to_sign FROM ky)
"""
LINKS = """
lk AS (SELECT l_orderkey, from_name, from_sign, to_name, to_sign, CASE WHEN l_orderkey % 11 = 0 THEN '5M' ELSE '0M' END AS overlap FROM ks WHERE l_linestatus = 'O'),
lt AS (SELECT from_name, from_sign, to_name, to_sign, CASE WHEN count(*) <> 1 THEN 'multiple_matching_links' WHEN min(overlap) <> '0M' THEN 'link_overlap_unsupported' ELSE 'zero' END AS status
       FROM lk GROUP BY ALL)
"""


def _edges(spark, d):
    steps, order = b.order_edges(spark, d)
    return g.edges(steps, "l_orderkey", order)


def _links(edges):
    overlap = F.when(F.col("l_orderkey") % 11 == 0, "5M").otherwise("0M")
    return g.link_table(edges.filter("l_linestatus = 'O'").select("key", overlap.alias("overlap")))


@query("a17_link_table", f"WITH {EDGES}, {LINKS} SELECT * FROM lt")
def link_table(spark, d):
    return _links(_edges(spark, d)).select("key.from_name", "key.from_sign", "key.to_name", "key.to_sign", "status")


@query("g07_edge_status", f"""
WITH {EDGES}, {LINKS}
SELECT l_orderkey, coalesce(status, 'missing_link') AS status, count(*) AS n FROM ks LEFT JOIN lt USING (from_name, from_sign, to_name, to_sign) GROUP BY 1, 2""")
def edge_status(spark, d):
    edges = materialize(_edges(spark, d).select("l_orderkey", "l_linestatus", "key"), "edges")  # links come from them, too
    return g.with_link_status(edges, _links(edges)).groupBy("l_orderkey", "status").agg(F.count(F.lit(1)).alias("n"))


FRAGMENTS = """
fr AS (SELECT 'conv' || conv_id AS gfa_path_id, turn AS line_no, turn * 100 AS start0,
              CASE WHEN role = 'user' THEN turn * 100 + 100 ELSE turn * 100 + 100 - length(text) % 2 END AS end0 FROM conversations)
"""


@query("s20_fragment_breaks", f"""
WITH {FRAGMENTS} SELECT gfa_path_id, line_no, start0, previous_end FROM (SELECT *, lag(end0) OVER (PARTITION BY gfa_path_id ORDER BY line_no) AS previous_end FROM fr) WHERE previous_end <> start0""")
def fragment_breaks(spark, d):
    return g.fragment_breaks(b.fragments(spark, d)).select("gfa_path_id", "line_no", "start0", "previous_end")


@query("s34_discontinuities", f"""
WITH {FRAGMENTS} SELECT gfa_path_id AS path_id, line_no AS ordinal, start0, end0 FROM (SELECT *, lag(end0) OVER (PARTITION BY gfa_path_id ORDER BY line_no) AS p FROM fr)
WHERE start0 <> coalesce(p, 0) OR end0 <= start0""")
def discontinuities(spark, d):
    walk = b.fragments(spark, d).select(F.col("gfa_path_id").alias("path_id"), F.col("line_no").alias("ordinal"), "start0", "end0")
    return g.discontinuities(walk).select("path_id", "ordinal", "start0", "end0")


@query("s20_path_inventory", """
SELECT 'GP_' || left(sha256('W' || chr(0) || 'conv' || conv_id || chr(0) || '0' || chr(0) || 'c'), 24) AS gfa_path_id, count(*) AS fragment_count,
       min(turn * 100) AS start0, max(turn * 100 + 100) AS end0, CAST(count(*) * 100 AS BIGINT) AS path_length_bp,
       string_agg(CAST(conv_id * 10 + turn AS VARCHAR), ',' ORDER BY turn) AS source_lines, 'not_applicable' AS overlap_status
FROM conversations GROUP BY conv_id""")
def path_inventory(spark, d):
    c = F.col
    at = (c("turn") * 100).cast("string")
    line = F.concat_ws(
        "\t", F.lit("W"), F.concat(F.lit("conv"), c("conv_id").cast("string")), F.lit("0"), F.lit("c"), at,
        (c("turn") * 100 + 100).cast("string"), F.concat(F.lit(">"), c("role"), F.lit("<x")),
    )
    lines = b.table(spark, d, "conversations").select(line.alias("line"), (c("conv_id") * 10 + c("turn")).alias("line_no"))
    return g.inventory(g.path_records(lines)).select(
        "gfa_path_id", "fragment_count", "start0", "end0", "path_length_bp", "source_lines", "overlap_status"
    )


MAPPED = f"""
{WALK},
wf AS (SELECT CAST(o_custkey % 10 AS VARCHAR) AS contig, 'o' || o_orderkey AS fid, o_orderkey * 10 AS lo, o_orderkey * 10 + 20 + o_custkey % 200 AS hi FROM orders),
wr AS (SELECT fid, lo, hi, w.* FROM wf JOIN wk w ON contig = path_id AND start0 < hi + 1000 AND lo - 1000 < end0),
hd AS (SELECT fid, start0 AS h0 FROM wr WHERE start0 <= lo AND lo < end0),
en AS (SELECT DISTINCT fid FROM wr WHERE start0 < hi AND hi <= end0),
sd AS (SELECT fid, 'body' AS side, ordinal, node, rev, start0, end0, greatest(lo, start0) AS a, least(hi, end0) AS b FROM wr WHERE start0 < hi AND lo < end0
       UNION ALL SELECT fid, 'left', ordinal, node, rev, start0, end0, greatest(lo - 1000, start0), least(lo, end0)
         FROM wr JOIN hd USING (fid) WHERE start0 < lo AND (start0 = h0 OR end0 = h0 OR h0 - start0 <= 1000)
       UNION ALL SELECT fid, 'right', ordinal, node, rev, start0, end0, greatest(hi, start0), least(hi + 1000, end0)
         FROM wr JOIN en USING (fid) WHERE end0 > hi),
sp AS (SELECT fid, side, ordinal, node, rev, CASE WHEN rev = 0 THEN a - start0 ELSE end0 - b END AS s, CASE WHEN rev = 0 THEN b - start0 ELSE end0 - a END AS e, b - a AS bp
       FROM sd WHERE a < b)
"""


def _mapped(spark, d):
    rules = FeatureRules()
    walk = b.walks(spark, d).withColumnRenamed("path_id", "contig")
    return g.map_features(b.walk_features(spark, d), walk, rules.flank_bp)


@query("j03_mapped_steps", f"WITH {MAPPED} SELECT fid, side, ordinal, node, CAST(rev AS BIGINT) AS rev, s, e, bp FROM sp")
def mapped_steps(spark, d):
    return _mapped(spark, d)


@query("d05_graph_acceptance", f"""
WITH {MAPPED},
t AS (SELECT wf.fid, CAST(coalesce(sum(bp) FILTER (side = 'body'), 0) AS BIGINT) AS graph_bp, count(*) FILTER (side = 'body') AS graph_nsteps, hi - lo AS n,
             count(*) FILTER (side = 'left') AS left_flank_nsteps, count(*) FILTER (side = 'right') AS right_flank_nsteps FROM wf LEFT JOIN sp USING (fid) GROUP BY wf.fid, hi, lo)
SELECT fid, graph_bp, graph_nsteps, left_flank_nsteps, right_flank_nsteps, graph_bp / n AS graph_cov,
       CASE WHEN graph_nsteps = 0 THEN 'no_path_overlap' WHEN graph_bp / n < 0.95 THEN 'graph_cov_lt_0.95' ELSE '' END AS reason FROM t""")
def graph_acceptance(spark, d):
    c = F.col
    total = g.mapping_summary(b.walk_features(spark, d), _mapped(spark, d))
    reason = F.when(c("graph_nsteps") == 0, "no_path_overlap").when(c("graph_cov") < FeatureRules().min_graph_coverage, "graph_cov_lt_0.95").otherwise("")
    return total.select("fid", "graph_bp", "graph_nsteps", "left_flank_nsteps", "right_flank_nsteps", "graph_cov", reason.alias("reason"))


MODELS = f"""
{WALK},
mr AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem),
mp AS (SELECT 'o' || l_orderkey AS model, l_partkey AS node, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS rev, CAST(p_size AS BIGINT) AS e, row_number() OVER w - 1 AS pos,
              count(*) OVER (PARTITION BY l_orderkey) AS n FROM mr JOIN part ON p_partkey = l_partkey
       WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)),
ms AS (SELECT model, CASE WHEN pos < n // 2 THEN 'left' ELSE 'right' END AS side, CASE WHEN pos < n // 2 THEN pos ELSE pos - n // 2 END AS idx, node, rev, e FROM mp),
mb AS (SELECT *, CAST(sum(e) OVER (PARTITION BY model, side ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum, CAST(sum(e) OVER (PARTITION BY model, side) AS BIGINT) AS tot FROM ms),
mf AS (SELECT model, side, idx, node, rev, e, cum - e - CASE WHEN side = 'left' THEN tot ELSE 0 END AS start_bp, cum - CASE WHEN side = 'left' THEN tot ELSE 0 END AS end_bp FROM mb)
"""
RUNS = f"""
{MODELS},
oc AS (SELECT mf.*, wk.path_id AS chrom, wk.ordinal, CAST(CASE WHEN wk.rev = mf.rev THEN 1 ELSE -1 END AS BIGINT) AS direction, wk.start0 AS a, wk.end0 AS b FROM mf JOIN wk ON wk.node = mf.node),
dg AS (SELECT *, ordinal - direction * idx AS diag FROM oc),
is_ AS (SELECT *, idx - row_number() OVER (PARTITION BY model, side, chrom, direction, diag ORDER BY idx) AS isl FROM dg),
rn AS (SELECT model, side, chrom, direction, min(idx) AS source_lo, max(idx) AS source_hi, min(start_bp) AS source_start_bp, max(end_bp) AS source_end_bp, CAST(sum(e) AS BIGINT) AS support_bp,
              min(a) AS target_start0, max(b) AS target_end0, min(ordinal) AS ord_start, max(ordinal) AS ord_end FROM is_ GROUP BY model, side, chrom, direction, diag, isl),
pn AS (SELECT *, count(*) OVER (PARTITION BY model, side, source_lo, source_hi) AS placement_n FROM rn)
"""


@query("p55_flank_offsets", f"WITH {MODELS} SELECT model, side, idx, node, start_bp, end_bp FROM mf")
def flank_offsets(spark, d):
    return gt.flank_steps(b.model_steps(spark, d), 1_000_000).select("model", "side", "idx", "node", "start_bp", "end_bp")


def runs(spark, d, min_bp=None):
    steps = gt.flank_steps(b.model_steps(spark, d), 1_000_000)
    return gt.exact_runs(steps, b.occurrences(b.walks(spark, d)), min_bp=min_bp)


@query("j16_node_occurrences", f"""
WITH {MODELS} SELECT mf.model, count(*) AS occurrences, count(DISTINCT wk.path_id) AS contigs FROM mf JOIN wk ON wk.node = mf.node GROUP BY 1""")
def node_occurrences(spark, d):
    # neither offsets nor positions are asked for, so nothing is put in order
    visits = g.located(b.walk_steps(spark, d).select("path_id", "segment"), b.nodes(spark, d))
    return gt.node_occurrences(b.model_nodes(spark, d), visits)


@query("c25_exact_runs", f"""
WITH {RUNS}
SELECT model, side, chrom, direction, count(*) AS runs, CAST(sum(support_bp) AS BIGINT) AS support_bp, CAST(sum(target_start0) AS BIGINT) AS start_sum, CAST(sum(target_end0) AS BIGINT) AS end_sum,
       CAST(sum(source_start_bp) AS BIGINT) AS source_sum, min(ord_start) AS first_ord, max(ord_end) AS last_ord, max(placement_n) AS most_placed, CAST(max(source_hi - source_lo) AS BIGINT) AS longest FROM pn GROUP BY 1, 2, 3, 4""")
def exact_runs(spark, d):
    c = F.col
    return runs(spark, d).groupBy("model", "side", "chrom", "direction").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("support_bp").alias("support_bp"), F.sum("target_start0").alias("start_sum"), F.sum("target_end0").alias("end_sum"),
        F.sum("source_start_bp").alias("source_sum"), F.min("ord_start").alias("first_ord"), F.max("ord_end").alias("last_ord"),
        F.max("placement_n").alias("most_placed"), F.max(c("source_hi") - c("source_lo")).alias("longest"),
    )


@query("p57_run_anchors", f"""
WITH {RUNS}, w AS (SELECT *, CAST(unnest([100, 1000, 10000]) AS INTEGER) AS win FROM pn),
a AS (SELECT model, win AS "window", side, chrom AS contig, direction, placement_n AS multiplicity, source_start_bp AS ss, source_end_bp AS se,
             greatest(CASE WHEN side = 'left' THEN -win ELSE 0 END, source_start_bp) AS s0, least(CASE WHEN side = 'left' THEN 0 ELSE win END, source_end_bp) AS s1,
             CASE WHEN direction = 1 THEN target_start0 ELSE -target_end0 END AS t0, CASE WHEN direction = 1 THEN target_end0 ELSE -target_start0 END AS t1 FROM w)
, u AS (SELECT DISTINCT model, "window", side, contig, direction, multiplicity, s0, s1, t0 + s0 - ss AS t0, t1 - (se - s1) AS t1 FROM a WHERE s1 > s0)
SELECT model, "window", side, direction, count(*) AS anchors, CAST(sum(s0) AS BIGINT) AS s0, CAST(sum(s1) AS BIGINT) AS s1, CAST(sum(t0) AS BIGINT) AS t0, CAST(sum(t1) AS BIGINT) AS t1, max(multiplicity) AS most FROM u GROUP BY 1, 2, 3, 4""")
def run_anchors(spark, d):
    anchors = gt.run_anchors(runs(spark, d), (100, 1000, 10000))
    return anchors.groupBy("model", "window", "side", "direction").agg(
        F.count(F.lit(1)).alias("anchors"), *[F.sum(n).alias(n) for n in ("s0", "s1", "t0", "t1")], F.max("multiplicity").alias("most")
    )
