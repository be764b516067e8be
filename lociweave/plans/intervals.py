"""Interval, event, hit and reference queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import intervals as iv
from ..functions import scalars as sc
from ..operators import graph as g
from ..operators import hits as h
from ..operators import overlap as ov
from ..operators import reference as rf
from ..operators import sites as st
from ..operators.interval_join import interval_join
from ..operators.scan import ordered_scan
from ..session import materialize
from ..sources import genome as src
from . import bridges as b
from .registry import query
from .scalars import FEATURES

EVENTS = """
ev AS (
  SELECT CAST(o_custkey % 10 AS VARCHAR) AS contig, 'sv' || o_orderkey AS sv_id,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'INS' ELSE 'DEL' END AS sv_type,
         o_orderkey * 50 + o_custkey % 40 AS sv_start,
         o_orderkey * 50 + o_custkey % 40 + CASE WHEN o_orderkey % 3 <> 0 THEN 1 + o_orderkey % 60 ELSE 0 END AS sv_end,
         (CAST(floor(o_totalprice) AS BIGINT) % 500 + 1) * CASE WHEN o_orderkey % 3 <> 0 THEN 1 ELSE -1 END AS sv_len,
         'chr' || o_custkey % 5 AS chrom, o_orderkey * 20 + 1 AS pos1,
         o_orderkey * 20 + 1 + CASE WHEN o_orderkey % 3 <> 0 THEN 0 ELSE 1 + o_orderkey % 60 END AS ref_end1
  FROM orders)
"""
PAIRS = f"""
{FEATURES}, {EVENTS},
pr AS (
  SELECT f.fid, f.contig, f.start0, f.end0, e.* EXCLUDE (contig),
         greatest(0, least(end0, sv_end) - greatest(start0, sv_start)) AS overlap_bp, sv_end - sv_start AS span_bp,
         CASE WHEN sv_type = 'DEL' THEN 'contains_del' WHEN start0 >= sv_start AND end0 <= sv_end THEN 'inside_ins'
              WHEN sv_start >= start0 AND sv_end <= end0 THEN 'contains_ins' ELSE 'partial_ins' END AS class
  FROM feat f JOIN ev e ON f.contig = e.contig
   AND CASE WHEN sv_type = 'DEL' THEN start0 < sv_start AND sv_start < end0 ELSE sv_start < end0 AND start0 < sv_end END)
"""
MECHANISM = """CASE WHEN bool_or(sv_type = 'INS') AND bool_or(sv_type = 'DEL') THEN 'INS+DEL' WHEN bool_or(class = 'inside_ins') THEN 'INS-internal'
              WHEN bool_or(class = 'partial_ins') THEN 'INS-junction' WHEN bool_or(class = 'contains_ins') THEN 'INS-spanning'
              WHEN bool_or(class = 'contains_del') THEN 'DEL-junction' ELSE 'non-SV' END"""


@query("j01_event_pairs", f"""
WITH {PAIRS}
SELECT fid, sv_id, sv_type, class, overlap_bp, overlap_bp / greatest(1, end0 - start0) AS fraction_feature,
       CASE WHEN span_bp > 0 THEN overlap_bp / span_bp END AS fraction_sv FROM pr""")
def event_pairs(spark, d):
    return b.event_pairs(spark, d).select("fid", "sv_id", "sv_type", "class", "overlap_bp", "fraction_feature", "fraction_sv")


@query("p30_mechanisms", f"""
WITH {PAIRS},
s AS (SELECT f.fid, count(sv_id) AS sv_n, count(*) FILTER (sv_type = 'INS') AS ins_n, {MECHANISM} AS mechanism_class
      FROM feat f LEFT JOIN pr USING (fid) GROUP BY f.fid)
SELECT fid, sv_n, ins_n, mechanism_class, CASE WHEN mechanism_class = 'non-SV' THEN 'non-SV' ELSE 'SV-related' END AS mechanism_group,
       'evaluated_supplied_ins_del' AS mechanism_status FROM s""")
def mechanisms(spark, d):
    feats = materialize(b.features(spark, d), "features")
    full = ov.with_event_summary(feats, ov.summarize_pairs(b.event_pairs(spark, d, feats)))
    m = iv.mechanism(F.lit("sample"), F.col("sv_n"), F.col("mechanism_class"))
    return full.select("fid", "sv_n", "ins_n", m.alias("m")).select(
        "fid", "sv_n", "ins_n", "m.mechanism_class", "m.mechanism_group", "m.mechanism_status"
    )


@query("a23_mechanism_counts", f"""
WITH {PAIRS}, s AS (SELECT f.fid, f.contig, {MECHANISM} AS mechanism_class FROM feat f LEFT JOIN pr USING (fid) GROUP BY f.fid, f.contig)
SELECT contig, mechanism_class, count(*) AS n FROM s GROUP BY 1, 2""")
def mechanism_counts(spark, d):
    feats = materialize(b.features(spark, d), "features")
    full = ov.with_event_summary(feats, ov.summarize_pairs(b.event_pairs(spark, d, feats)))
    return full.groupBy("contig", "mechanism_class").agg(F.count(F.lit(1)).alias("n"))


@query("p26_overlap_and_gap", f"""
WITH {PAIRS}
SELECT fid, sv_id, overlap_bp AS overlap0, greatest(0, least(end0, ref_end1) - greatest(start0 + 1, pos1) + 1) AS overlap1,
       CASE WHEN end0 < pos1 THEN pos1 - end0 - 1 WHEN ref_end1 < start0 + 1 THEN start0 - ref_end1 ELSE 0 END AS gap1 FROM pr""")
def overlap_and_gap(spark, d):
    c = F.col
    return b.event_pairs(spark, d).select(
        "fid", "sv_id", iv.overlap0(c("start0"), c("end0"), c("sv_start"), c("sv_end")).alias("overlap0"),
        iv.overlap1(c("start0") + 1, c("end0"), c("pos1"), c("ref_end1")).alias("overlap1"),
        iv.gap1(c("start0") + 1, c("end0"), c("pos1"), c("ref_end1")).cast("long").alias("gap1"),
    )


@query("p31_insertion_envelopes", f"""
WITH {PAIRS}
SELECT f.fid, coalesce(least(f.start0, min(sv_start)), f.start0) AS env_start0, coalesce(greatest(f.end0, max(sv_end)), f.end0) AS env_end0,
       count(sv_id) AS used_n FROM feat f LEFT JOIN (SELECT * FROM pr WHERE sv_type = 'INS') p USING (fid) GROUP BY f.fid, f.start0, f.end0""")
def insertion_envelopes(spark, d):
    c = F.col
    feats = materialize(b.features(spark, d), "features")
    ins = b.event_pairs(spark, d, feats, "INS").groupBy("fid").agg(
        F.min("sv_start").alias("lo"), F.max("sv_end").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return feats.join(ins, "fid", "left").select(
        "fid", F.least(c("start0"), F.coalesce("lo", "start0")).alias("env_start0"),
        F.greatest(c("end0"), F.coalesce("hi", "end0")).alias("env_end0"), F.coalesce("n", F.lit(0)).cast("long").alias("used_n"),
    )


@query("p39_folded_details", f"""
WITH {PAIRS}, o AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY overlap_bp DESC, abs(sv_len) DESC, span_bp DESC, sv_id) AS rn FROM pr)
SELECT fid, count(*) AS sv_overlap_n, string_agg(sv_id, ';' ORDER BY rn) AS sv_overlap_ids, string_agg(sv_type, ';' ORDER BY rn) AS sv_overlap_types,
       string_agg(class, ';' ORDER BY rn) AS sv_overlap_classes, string_agg(chrom || ':' || pos1, ';' ORDER BY rn) AS sv_overlap_primary_sites,
       string_agg(chrom || ':' || pos1 || '-' || ref_end1, ';' ORDER BY rn) AS sv_overlap_primary_intervals,
       string_agg(CAST(overlap_bp AS VARCHAR), ';' ORDER BY rn) AS sv_overlap_bp FROM o GROUP BY fid""")
def folded_details(spark, d):
    return ov.fold_pairs(b.event_pairs(spark, d)).drop("sv_overlap_pct_feature", "sv_overlap_pct_sv")


@query("p41_best_events", f"""
WITH {PAIRS}
SELECT fid, arg_max(sv_id, (overlap_bp, abs(sv_len), sv_id)) FILTER (sv_type = 'INS') AS best_ins,
       arg_max(sv_id, (overlap_bp, abs(sv_len), sv_id)) FILTER (sv_type = 'DEL') AS best_del,
       arg_max(sv_id, (abs(sv_len), overlap_bp, span_bp, sv_id)) FILTER (sv_type = 'INS') AS longest_ins,
       max(abs(sv_len)) FILTER (sv_type = 'INS') AS longest_len,
       CASE WHEN bool_or(class = 'inside_ins') THEN 'inside_ins' WHEN bool_or(class = 'partial_ins') THEN 'partial_ins'
            WHEN bool_or(class = 'contains_ins') THEN 'contains_ins' ELSE 'outside_ins' END AS ins_class
FROM pr GROUP BY fid""")
def best_events(spark, d):
    s = ov.summarize_pairs(b.event_pairs(spark, d))
    return s.select(
        "fid", F.col("best_ins.sv_id").alias("best_ins"), F.col("best_del.sv_id").alias("best_del"),
        F.col("longest_ins.sv_id").alias("longest_ins"), F.col("longest_ins.length").alias("longest_len"),
        iv.insertion_class(F.col("has_inside"), F.col("has_partial"), F.col("has_contains")).alias("ins_class"),
    )


@query("s09_event_index", f"""
WITH {EVENTS}
SELECT contig, sv_id, sv_start, sv_end, row_number() OVER w AS ordinal, max(sv_end) OVER w AS max_end FROM ev
WINDOW w AS (PARTITION BY contig ORDER BY sv_start, sv_end, sv_id, sv_type ROWS UNBOUNDED PRECEDING)""")
def event_index(spark, d):
    return src.event_index(b.events(spark, d)).select("contig", "sv_id", "sv_start", "sv_end", "ordinal", "max_end")


HITS = """
hit AS (
  SELECT 'f' || l_orderkey AS fid, round(1.0 - l_discount, 2) AS identity, CAST(floor(l_quantity) AS BIGINT) / 50.0 AS coverage,
         CAST(floor(l_quantity) AS BIGINT) AS aligned_bp, CAST(l_linenumber AS BIGINT) AS block_n, CAST(floor(l_quantity) AS BIGINT) + 1 AS span_bp,
         'chr' || l_partkey % 5 AS chrom, l_partkey * 150 + CAST(l_linenumber AS BIGINT) * 11 AS start0,
         l_partkey * 150 + CAST(l_linenumber AS BIGINT) * 11 + CAST(floor(l_quantity) AS BIGINT) + 1 AS end0,
         CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand FROM lineitem)
"""
RESOLVED = f"""
{HITS},
rk AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY identity DESC, coverage DESC, aligned_bp DESC, block_n, span_bp, chrom DESC, start0, end0, strand DESC) AS rn,
              count(*) OVER (PARTITION BY fid) AS hit_n FROM hit),
nx AS (SELECT *, lead(identity) OVER o AS i2, lead(coverage) OVER o AS c2, lead(aligned_bp) OVER o AS a2 FROM rk WINDOW o AS (PARTITION BY fid ORDER BY rn)),
two AS (SELECT * FROM nx WHERE rn = 1),
lab AS (SELECT *, CASE WHEN i2 IS NOT NULL AND abs(identity - i2) <= 0.001 AND abs(coverage - c2) <= 0.01 AND abs(aligned_bp - a2) <= 10 THEN 'ambiguous_tie'
                       WHEN coverage < 0.5 THEN 'low_quality' WHEN hit_n = 1 THEN 'unique' ELSE 'multi_clear_primary' END AS label FROM two),
res AS (SELECT fid, label, hit_n, identity, coverage, aligned_bp, span_bp, block_n,
               CASE WHEN label IN ('unique', 'multi_clear_primary') THEN chrom END AS chrom,
               CASE WHEN label IN ('unique', 'multi_clear_primary') THEN start0 END AS start0,
               CASE WHEN label IN ('unique', 'multi_clear_primary') THEN end0 END AS end0 FROM lab)
"""


@query("a01_resolve_hits", f"WITH {RESOLVED} SELECT * FROM res")
def resolve_hits(spark, d):
    return h.resolve_hits(b.hits(spark, d)).drop("strand")


@query("t01_ranked_hits", f"""
WITH {HITS} SELECT fid, chrom, start0, end0, aligned_bp, row_number() OVER (PARTITION BY fid ORDER BY identity DESC, coverage DESC, aligned_bp DESC, block_n, span_bp, chrom DESC, start0, end0) AS rank FROM hit""")
def ranked_hits(spark, d):
    return h.ranked_hits(b.hits(spark, d)).select("fid", "chrom", "start0", "end0", "aligned_bp", "rank")


@query("p21_hit_usability", f"""
WITH {RESOLVED}
SELECT fid, coalesce(label = 'unique' AND chrom <> '', FALSE) AS for_reference,
       coalesce(label = 'unique' AND chrom <> '' AND round(coverage, 6) >= 0.5, FALSE) AS for_novel FROM res""")
def hit_usability(spark, d):
    c = F.col
    at = (c("label"), c("chrom"), c("start0") + 1, c("end0"))
    return h.resolve_hits(b.hits(spark, d)).select(
        "fid", sc.hit_usable_for_reference(*at).alias("for_reference"), sc.hit_usable_for_novel(*at, c("coverage"), 0.5).alias("for_novel")
    )


SUMMARY = f"""
{PAIRS}, {RESOLVED},
fo AS (SELECT DISTINCT l_orderkey, 'f' || l_orderkey AS hid FROM lineitem),
sm AS (SELECT 'f' || CAST(floor(start0 / 50) AS BIGINT) AS hid, bool_or(sv_type = 'INS') AS has_ins FROM pr GROUP BY 1)
"""


@query("p23_admission", f"""
WITH {SUMMARY},
j AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'no_hal' ELSE coalesce(label, 'no_hal') END AS label, coalesce(has_ins, FALSE) AS has_ins
      FROM orders LEFT JOIN res ON res.fid = 'f' || o_orderkey LEFT JOIN sm ON sm.hid = 'f' || o_orderkey)
SELECT label, has_ins, has_ins OR label = 'unique' AS admit,
       CASE WHEN has_ins THEN CASE label WHEN 'unique' THEN 'hal_unique_cov_ge_0.5_with_ins' WHEN 'multi_clear_primary' THEN 'sv_ins_primary_hal_multimap'
            WHEN 'ambiguous_tie' THEN 'sv_ins_primary_hal_ambiguous' WHEN 'low_quality' THEN 'sv_ins_primary_hal_cov_lt_0.5' ELSE 'sv_ins_primary_no_hal' END
            WHEN label = 'unique' THEN 'hal_unique_cov_ge_0.5' ELSE '' END AS rule,
       CASE WHEN has_ins OR label = 'unique' THEN '' ELSE CASE label WHEN 'multi_clear_primary' THEN 'hal_multimap_no_ins' WHEN 'ambiguous_tie' THEN 'hal_ambiguous_no_ins'
            WHEN 'low_quality' THEN 'hal_cov_lt_0.5_no_ins' ELSE 'no_hal_no_ins' END END AS reason,
       count(*) AS n FROM j GROUP BY ALL""")
def admission(spark, d):
    c = F.col
    with_ins = b.event_pairs(spark, d).groupBy(
        F.concat(F.lit("f"), F.floor(c("start0") / 50).cast("string")).alias("fid")
    ).agg(F.bool_or(c("sv_type") == "INS").alias("has_ins"))
    orders = b.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("f"), c("o_orderkey").cast("string")).alias("fid"))
    joined = orders.join(h.resolve_hits(b.hits(spark, d)).select("fid", "label"), "fid", "left").join(with_ins, "fid", "left")
    label = F.when(c("o_orderkey") % 5 == 0, "no_hal").otherwise(F.coalesce("label", F.lit("no_hal")))
    keyed = joined.select(label.alias("label"), F.coalesce("has_ins", F.lit(False)).alias("has_ins"))
    counted = keyed.groupBy("label", "has_ins").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("a", sc.admission(c("label"), c("has_ins"))).select("label", "has_ins", "a.admit", "a.rule", "a.reason", "n")


@query("p40_projections", f"""
WITH {RESOLVED},
f AS (SELECT o_orderkey, 'f' || o_orderkey AS fid, o_orderkey % 50 = 0 AS p FROM orders)
SELECT f.fid, CASE WHEN p THEN 'self_primary' ELSE coalesce(label, 'no_hal') END AS label, CASE WHEN p THEN 1 ELSE coalesce(hit_n, 0) END AS hit_n,
       CASE WHEN p THEN 'chrS' ELSE chrom END AS chrom, CASE WHEN p THEN o_orderkey * 10 ELSE start0 END AS start0,
       CASE WHEN p THEN o_orderkey * 10 + 7 ELSE end0 END AS end0 FROM f LEFT JOIN res ON res.fid = f.fid""")
def projections(spark, d):
    c = F.col
    feats = b.table(spark, d, "orders").select(
        F.concat(F.lit("f"), c("o_orderkey").cast("string")).alias("fid"),
        F.when(c("o_orderkey") % 50 == 0, "reference_primary").otherwise("assembly").alias("kind"), F.lit("chrS").alias("contig"),
        (c("o_orderkey") * 10).alias("start0"), (c("o_orderkey") * 10 + 7).alias("end0"),
    )
    return h.hits_for_features(feats, h.resolve_hits(b.hits(spark, d))).select("fid", "label", "hit_n", "chrom", "start0", "end0")


@query("k13_projection_report", f"""
WITH {HITS}, f AS (SELECT o_orderpriority AS label, 'f' || o_orderkey AS fid FROM orders), n AS (SELECT fid, count(*) AS n FROM hit GROUP BY 1)
SELECT label, count(*) AS input_intervals, CAST(sum(coalesce(n, 0)) AS BIGINT) AS psl_records, count(*) FILTER (coalesce(n, 0) > 0) AS mapped_ids,
       count(*) FILTER (coalesce(n, 0) = 0) AS unmapped_ids, count(*) FILTER (coalesce(n, 0) > 1) AS multimap_ids FROM f LEFT JOIN n USING (fid) GROUP BY label""")
def projection_report(spark, d):
    feats = b.table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("label"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("fid")
    )
    return h.projection_report(feats, b.hits(spark, d))[0]


REFERENCES = """
ref AS (SELECT 'chr' || p_partkey % 5 AS chrom, p_partkey * 150 + 1 AS ref_start1, p_partkey * 150 + 21 + p_size * 4 AS ref_end1,
               'R#0#chr' || p_partkey % 5 || ':' || (p_partkey * 150) || '-' || (p_partkey * 150 + 21 + p_size * 4) AS ref_fid FROM part)
"""


def _best_sql(source: str) -> str:
    return f"""
c AS (SELECT q.fid, ref_fid, least(q.end1, ref_end1) - greatest(q.start1, ref_start1) + 1 AS ov, q.end1 - q.start1 + 1 AS ql, ref_end1 - ref_start1 + 1 AS rl
      FROM {source} q JOIN ref ON q.chrom = ref.chrom AND q.start1 <= ref_end1 AND ref_start1 <= q.end1),
k AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY ov DESC, ov / least(ql, rl) DESC, least(ql, rl) / greatest(ql, rl) DESC, rl, ref_fid DESC) AS rn,
             count(*) OVER (PARTITION BY fid) AS candidate_n FROM c)
SELECT a.fid, a.ref_fid AS best_ref_fid, a.ov AS best_overlap_bp, a.ov / least(a.ql, a.rl) AS best_ro, least(a.ql, a.rl) / greatest(a.ql, a.rl) AS best_size_ratio,
       s.ref_fid AS second_ref_fid, s.ov AS second_overlap_bp, s.ov / least(s.ql, s.rl) AS second_ro, least(s.ql, s.rl) / greatest(s.ql, s.rl) AS second_size_ratio,
       a.candidate_n FROM (SELECT * FROM k WHERE rn = 1) a LEFT JOIN (SELECT * FROM k WHERE rn = 2) s USING (fid)"""


SPANS = "sp AS (SELECT 'o' || o_orderkey AS fid, 'chr' || o_custkey % 5 AS chrom, o_orderkey * 20 + 1 AS start1, o_orderkey * 20 + 1 + o_custkey % 400 AS end1 FROM orders)"


def _spans(spark, d):
    c = F.col
    start = (c("o_orderkey") * 20 + 1).cast("long")
    return b.table(spark, d, "orders").select(
        F.concat(F.lit("o"), c("o_orderkey").cast("string")).alias("fid"), F.concat(F.lit("chr"), b.text("o_custkey % 5")).alias("chrom"),
        start.alias("start1"), (start + c("o_custkey") % 400).cast("long").alias("end1"),
    )


@query("j06_reference_overlaps", f"""
WITH {SPANS}, {REFERENCES}
SELECT fid, ref_fid FROM sp JOIN ref ON sp.chrom = ref.chrom AND start1 <= ref_end1 AND ref_start1 <= end1""")
def reference_overlaps(spark, d):
    return rf.reference_overlaps(_spans(spark, d), b.references(spark, d)).select("fid", "ref_fid")


@query("j08_best_reference", f"WITH {SPANS}, {REFERENCES}, {_best_sql('sp')}")
def best_reference(spark, d):
    return rf.best_reference(_spans(spark, d), b.references(spark, d))


@query("j09_best_reference_by_hit", f"""
WITH {RESOLVED}, {REFERENCES}, q AS (SELECT fid, chrom, start0 + 1 AS start1, end0 AS end1 FROM res WHERE label = 'unique'), {_best_sql('q')}""")
def best_reference_by_hit(spark, d):
    resolved = h.resolve_hits(b.hits(spark, d)).filter("label = 'unique'")
    return rf.best_reference(resolved.select("fid", "chrom", (F.col("start0") + 1).alias("start1"), F.col("end0").alias("end1")), b.references(spark, d))


BY_INSERTION = f"""
{PAIRS}, {REFERENCES},
m AS (SELECT p.*, ref_fid, least(pos1 - ref_start1, ref.ref_end1 - pos1) AS margin, ref.ref_end1 - ref_start1 + 1 AS rl
      FROM pr p JOIN ref ON p.chrom = ref.chrom AND p.pos1 BETWEEN ref_start1 AND ref.ref_end1 WHERE p.sv_type = 'INS'),
mk AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY abs(sv_len) DESC, overlap_bp DESC, span_bp DESC, sv_id DESC, margin DESC, rl, ref_fid DESC) AS rn FROM m),
bi AS (SELECT a.fid, a.ref_fid AS best_ref_fid, CASE WHEN s.sv_id = a.sv_id THEN s.ref_fid END AS second_ref_fid, a.sv_id AS reference_ins_id, a.pos1 AS insert_site1, n.candidate_n
       FROM (SELECT * FROM mk WHERE rn = 1) a LEFT JOIN (SELECT * FROM mk WHERE rn = 2) s USING (fid)
       JOIN (SELECT fid, count(DISTINCT ref_fid) AS candidate_n, string_agg(DISTINCT ref_fid, ';' ORDER BY ref_fid) AS matched FROM m GROUP BY fid) n USING (fid))
"""


@query("j10_best_reference_by_insertion", f"WITH {BY_INSERTION} SELECT * FROM bi")
def best_reference_by_insertion(spark, d):
    ins = b.event_pairs(spark, d, kind="INS").select("fid", "chrom", "pos1", "sv_id", "sv_len", "overlap_bp", "span_bp")
    return rf.best_reference_by_insertion(ins, b.references(spark, d)).drop("matched_refs")


@query("c08_associate", f"""
WITH {BY_INSERTION}, {HITS},
q AS (SELECT fid, 'chr' || CAST(contig AS INT) % 5 AS chrom, start0 % 300000 + 1 AS start1, end0 % 300000 + 40 AS end1 FROM feat WHERE end0 % 300000 + 40 > start0 % 300000 + 1),
h AS (WITH {_best_sql('q')}),
x AS (SELECT f.fid, f.start0 % 700 = 0 AS p, bi.best_ref_fid AS ir, bi.candidate_n AS inn, h.best_ref_fid AS hr, h.candidate_n AS hn, bi.reference_ins_id AS rid
      FROM feat f LEFT JOIN bi USING (fid) LEFT JOIN h USING (fid))
SELECT fid, CASE WHEN p THEN 'REF::' || fid WHEN ir IS NOT NULL THEN 'REF::' || ir WHEN hr IS NOT NULL THEN 'REF::' || hr ELSE 'NR::' || fid END AS anchor_key,
       CASE WHEN p THEN 'self_primary_ref' WHEN inn = 1 THEN 'sv_insert_ref_overlap' WHEN ir IS NOT NULL THEN 'sv_insert_multi_ref_best'
            WHEN hn = 1 THEN 'hal_ref_overlap' WHEN hr IS NOT NULL THEN 'hal_multi_ref_best' ELSE 'no_primary_ref_overlap' END AS anchor_assign_rule,
       CASE WHEN p THEN 'self_ref' WHEN inn = 1 THEN 'sv_insert_ref' WHEN ir IS NOT NULL THEN 'sv_insert_ref_ambiguous'
            WHEN hn = 1 THEN 'hal_ref' WHEN hr IS NOT NULL THEN 'hal_ref_ambiguous' ELSE 'nonref' END AS anchor_confidence,
       CASE WHEN p THEN 1 WHEN ir IS NOT NULL THEN inn ELSE coalesce(hn, 0) END AS ref_overlap_n,
       CASE WHEN NOT p AND ir IS NOT NULL THEN rid ELSE '' END AS reference_ins_id FROM x""")
def associate(spark, d):
    c = F.col
    refs = b.references(spark, d)
    feats = materialize(b.features(spark, d), "features")
    ins = b.event_pairs(spark, d, feats, "INS").select("fid", "chrom", "pos1", "sv_id", "sv_len", "overlap_bp", "span_bp")
    spans = feats.select(
        "fid", F.concat(F.lit("chr"), (c("contig").cast("int") % 5).cast("string")).alias("chrom"),
        (c("start0") % 300000 + 1).alias("start1"), (c("end0") % 300000 + 40).alias("end1"),
    ).filter("end1 > start1")
    kinds = feats.select("fid", F.when(c("start0") % 700 == 0, "reference_primary").otherwise("assembly").alias("kind"))
    seeds = feats.select("fid", F.lit(None).cast("long").alias("seed_locus_id")).filter("false")
    out = rf.associate(kinds, rf.best_reference_by_insertion(ins, refs), rf.best_reference(spans, refs), seeds)
    return out.select("fid", "anchor_key", "anchor_assign_rule", "anchor_confidence", "ref_overlap_n", "reference_ins_id")


@query("p42_site_seeds", f"""
WITH {PAIRS}, {RESOLVED},
s AS (SELECT 'f' || CAST(floor(start0 / 50) AS BIGINT) AS hid, arg_max((chrom, pos1, ref_end1), (overlap_bp, abs(sv_len), sv_id)) FILTER (sv_type = 'INS') AS bi,
             bool_or(sv_type = 'DEL') AS has_del FROM pr GROUP BY 1),
j AS (SELECT fid, bi, coalesce(has_del, FALSE) AS has_del, label = 'unique' AND round(coverage, 6) >= 0.5 AS ok, chrom, start0 + 1 AS start1, end0 AS end1 FROM res LEFT JOIN s ON s.hid = res.fid)
SELECT fid, CASE WHEN bi IS NOT NULL AND ok THEN 'sv+hal' WHEN bi IS NOT NULL THEN 'sv_only' WHEN has_del THEN 'sv+hal' ELSE 'hal_only' END AS source,
       CASE WHEN bi IS NOT NULL THEN bi[1] ELSE chrom END AS chrom, CASE WHEN bi IS NOT NULL THEN bi[2] ELSE start1 END AS start1,
       CASE WHEN bi IS NOT NULL THEN bi[3] ELSE end1 END AS end1 FROM j WHERE bi IS NOT NULL OR ok""")
def site_seeds(spark, d):
    c = F.col
    key = F.concat(F.lit("f"), F.floor(c("start0") / 50).cast("string"))
    summary = ov.summarize_pairs(b.event_pairs(spark, d).withColumn("fid", key))
    joined = h.resolve_hits(b.hits(spark, d)).join(summary, "fid", "left")
    seed = st.site_seed(c("best_ins"), c("best_del"), c("label"), c("chrom"), c("start0") + 1, c("end0"), c("coverage"), 0.5)
    return joined.select("fid", seed.alias("s")).filter("s is not null").select("fid", "s.source", "s.chrom", "s.start1", "s.end1")


SITES = """
si AS (SELECT event_type AS chrom, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS start1, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) + user_id % 30 AS end1,
              event_id AS ordinal, CASE WHEN value > 20 THEN 'sv_only' ELSE 'hal_only' END AS source FROM events),
mx AS (SELECT *, max(end1) OVER (PARTITION BY chrom ORDER BY start1, end1, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM si),
il AS (SELECT *, sum(CASE WHEN pe IS NULL OR start1 > pe + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start1, end1, ordinal ROWS UNBOUNDED PRECEDING) AS isl FROM mx),
cl AS (SELECT chrom, isl, min(start1) AS low, max(end1) AS high, min(ordinal) AS first, count(*) AS cluster_n FROM il GROUP BY 1, 2),
sr AS (SELECT chrom, isl, arg_max(source, (n, -f)) AS cluster_source FROM (SELECT chrom, isl, source, count(*) AS n, min(ordinal) AS f FROM il GROUP BY 1, 2, 3) GROUP BY 1, 2),
nm AS (SELECT *, row_number() OVER (ORDER BY chrom, low, high, first) AS cluster_ord FROM cl JOIN sr USING (chrom, isl))
"""


@query("c09_site_clusters", f"""
WITH {SITES}
SELECT ordinal, cluster_ord, cluster_n, low, high, cluster_source, 'NRSITE::' || chrom || '::' || cluster_ord AS anchor_key,
       CASE WHEN cluster_n > 1 THEN 'nonref_projected_site_cluster' ELSE 'nonref_projected_site_single' END AS anchor_assign_rule
FROM il JOIN nm USING (chrom, isl)""")
def site_clusters(spark, d):
    out = st.cluster_sites(b.sites(spark, d), 100)
    return out.select("ordinal", "cluster_ord", "cluster_n", "low", "high", "cluster_source", "anchor_key", "anchor_assign_rule")


@query("c11_locus_numbers", f"""
WITH {SITES},
k AS (SELECT 'REF::part' || p_partkey AS anchor_key, 0 AS g, 'chr' || p_partkey % 5 AS c, p_partkey * 150 + 1 AS s, p_partkey * 150 + 21 AS e, 0 AS o, 'part' || p_partkey AS t FROM part
      UNION ALL SELECT 'NRSITE::' || chrom || '::' || cluster_ord, 1, chrom, low, high, cluster_ord, '' FROM nm
      UNION ALL SELECT 'NR::' || c_custkey, 2, '0', c_custkey, 0, 0, CAST(c_custkey AS VARCHAR) FROM customer
      UNION ALL SELECT 'NR::S' || s_suppkey, 2, '1', 0, 0, 0, 'S' || s_suppkey FROM supplier)
SELECT anchor_key, row_number() OVER (ORDER BY g, c, s, e, o, t, anchor_key) AS locus_id FROM k""")
def locus_numbers(spark, d):
    c = F.col
    blank = [F.lit(None).cast(t).alias(n) for n, t in (("chrom", "string"), ("start1", "long"), ("end1", "long"))]
    start = (c("p_partkey") * 150 + 1).cast("long")
    refs = b.table(spark, d, "part").select(
        F.concat(F.lit("REF::part"), c("p_partkey").cast("string")).alias("anchor_key"),
        F.concat(F.lit("chr"), b.text("p_partkey % 5")).alias("chrom"), start.alias("start1"), (start + 20).alias("end1"),
    )
    found = st.cluster_sites(b.sites(spark, d), 100).select("anchor_key", "chrom", c("low").alias("start1"), c("high").alias("end1")).distinct()
    seeds = b.table(spark, d, "customer").select(F.concat(F.lit("NR::"), c("c_custkey").cast("string")).alias("anchor_key"), *blank)
    named = b.table(spark, d, "supplier").select(F.concat(F.lit("NR::S"), c("s_suppkey").cast("string")).alias("anchor_key"), *blank)
    return st.number_loci(refs.unionByName(found).unionByName(seeds).unionByName(named)).select("anchor_key", "locus_id")


@query("a04_merge_ranges", f"""
WITH {FEATURES},
m AS (SELECT contig, start0, end0, max(end0) OVER (PARTITION BY contig ORDER BY start0, end0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM feat),
i AS (SELECT *, sum(CASE WHEN pe IS NULL OR start0 > pe THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT contig, min(start0) AS s, max(end0) AS e FROM i GROUP BY contig, g""")
def merge_ranges(spark, d):
    ranges = b.features(spark, d).select("contig", F.col("start0").alias("s"), F.col("end0").alias("e"))
    return g.merge_node_ranges(ranges, ["contig"])


@query("a05_shared_bases", f"""
WITH {FEATURES}, {EVENTS}
SELECT f.contig, CAST(sum(least(end0, sv_end) - greatest(start0, sv_start)) AS BIGINT) AS shared_bp, count(*) AS pairs
FROM feat f JOIN ev e ON f.contig = e.contig AND start0 < sv_end AND sv_start < end0 WHERE sv_type = 'INS' GROUP BY 1""")
def shared_bases(spark, d):
    c = F.col
    ins = b.events(spark, d).filter("sv_type = 'INS'").select("contig", "sv_start", "sv_end")
    pairs = interval_join(b.features(spark, d), ins, ["contig"], ("start0", "end0"), ("sv_start", "sv_end"))
    overlap = iv.overlap0(c("start0"), c("end0"), c("sv_start"), c("sv_end"))
    return pairs.groupBy("contig").agg(F.sum(overlap).alias("shared_bp"), F.count(F.lit(1)).alias("pairs"))


@query("s25_extract_intervals", """
WITH d AS (SELECT doc_id, replace(text, chr(10), '') AS t FROM documents),
n AS (SELECT o_orderkey, o_custkey, o_custkey % (SELECT count(*) FROM documents) AS doc_id, (o_orderkey * 7919) % 20000 AS pos0 FROM orders),
i AS (SELECT o_orderkey, doc_id, pos0 % greatest(1, length(t)) AS lo, pos0 % greatest(1, length(t)) + 1 + o_custkey % 90 AS hi FROM n JOIN d USING (doc_id))
SELECT o_orderkey, substr(t, lo + 1, hi - lo) AS sequence, CAST(greatest(0, least(length(t), hi) - lo) AS BIGINT) AS observed_bp,
       greatest(0, least(length(t), hi) - lo) = hi - lo AS complete FROM i JOIN d USING (doc_id)""")
def extract_intervals(spark, d):
    c = F.col
    docs = b.table(spark, d, "documents")
    lines = docs.select(c("doc_id").cast("string").alias("name"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    from ..operators.scan import ordered_scan

    body = lines.filter("line <> ''").select("name", "line_no", F.col("line").alias("bases"), F.length("line").cast("long").alias("n"))
    placed = ordered_scan(body, ["name"], ["line_no"], {"end0": ("sum", "n")})
    chunks = placed.select("name", (c("end0") - c("n")).alias("start0"), "end0", "bases")
    total = docs.count()
    wanted = b.table(spark, d, "orders").select(
        c("o_orderkey").cast("string").alias("fid"), (c("o_custkey") % total).cast("string").alias("name"),
        (c("o_orderkey") * 7919 % 20000).alias("at"), "o_custkey",
    )
    # Starts are spread over the whole text.
    sizes = docs.select(c("doc_id").cast("string").alias("name"), F.greatest(F.lit(1), F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("size"))
    lo = c("at") % c("size")
    wanted = wanted.join(sizes, "name").select("fid", "name", lo.alias("lo"), (lo + 1 + c("o_custkey") % 90).alias("hi"))
    out = src.extract_intervals(chunks, wanted)
    return out.select(
        c("fid").cast("long").alias("o_orderkey"), "sequence", "observed_bp", (c("observed_bp") == c("hi") - c("lo")).alias("complete")
    )


@query("s24_genome_inventory", """
SELECT n_name AS hal_genome, count(s_suppkey) AS n_sequences, CAST(coalesce(sum(floor(abs(s_acctbal))), 0) AS BIGINT) AS total_sequence_bp,
       CASE WHEN count(s_suppkey) = 0 THEN 'no_sequences' ELSE 'available' END AS sequence_status
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name""")
def genome_inventory(spark, d):
    names = b.table(spark, d, "nation").select(F.col("n_name").alias("hal_genome"), "n_nationkey")
    seqs = b.table(spark, d, "supplier").join(names, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "hal_genome", F.floor(F.abs("s_acctbal")).cast("long").alias("length_bp")
    )
    return src.genome_inventory(seqs, names.select("hal_genome"))
