"""Shingle, similarity, medoid and clustering queries over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import AlleleRules
from ..functions import scalars as sc
from ..operators import align
from ..operators import alleles as al
from ..operators import loci as lo
from ..operators import similarity as sim
from ..session import materialize
from . import bridges as b
from .registry import query

DOCS = """
dw AS (SELECT doc_id, source, lang, text, list_filter(string_split_regex(text, '[ \\n\\t\\r]+'), lambda x: x <> '') AS w FROM documents),
dt AS (SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS fid, doc_id + 1 AS ord, source, lang, text, list_transform(w, lambda x: '>' || x) AS t, w FROM dw),
sp AS (SELECT *, len(t) AS n, least(3, len(t)) AS kk FROM dt),
sx AS (SELECT *, range(n - kk + 1) AS ix FROM sp WHERE n > 0),
sh AS (SELECT *, list_distinct(list_transform(ix, lambda i: 'M:' || array_to_string(t[i + 1 : i + kk], '|'))) AS shingles,
              array_to_string(t[1 : kk], '|') AS la, array_to_string(t[n - kk + 1 : n], '|') AS ra,
              CAST(list_sum(list_transform(list_distinct(w), lambda x: length(x))) AS BIGINT) AS bp FROM sx)
"""
WEIGHTS = f"""
{DOCS},
sl AS (SELECT fid, unnest(shingles) AS shingle FROM sh),
df AS (SELECT shingle, count(*) AS n FROM sl GROUP BY 1),
wt AS (SELECT shingle, n, ln(((SELECT count(*) FROM sh) + 1.0) / (n + 1.0)) + 1.0 AS weight FROM df),
fw AS (SELECT fid, shingle, weight FROM sl JOIN wt USING (shingle))
"""
LEADERS = f"""
{WEIGHTS},
an AS (SELECT fid, ord, unnest(list_distinct(list_concat(['L:' || la, 'R:' || ra], shingles))) AS anchor FROM sh),
ld AS (SELECT anchor, min(ord) AS lo, arg_min(fid, ord) AS leader FROM an GROUP BY 1),
pa AS (SELECT DISTINCT fid AS a, leader AS b FROM an JOIN ld USING (anchor) WHERE lo < ord)
"""
MEASURES = f"""
{LEADERS},
it AS (SELECT a, b, sum(x.weight) AS i FROM pa JOIN fw x ON x.fid = a JOIN fw y ON y.fid = b AND y.shingle = x.shingle GROUP BY 1, 2),
tw AS (SELECT fid, sum(weight) AS w FROM fw GROUP BY 1),
cx AS (SELECT pa.a, pa.b, round(coalesce(i, 0) / (p.w + q.w - coalesce(i, 0)), 12) AS ctx FROM pa LEFT JOIN it USING (a, b) JOIN tw p ON p.fid = pa.a JOIN tw q ON q.fid = pa.b),
nd AS (SELECT fid, unnest(list_distinct(w)) AS node FROM sh),
sb AS (SELECT a, b, CAST(sum(length(x.node)) AS BIGINT) AS shared_bp FROM pa JOIN nd x ON x.fid = a JOIN nd y ON y.fid = b AND y.node = x.node GROUP BY 1, 2),
me AS (SELECT a, b, coalesce(shared_bp, 0) AS shared_bp, least(coalesce(shared_bp, 0) / p.bp, coalesce(shared_bp, 0) / q.bp) AS ro, least(p.bp, q.bp) / greatest(p.bp, q.bp) AS size_ratio, ctx,
              CAST(p.la = q.la OR p.ra = q.ra AS INTEGER) AS boundary, p.text AS ta, q.text AS tb
       FROM cx LEFT JOIN sb USING (a, b) JOIN sh p ON p.fid = a JOIN sh q ON q.fid = b)
"""


def _docs(spark, d, *columns):
    """Features with anchors, written with the given columns only: each list of windows takes several times the text."""
    return materialize(sim.with_anchors(b.doc_features(spark, d)).select(*columns), "docs", "zstd")


def _paired(spark, d, *columns):
    """Documents, and their pairs with anchor leaders; the anchors are not written but put together from ends and windows."""
    docs = _docs(spark, d, "fid", "ord", "left_anchor", "right_anchor", "shingles", *columns)
    return docs, materialize(sim.anchor_leaders(docs.select("fid", "ord", sim.anchor_list().alias("anchors"))), "pairs")


@query("p32_spaced_shingles", f"""
WITH {DOCS} SELECT fid, sha256(array_to_string(list_sort(shingles), '#')) AS shingles, sha256(la) AS left_anchor, sha256(ra) AS right_anchor, CAST(n AS BIGINT) AS n, bp FROM sh""")
def spaced_shingles(spark, d):
    docs = sim.with_anchors(b.doc_features(spark, d))
    return docs.select(
        "fid", F.sha2(F.array_join(F.array_sort("shingles"), "#"), 256).alias("shingles"), F.sha2("left_anchor", 256).alias("left_anchor"),
        F.sha2("right_anchor", 256).alias("right_anchor"), F.size("tokens").cast("long").alias("n"), "bp",
    )


@query("p36_kmer_sets", """
SELECT doc_id, CAST(CASE WHEN length(text) = 0 THEN 0 WHEN length(text) < 9 THEN 1 ELSE len(list_distinct(list_transform(range(1, length(text) - 7), lambda i: substr(text, i, 9)))) END AS BIGINT) AS kmers
FROM documents""")
def kmer_sets(spark, d):
    return b.table(spark, d, "documents").select("doc_id", F.size(sc.kmers(F.col("text"), 9)).cast("long").alias("kmers"))


@query("c02_kmer_similarity", """
WITH t AS (SELECT a.conv_id, a.turn, list_distinct(list_transform(range(1, length(a.text) - 7), lambda i: substr(a.text, i, 9))) AS x,
                  list_distinct(list_transform(range(1, length(b.text) - 7), lambda i: substr(b.text, i, 9))) AS y, length(a.text) AS n, length(b.text) AS m, a.text AS p, b.text AS q
           FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn),
u AS (SELECT conv_id, turn, CASE WHEN n < 9 THEN [p] ELSE x END AS x, CASE WHEN m < 9 THEN [q] ELSE y END AS y, n, m FROM t)
SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE WHEN n > 0 AND m > 0 THEN len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))) END AS similarity FROM u""")
def kmer_similarity(spark, d):
    return b.turns(spark, d).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), sim.kmer_similarity(F.col("text_a"), F.col("text_b"), 9).alias("similarity")
    )


@query("a02_shingle_weights", f"WITH {WEIGHTS} SELECT sha256(shingle) AS shingle, n, weight FROM wt")
def shingle_weights(spark, d):
    docs = sim.with_anchors(b.doc_features(spark, d)).select("fid", "shingles")
    weights = sim.shingle_weights(sim.shingle_frequencies(docs), b.doc_features(spark, d).filter(F.size("tokens") > 0).count())
    return weights.select(F.sha2("shingle", 256).alias("shingle"), "n", "weight")


@query("a03_weighted_shingles", f"WITH {WEIGHTS} SELECT fid, count(*) AS n, round(sum(weight), 6) AS total FROM fw GROUP BY 1")
def weighted_shingles(spark, d):
    long = sim.weighted_shingles(_docs(spark, d, "fid", "shingles"))
    return long.groupBy("fid").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 6).alias("total"))


@query("j11_anchor_leaders", f"WITH {LEADERS} SELECT * FROM pa")
def anchor_leaders(spark, d):
    return sim.anchor_leaders(_docs(spark, d, "fid", "ord", "anchors"))


@query("c01_context_similarity", f"WITH {MEASURES} SELECT a, b, round(ctx, 6) AS ctx FROM me")
def context_similarity(spark, d):
    docs, pairs = _paired(spark, d)
    ctx = sim.pair_context(pairs, materialize(sim.weighted_shingles(docs), "weighted", "zstd"))
    return ctx.select("a", "b", F.round("ctx", 6).alias("ctx"))


@query("a06_shared_bases", f"WITH {MEASURES} SELECT a, b, shared_bp FROM me")
def shared_bases(spark, d):
    _, pairs = _paired(spark, d)
    return sim.pair_shared_bp(pairs, b.doc_nodes(b.doc_features(spark, d)))


def _measures(spark, d):
    docs, pairs = _paired(spark, d, "bp")
    shingles = materialize(sim.weighted_shingles(docs), "weighted", "zstd")
    return sim.pair_measures(pairs, docs, shingles, b.doc_nodes(b.doc_features(spark, d)))


@query("c04_graph_scores", f"""
WITH {MEASURES} SELECT a, b, round(ro, 9) AS ro, round(size_ratio, 9) AS size_ratio, boundary, round(ro * 4.0 + ctx * 2.0 + size_ratio + boundary * 0.25, 6) AS score FROM me""")
def graph_scores(spark, d):
    scored = sim.graph_score(_measures(spark, d))
    return scored.select(
        "a", "b", F.round("ro", 9).alias("ro"), F.round("size_ratio", 9).alias("size_ratio"), "boundary", F.round("score", 6).alias("score")
    )


@query("c03_match_rules", f"""
WITH {MEASURES},
tr AS (SELECT *, CASE WHEN ro >= 0.95 AND size_ratio >= 0.95 AND ctx >= 0.80 THEN 3 WHEN ro >= 0.50 AND ctx >= 0.30 THEN 2
                      WHEN ro >= 0.20 AND size_ratio >= 0.67 AND (ctx >= 0.50 OR boundary = 1) THEN 1 ELSE 0 END AS r0 FROM me),
kq AS (SELECT *, CASE WHEN r0 = 1 THEN list_distinct(list_transform(range(1, length(ta) - 7), lambda i: substr(ta, i, 9))) END AS ka,
                 CASE WHEN r0 = 1 THEN list_distinct(list_transform(range(1, length(tb) - 7), lambda i: substr(tb, i, 9))) END AS kb FROM tr),
ws AS (SELECT *, CASE WHEN r0 = 1 THEN len(list_intersect(ka, kb)) / (len(ka) + len(kb) - len(list_intersect(ka, kb))) END AS weak FROM kq),
rk AS (SELECT *, CASE WHEN r0 = 1 AND weak < 0.25 THEN 0 ELSE r0 END AS rank FROM ws)
SELECT a, b, CASE rank WHEN 3 THEN 'exact_graph' WHEN 2 THEN 'ro_graph' WHEN 1 THEN 'szro_graph' END AS rule, round(weak, 9) AS weak_seq,
       round(rank * 10.0 + ro * 3.0 + ctx * 2.0 + size_ratio + coalesce(weak, 0) * 0.5, 6) AS composite FROM rk""")
def match_rules(spark, d):
    ruled = sim.match_rule(_measures(spark, d), b.doc_features(spark, d).select("fid", "seq"))
    return ruled.select("a", "b", "rule", F.round("weak_seq", 9).alias("weak_seq"), F.round("composite", 6).alias("composite"))


def _members(docs):
    return docs.select(F.col("source").alias("group_id"), "fid", F.col("ord").alias("member_ord"))


KINDS = "CASE WHEN (ord - 1) % 50 = 0 THEN 3 WHEN (ord - 1) % 50 = 1 THEN 2 ELSE 1 END"


@query("c05_source_medoids", f"""
WITH {WEIGHTS},
nd AS (SELECT fid, source, unnest(list_distinct(w)) AS node FROM sh),
cw AS (SELECT fw.*, source FROM fw JOIN sh USING (fid)),
tw AS (SELECT fid, sum(weight) AS w FROM cw GROUP BY 1),
pa AS (SELECT x.fid AS a, y.fid AS b, x.source FROM sh x JOIN sh y ON x.source = y.source AND x.fid <> y.fid),
it AS (SELECT x.fid AS a, y.fid AS b, sum(x.weight) AS i FROM cw x JOIN cw y ON x.source = y.source AND x.shingle = y.shingle AND x.fid <> y.fid GROUP BY 1, 2),
sb AS (SELECT x.fid AS a, y.fid AS b, sum(length(x.node)) AS s FROM nd x JOIN nd y ON x.source = y.source AND x.node = y.node AND x.fid <> y.fid GROUP BY 1, 2),
ps AS (SELECT pa.a, pa.source, least(coalesce(s, 0) / p.bp, coalesce(s, 0) / q.bp) * 4.0 + coalesce(i, 0) / (ta.w + tb.w - coalesce(i, 0)) * 2.0 + least(p.bp, q.bp) / greatest(p.bp, q.bp)
              + CASE WHEN p.la = q.la OR p.ra = q.ra THEN 0.25 ELSE 0 END AS score
       FROM pa JOIN sh p ON p.fid = a JOIN sh q ON q.fid = b JOIN tw ta ON ta.fid = a JOIN tw tb ON tb.fid = b LEFT JOIN it USING (a, b) LEFT JOIN sb USING (a, b)),
tt AS (SELECT fid AS a, sh.source, round(10 + coalesce(sum(score), 0), 9) AS total FROM sh LEFT JOIN ps ON ps.a = fid GROUP BY 1, 2)
SELECT sh.source AS group_id, arg_max(a, (total, {KINDS}, CAST(lang = 'en' AS INT), length(text), fid)) AS medoid_fid, count(*) AS member_n FROM tt JOIN sh ON sh.fid = a GROUP BY 1""")
def source_medoids(spark, d):
    docs = _docs(spark, d, "fid", "ord", "source", "kind", "placed", "seq_len", "bp", "left_anchor", "right_anchor", "shingles")
    shingles = materialize(sim.weighted_shingles(docs), "weighted", "zstd")
    return sim.medoids(_members(docs), docs, shingles, b.doc_nodes(b.doc_features(spark, d)))


@query("a21_display_choices", f"""
WITH {DOCS} SELECT source AS group_id, arg_max(fid, ({KINDS}, CAST(lang = 'en' AS INT), length(text), fid)) AS display_fid FROM dt GROUP BY 1""")
def display_choices(spark, d):
    docs = b.doc_features(spark, d)
    return sim.display_choice(_members(docs), docs)


@query("c12_orientation", f"""
WITH {WEIGHTS},
md AS (SELECT source, min(ord) AS o FROM sh GROUP BY 1), mf AS (SELECT source, fid AS medoid_fid, shingles AS target FROM sh JOIN md USING (source) WHERE ord = o),
rv AS (SELECT fid, source, shingles AS fwd, list_distinct(list_transform(ix, lambda i: 'M:' || array_to_string(list_transform(list_reverse(t)[i + 1 : i + kk], lambda x: '<' || x[2:]), '|'))) AS rev FROM sh),
lg AS (SELECT fid, medoid_fid, fwd, rev, target, unnest(list_distinct(list_concat(fwd, list_concat(rev, target)))) AS shingle FROM rv JOIN mf USING (source)),
sm AS (SELECT fid, medoid_fid, sum(CASE WHEN list_contains(fwd, shingle) AND list_contains(target, shingle) THEN coalesce(weight, 1) ELSE 0 END) AS fi,
              sum(CASE WHEN list_contains(fwd, shingle) OR list_contains(target, shingle) THEN coalesce(weight, 1) ELSE 0 END) AS fu,
              sum(CASE WHEN list_contains(rev, shingle) AND list_contains(target, shingle) THEN coalesce(weight, 1) ELSE 0 END) AS ri,
              sum(CASE WHEN list_contains(rev, shingle) OR list_contains(target, shingle) THEN coalesce(weight, 1) ELSE 0 END) AS ru FROM lg LEFT JOIN wt USING (shingle) GROUP BY 1, 2)
SELECT fid, medoid_fid, round(fi / fu, 6) AS ctx_fwd, round(ri / ru, 6) AS ctx_rev, CAST(CASE WHEN round(ri / ru, 12) > round(fi / fu, 12) THEN -1 ELSE 1 END AS BIGINT) AS orientation FROM sm""")
def orientation(spark, d):
    docs = _docs(spark, d, "fid", "ord", "source", "tokens", "shingles")
    weights = materialize(sim.shingle_weights(sim.shingle_frequencies(docs), docs.count()), "weights")
    leads = docs.groupBy("source").agg(F.min_by("fid", "ord").alias("medoid_fid"))
    out = sim.orientation(docs, docs.select("fid", "source").join(leads, "source").select("fid", "medoid_fid"), weights)
    return out.select("fid", "medoid_fid", F.round("ctx_fwd", 6).alias("ctx_fwd"), F.round("ctx_rev", 6).alias("ctx_rev"), "orientation")


def seed_loci(spark, d):
    docs = materialize(sim.with_anchors(b.doc_features(spark, d)), "docs")
    shingles = materialize(sim.weighted_shingles(docs), "weighted", "zstd")
    nodes = materialize(b.doc_nodes(docs), "nodes")
    return docs, shingles, nodes, materialize(lo.cluster_loci(docs, shingles, nodes), "loci")


#: All pairs of a feature with an earlier one that share an anchor and match.
MATCHES = f"""
{WEIGHTS},
an AS (SELECT fid, ord, unnest(list_distinct(list_concat(['L:' || la, 'R:' || ra], shingles))) AS anchor FROM sh),
an2 AS (SELECT DISTINCT x.fid AS a, y.fid AS b FROM an x JOIN an y USING (anchor) WHERE x.fid <> y.fid),
nd AS (SELECT fid, unnest(list_distinct(w)) AS node FROM sh),
sb AS (SELECT a, b, CAST(sum(length(x.node)) AS BIGINT) AS shared_bp FROM an2 JOIN nd x ON x.fid = a JOIN nd y ON y.fid = b AND y.node = x.node GROUP BY 1, 2),
so AS (SELECT a, b, shared_bp, least(shared_bp / p.bp, shared_bp / q.bp) AS ro, least(p.bp, q.bp) / greatest(p.bp, q.bp) AS size_ratio, CAST(p.la = q.la OR p.ra = q.ra AS INTEGER) AS boundary,
              p.ord AS ord, q.ord AS other, p.source || ':' || p.lang AS label, p.text AS ta, q.text AS tb
       FROM sb JOIN sh p ON p.fid = a JOIN sh q ON q.fid = b WHERE least(shared_bp / p.bp, shared_bp / q.bp) >= 0.20),
it AS (SELECT a, b, sum(x.weight) AS i FROM so JOIN fw x ON x.fid = a JOIN fw y ON y.fid = b AND y.shingle = x.shingle GROUP BY 1, 2),
tw AS (SELECT fid, sum(weight) AS w FROM fw GROUP BY 1),
cx AS (SELECT so.*, round(coalesce(i, 0) / (p.w + q.w - coalesce(i, 0)), 12) AS ctx FROM so LEFT JOIN it USING (a, b) JOIN tw p ON p.fid = so.a JOIN tw q ON q.fid = so.b),
tr AS (SELECT *, CASE WHEN ro >= 0.95 AND size_ratio >= 0.95 AND ctx >= 0.80 THEN 3 WHEN ro >= 0.50 AND ctx >= 0.30 THEN 2
                      WHEN size_ratio >= 0.67 AND (ctx >= 0.50 OR boundary = 1) THEN 1 ELSE 0 END AS r0 FROM cx),
kq AS (SELECT *, CASE WHEN r0 = 1 THEN list_distinct(list_transform(range(1, greatest(2, length(ta) - 7)), lambda i: substr(ta, i, 9))) END AS ka,
                 CASE WHEN r0 = 1 THEN list_distinct(list_transform(range(1, greatest(2, length(tb) - 7)), lambda i: substr(tb, i, 9))) END AS kb FROM tr WHERE r0 > 0),
ws AS (SELECT *, CASE WHEN r0 = 1 THEN len(list_intersect(ka, kb)) / (len(ka) + len(kb) - len(list_intersect(ka, kb))) END AS weak FROM kq),
mt AS MATERIALIZED (SELECT a, b, ord, other, label, round(r0 * 10.0 + ro * 3.0 + ctx * 2.0 + size_ratio + coalesce(weak, 0) * 0.5, 9) AS composite FROM ws WHERE r0 <> 1 OR weak >= 0.25)
"""
#: The serial visit, one feature a step: the best earlier representative that matches and has no member of the label.
SEEDS = f"""
WITH RECURSIVE {MATCHES},
lb AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ord) AS k, ord, fid, source || ':' || lang AS label FROM sh),
st(k, ord, label, rep) USING KEY (k) AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS ord, '' AS label, -1::BIGINT AS rep
  UNION
  SELECT n.k, n.ord, n.label, coalesce((SELECT arg_max(m.other, (m.composite, -m.other)) FROM mt m JOIN recurring.st r ON r.ord = m.other AND r.rep = r.ord
      WHERE m.ord = n.ord AND m.other < n.ord AND NOT EXISTS (SELECT 1 FROM recurring.st t WHERE t.rep = m.other AND t.label = n.label)), n.ord)
  FROM st s JOIN lb n ON n.k = s.k + 1),
sd AS MATERIALIZED (SELECT lb.fid, st.ord, st.label, st.rep, dense_rank() OVER (ORDER BY st.rep) AS locus_id FROM st JOIN lb USING (k))
"""


@query("c06_cluster_loci", f"{SEEDS} SELECT fid, ord, label, locus_id FROM sd")
def cluster_loci(spark, d):
    return seed_loci(spark, d)[3].select("fid", "ord", "label", "locus_id")


@query("c07_polish_loci", f"""
{SEEDS},
pd AS (SELECT x.locus_id, x.fid AS a, y.fid AS b FROM sd x JOIN sd y ON x.locus_id = y.locus_id AND x.fid <> y.fid),
pn AS (SELECT a, b, sum(length(x.node)) AS s FROM pd JOIN nd x ON x.fid = a JOIN nd y ON y.fid = b AND y.node = x.node GROUP BY 1, 2),
pi AS (SELECT a, b, sum(x.weight) AS i FROM pd JOIN fw x ON x.fid = a JOIN fw y ON y.fid = b AND y.shingle = x.shingle GROUP BY 1, 2),
ps AS (SELECT a, sum(least(coalesce(s, 0) / p.bp, coalesce(s, 0) / q.bp) * 4.0 + coalesce(i, 0) / (ta.w + tb.w - coalesce(i, 0)) * 2.0 + least(p.bp, q.bp) / greatest(p.bp, q.bp)
              + CASE WHEN p.la = q.la OR p.ra = q.ra THEN 0.25 ELSE 0 END) AS score
       FROM pd JOIN sh p ON p.fid = a JOIN sh q ON q.fid = b JOIN tw ta ON ta.fid = a JOIN tw tb ON tb.fid = b LEFT JOIN pn USING (a, b) LEFT JOIN pi USING (a, b) GROUP BY 1),
md AS MATERIALIZED (SELECT locus_id, arg_max(ord, (total, {{kinds}}, CAST(lang = 'en' AS INT), length(text), fid)) AS src
       FROM (SELECT sd.locus_id, sh.*, round(10 + coalesce(score, 0), 9) AS total FROM sd JOIN sh USING (fid) LEFT JOIN ps ON ps.a = sh.fid) GROUP BY 1),
tp AS (SELECT max(locus_id) AS top FROM md),
-- a medoid matches as a representative of a negative position; features match earlier features that found loci
mm AS MATERIALIZED (SELECT m.ord, md.locus_id - top - 1 AS rep, m.composite FROM mt m JOIN md ON md.src = m.other, tp
       UNION ALL SELECT sh.ord, md.locus_id - top - 1, 36.0 FROM md JOIN sh ON sh.ord = md.src, tp
       UNION ALL SELECT ord, other, composite FROM mt WHERE other < ord),
po(k, ord, label, rep) USING KEY (k) AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS ord, '' AS label, 0::BIGINT AS rep
  UNION
  SELECT n.k, n.ord, n.label, coalesce((SELECT arg_max(m.rep, (m.composite, -m.rep)) FROM mm m
      WHERE m.ord = n.ord AND (m.rep < 0 OR EXISTS (SELECT 1 FROM recurring.po r WHERE r.ord = m.rep AND r.rep = r.ord))
        AND NOT EXISTS (SELECT 1 FROM recurring.po t WHERE t.rep = m.rep AND t.label = n.label)), n.ord)
  FROM po s JOIN lb n ON n.k = s.k + 1),
fr AS (SELECT rep, top + row_number() OVER (ORDER BY rep) AS locus_id FROM (SELECT DISTINCT rep FROM po WHERE k > 0 AND rep > 0), tp)
SELECT lb.fid, po.ord, po.label, CAST(CASE WHEN po.rep < 0 THEN po.rep + top + 1 ELSE fr.locus_id END AS BIGINT) AS locus_id
FROM po JOIN lb USING (k) LEFT JOIN fr USING (rep), tp""".replace("{kinds}", KINDS))
def polish_loci(spark, d):
    docs, shingles, nodes, seeds = seed_loci(spark, d)
    members = seeds.select(F.col("locus_id").alias("group_id"), "fid", F.col("ord").alias("member_ord"))
    medoid = sim.medoids(members, docs, shingles, nodes).select(F.col("group_id").alias("locus_id"), "medoid_fid")
    return lo.polish_loci(seeds, materialize(medoid, "medoid"), docs, shingles, nodes).select("fid", "ord", "label", "locus_id")


@query("c13_alignment_identity")
def alignment_identity(spark, d):
    pairs = b.turns(spark, d)
    n, m = F.length("text_a"), F.length("text_b")
    ratio = F.least(n, m) / F.greatest(F.lit(1), F.greatest(n, m))
    close = pairs.withColumn("len_ratio", ratio).filter((ratio >= AlleleRules().min_len_ratio) & (F.least(n, m) > 0))
    return close.repartition("conv_id", "turn").select("conv_id", "turn", "len_ratio", align.identity_udf()("text_a", "text_b").alias("identity"))


@query("c19_cluster_alleles")
def cluster_alleles(spark, d):
    return al.cluster_alleles(b.turn_members(spark, d)).drop("seq_key")


@query("c18_greedy_alleles")
def greedy_alleles(spark, d):
    rules = AlleleRules(mode="greedy_clique", representative="ref_first")
    return al.cluster_alleles(b.turn_members(spark, d), rules).drop("seq_key")


@query("c22_copy_representatives", """
WITH m AS (SELECT doc_id, source, lang, text, sha256(text) AS k, length(text) AS n, count(*) OVER (PARTITION BY sha256(text)) AS copies FROM documents WHERE length(text) > 0)
SELECT k AS seq_key, arg_max('d' || doc_id, (CAST(lang = 'en' AS INT), n, 'd' || doc_id)) AS allele_id, count(*) AS member_n FROM m GROUP BY 1""")
def copy_representatives(spark, d):
    """Exact copies as one locus per text: the case that needs no task per group."""
    docs = b.table(spark, d, "documents").filter(F.length("text") > 0)
    members = docs.select(
        F.sha2("text", 256).alias("locus_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("fid"), F.col("source").alias("label"),
        F.lit("assembly").alias("kind"), (F.col("lang") == "en").alias("placed"), F.lit(False).alias("is_medoid"), F.col("text").alias("seq"),
    )
    out = al.cluster_alleles(members)
    return out.groupBy("seq_key", "allele_id").agg(F.count(F.lit(1)).alias("member_n"))


@query("c17_length_bands", """
WITH l AS (SELECT DISTINCT source AS locus_id, CAST(length(text) AS BIGINT) AS length FROM documents),
p AS (SELECT *, lag(length) OVER (PARTITION BY locus_id ORDER BY length) AS q FROM l)
SELECT locus_id, length, CAST(sum(CASE WHEN q / greatest(1, length) < 0.8 THEN 1 ELSE 0 END) OVER (PARTITION BY locus_id ORDER BY length ROWS UNBOUNDED PRECEDING) AS BIGINT) AS band FROM p""")
def length_bands(spark, d):
    lengths = b.table(spark, d, "documents").select(F.col("source").alias("locus_id"), F.length("text").cast("long").alias("length")).distinct()
    return al.length_bands(lengths, 0.8)
