"""Rules and renderers of input and output files, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as k
from ..functions import scalars as sc
from ..operators.scan import global_rank
from ..sinks import text as sink
from ..sources import genome as src
from . import bridges as b
from .registry import query

KEYS = """
fk AS (SELECT o_orderkey, 'S' || (o_custkey % 7) || '#' || (o_orderkey % 2) || '#c' || (o_orderkey % 11) || ':' || (o_orderkey * 3) || '-' || (o_orderkey * 3 + o_custkey % 90 + 1) AS fid,
              'S' || (o_custkey % 7) AS sample, CAST(o_orderkey % 2 AS VARCHAR) AS hap, 'c' || (o_orderkey % 11) AS contig, o_orderkey * 3 AS s, o_orderkey * 3 + o_custkey % 90 + 1 AS e FROM orders)
"""


def _keys(spark, d):
    c = F.col
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    lo = c("o_orderkey") * 3
    fid = text("S", c("o_custkey") % 7, "#", c("o_orderkey") % 2, "#c", c("o_orderkey") % 11, ":", lo, "-", lo + c("o_custkey") % 90 + 1)
    return b.table(spark, d, "orders").select("o_orderkey", fid.alias("fid"))


@query("p04_key_order", f"WITH {KEYS} SELECT fid, row_number() OVER (ORDER BY sample, hap, contig, s, e, fid) AS rank FROM fk")
def key_order(spark, d):
    ranked = global_rank(_keys(spark, d).select("fid", k.key_order(F.col("fid")).alias("place")), ["place"], "rank")
    return ranked.select("fid", "rank")


@query("p38_compact_renderers", """
SELECT l_orderkey, string_agg(l_partkey || ':' || l_linenumber || '-' || (l_linenumber + l_suppkey), ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS ranges,
       string_agg(l_partkey, ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS members FROM lineitem GROUP BY 1""")
def compact_renderers(spark, d):
    c = F.col
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    lines = b.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("r"))
    ranges = F.transform("r", lambda r: F.struct(r["l_partkey"].alias("node"), r["l_linenumber"].alias("s"), (r["l_linenumber"] + r["l_suppkey"]).alias("e")))
    return lines.select("l_orderkey", sc.compact_ranges(ranges).alias("ranges"), sc.compact_list(F.transform(c("r"), lambda r: r["l_partkey"])).alias("members"))


@query("s19_catalogue_violations", """
WITH t AS (SELECT 's' || s_suppkey AS label, CASE WHEN s_suppkey % 9 = 0 THEN '' WHEN s_suppkey % 13 = 0 THEN 'other' WHEN s_suppkey % 3 = 0 THEN 'reference_primary' ELSE 'assembly' END AS kind,
                  CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE 'x.bed' END AS bed, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'x.tsv' END AS sv_tsv FROM supplier),
m AS (SELECT *, list_sort(list_filter([CASE WHEN kind = '' THEN 'kind' END, CASE WHEN trim(bed) = '' THEN 'bed' END, CASE WHEN kind = 'assembly' AND sv_tsv = '' THEN 'sv_tsv' END], lambda x: x IS NOT NULL)) AS e FROM t)
SELECT label, 'empty fields: ' || array_to_string(e, ',') AS problem FROM m WHERE len(e) > 0
UNION ALL SELECT label, 'unsupported kind: ' || kind FROM m WHERE kind = 'other'""")
def catalogue_violations(spark, d):
    n = F.col("s_suppkey")
    kind = F.when(n % 9 == 0, "").when(n % 13 == 0, "other").when(n % 3 == 0, "reference_primary").otherwise("assembly")
    fixed = [F.lit("x").alias(c) for c in src.CATALOGUE_REQUIRED if c not in ("label", "kind", "bed")]
    table = b.table(spark, d, "supplier").select(
        F.concat(F.lit("s"), n.cast("string")).alias("label"), kind.alias("kind"), F.when(n % 5 == 0, " ").otherwise("x.bed").alias("bed"),
        F.when(n % 4 == 0, "").otherwise("x.tsv").alias("sv_tsv"), *fixed,
    )
    return src.catalogue_violations(table)


@query("k07_path_statistics", """
SELECT 'g' || (o_custkey % 5) AS genome, 'c' || (o_orderkey % 7) AS contig, count(*) AS row_count, min(o_orderkey * 10) AS start0, max(o_orderkey * 10 + 10) AS end0, true AS digested FROM orders GROUP BY 1, 2""")
def path_statistics(spark, d):
    c = F.col
    walks = b.table(spark, d, "orders").select(
        F.concat(F.lit("g"), (c("o_custkey") % 5).cast("string")).alias("genome"), F.concat(F.lit("c"), (c("o_orderkey") % 7).cast("string")).alias("contig"),
        c("o_orderkey").alias("ordinal"), (c("o_orderkey") * 10).alias("start0"), (c("o_orderkey") * 10 + 10).alias("end0"), c("o_custkey").alias("node"), F.lit(0).alias("rev"),
    )
    stats = sink.path_table_statistics(walks)
    return stats.select("genome", "contig", "row_count", "start0", "end0", (F.length("digest") == 64).alias("digested"))


@query("k18_named_bed4", """
SELECT n_name AS sequence, c_custkey * 10 AS start0, c_custkey * 10 + 7 AS end0, 'f' || c_custkey AS fid FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def named_bed4(spark, d):
    c = F.col
    names = b.table(spark, d, "nation").select(F.concat(F.lit("n"), c("n_nationkey").cast("string")).alias("contig"), c("n_name").alias("sequence"))
    features = b.table(spark, d, "customer").select(
        F.concat(F.lit("n"), c("c_nationkey").cast("string")).alias("contig"), (c("c_custkey") * 10).alias("start0"), (c("c_custkey") * 10 + 7).alias("end0"),
        F.concat(F.lit("f"), c("c_custkey").cast("string")).alias("fid"),
    )
    return sink.named_bed4(features, names)
