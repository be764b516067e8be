"""Projections of the test tables into the input shapes of the operators.

Each projection keeps every row of its tables, so the work of a query grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as k
from ..operators import graph as g
from ..operators import overlap as ov
from ..operators.scan import ordered_scan
from ..session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(expr: str) -> Column:
    return F.expr(expr).cast("long")


def text(expr: str) -> Column:
    return F.expr(expr).cast("string")


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.expr("l_orderkey * 50 + l_linenumber * 7").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        text("l_suppkey % 10").alias("contig"), start.alias("start0"),
        (start + F.col("l_quantity").cast("long")).alias("end0"),
    )


def _keyed(ranges: DataFrame) -> DataFrame:
    key = k.feature_key(F.concat(F.lit("S#0#c"), F.col("contig")), F.col("start0"), F.col("end0"))
    return ranges.withColumn("fid", key)


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as intervals, duplicates kept: contig, start0, end0, fid."""
    return _keyed(_ranges(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct intervals; the id follows from the range, so only ranges are compared."""
    return _keyed(_ranges(spark, sf_dir).distinct())


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as insertions (two thirds) and deletion junctions."""
    c = F.col
    is_ins = c("o_orderkey") % 3 != 0
    start = _long("o_orderkey * 50 + o_custkey % 40")
    size = F.floor("o_totalprice").cast("long") % 500 + 1
    pos = _long("o_orderkey * 20 + 1")
    return table(spark, sf_dir, "orders").select(
        text("o_custkey % 10").alias("contig"), F.concat(F.lit("sv"), c("o_orderkey").cast("string")).alias("sv_id"),
        F.when(is_ins, "INS").otherwise("DEL").alias("sv_type"), start.alias("sv_start"),
        F.when(is_ins, start + 1 + c("o_orderkey") % 60).otherwise(start).alias("sv_end"),
        F.when(is_ins, size).otherwise(-size).alias("sv_len"), F.concat(F.lit("chr"), text("o_custkey % 5")).alias("chrom"),
        pos.alias("pos1"), F.when(is_ins, pos).otherwise(pos + 1 + c("o_orderkey") % 60).alias("ref_end1"),
    )


def event_pairs(spark: SparkSession, sf_dir: str, feats: DataFrame | None = None, kind: str | None = None) -> DataFrame:
    """Features (`feats`, where a query reads them again) and the events of all kinds or one that hit them."""
    rows = events(spark, sf_dir)
    return ov.event_pairs(features(spark, sf_dir) if feats is None else feats, rows if kind is None else rows.filter(F.col("sv_type") == kind))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as primary-reference intervals on five chromosomes, 1-based inclusive."""
    start = _long("p_partkey * 150 + 1")
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("chr"), text("p_partkey % 5")).alias("chrom"), start.alias("ref_start1"),
        (start + 20 + F.col("p_size") * 4).cast("long").alias("ref_end1"),
    )
    key = k.feature_key(F.concat(F.lit("R#0#"), F.col("chrom")), F.col("ref_start1") - 1, F.col("ref_end1"))
    return rows.withColumn("ref_fid", key)


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of an order as competing alignments of one feature."""
    c = F.col
    qty = c("l_quantity").cast("long")
    start = _long("l_partkey * 150 + l_linenumber * 11")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("f"), c("l_orderkey").cast("string")).alias("fid"),
        F.round(F.lit(1.0) - c("l_discount"), 2).alias("identity"), (qty / F.lit(50.0)).alias("coverage"),
        qty.alias("aligned_bp"), c("l_linenumber").cast("long").alias("block_n"), (qty + 1).alias("span_bp"),
        F.concat(F.lit("chr"), text("l_partkey % 5")).alias("chrom"), start.alias("start0"), (start + qty + 1).alias("end0"),
        F.when(c("l_returnflag") == "R", "-").otherwise("+").alias("strand"),
    )


WALK_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def walk_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as steps of ten long walks over parts as segments."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_suppkey % 10").alias("path_id"), *WALK_ORDER, F.col("l_partkey").alias("segment"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("rev"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("segment"), F.col("p_partkey").alias("node"), F.col("p_size").cast("long").alias("length")
    )


def walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten walks unfolded: path_id, ordinal, start0, end0, node, rev."""
    return g.unfold(walk_steps(spark, sf_dir), nodes(spark, sf_dir), "path_id", tuple(WALK_ORDER))


def walk_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as features on the walks."""
    lo = _long("o_orderkey * 10")
    return table(spark, sf_dir, "orders").select(
        text("o_custkey % 10").alias("contig"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("fid"),
        lo.alias("lo"), (lo + 20 + F.col("o_custkey") % 200).cast("long").alias("hi"),
    )


def words(column: str = "text") -> Column:
    return F.filter(F.split(column, "[ \\n\\t\\r]+"), lambda w: w != "")


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as features whose tokens are all their words."""
    c = F.col
    tokens = words()
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.lpad(c("doc_id").cast("string"), 9, "0")).alias("fid"), (c("doc_id") + 1).alias("ord"),
        F.concat("source", F.lit(":"), "lang").alias("label"),
        F.when(c("doc_id") % 50 == 0, "reference_primary").when(c("doc_id") % 50 == 1, "reference_comparison")
        .otherwise("assembly").alias("kind"),
        (c("lang") == "en").alias("placed"), c("source"), c("text").alias("seq"), F.length("text").cast("long").alias("seq_len"),
        F.transform(tokens, lambda w: F.concat(F.lit(">"), w)).alias("tokens"),
        F.aggregate(F.array_distinct(tokens), F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("bp"),
    )


def doc_nodes(docs: DataFrame) -> DataFrame:
    """Distinct words of a document as node ranges."""
    word = F.explode(F.array_distinct("tokens")).alias("node")
    return docs.select("fid", word).select(
        "fid", "node", F.lit(0).cast("long").alias("s"), (F.length("node") - 1).cast("long").alias("e")
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a type as one-dimensional sites at their second."""
    c = F.col
    at = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").cast("long")
    return table(spark, sf_dir, "events").select(
        c("event_type").alias("chrom"), at.alias("start1"), (at + c("user_id") % 30).cast("long").alias("end1"),
        c("event_id").alias("ordinal"), F.when(c("value") > 20, "sv_only").otherwise("hal_only").alias("source"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part by nation as a three-valued long matrix; every part meets every nation because that table is the result."""
    li, sup, nat = (table(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation"))
    seen = (
        li.join(sup, li.l_suppkey == sup.s_suppkey).groupBy("l_partkey", "s_nationkey")
        .agg(F.max(F.col("l_quantity") > 25).alias("big"))
    )
    keys = nat.agg(F.sort_array(F.collect_list("n_nationkey")).alias("v")).first()["v"]
    grid = table(spark, sf_dir, "part").select(
        "p_partkey", F.explode(F.array(*[F.lit(v) for v in keys])).alias("n_nationkey")
    )
    joined = grid.join(
        seen, (grid.p_partkey == seen.l_partkey) & (grid.n_nationkey == seen.s_nationkey), "left"
    )
    return joined.select(
        F.col("p_partkey").alias("locus_id"), F.concat(F.lit("NATION_"), F.col("n_nationkey").cast("string")).alias("genome"),
        F.when(F.col("big"), "1").when(~F.col("big"), "0").otherwise("NA").alias("gt"),
    )


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("genome"),
        F.when(key == 0, "primary_reference").when(key == 1, "comparison_reference").otherwise("sample").alias("role"),
    )


def locus_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as members: part = locus, nation of the supplier = label, return flag = allele."""
    c = F.col
    sup = table(spark, sf_dir, "supplier")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("l_suppkey"), F.min("l_returnflag").alias("flag"), F.min("l_quantity").alias("qty")
    )
    joined = lines.join(sup, c("l_suppkey") == c("s_suppkey"))
    return joined.select(
        c("l_partkey").alias("locus_id"),
        F.concat_ws(":", c("l_partkey").cast("string"), c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("fid"),
        F.concat(F.lit("NATION_"), c("s_nationkey").cast("string")).alias("label"),
        F.when(c("s_nationkey") == 0, "reference_primary").when(c("s_nationkey") == 1, "reference_comparison")
        .otherwise("assembly").alias("kind"),
        F.concat(c("l_partkey").cast("string"), F.lit("_"), c("flag")).alias("allele_id"),
        _long("l_orderkey * 100 + l_linenumber").alias("ordinal"), c("qty").cast("long").alias("length"),
        (c("qty") > 10).alias("placed"), F.concat(F.lit("chr"), text("l_suppkey % 3")).alias("chrom"),
        _long("l_orderkey * 10 + 1").alias("start1"), (_long("l_orderkey * 10") + c("qty").cast("long")).alias("end1"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent turns of a conversation as sequence pairs."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    nxt = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_b"))
    return t.join(nxt, ["conv_id", "turn"]).withColumnRenamed("text", "text_a")


def turn_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as allele members of their conversation; the first turn is the medoid."""
    c = F.col
    return table(spark, sf_dir, "conversations").select(
        c("conv_id").alias("locus_id"), F.concat(F.lit("c"), c("conv_id").cast("string"), F.lit("_"), c("turn").cast("string")).alias("fid"),
        c("role").alias("label"), F.when(c("turn") == 0, "reference_primary").otherwise("assembly").alias("kind"),
        (c("turn") % 2 == 0).alias("placed"), (c("turn") == 0).alias("is_medoid"), c("text").alias("seq"),
    )


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as walks in fragments: text lengths give the spans, a missing turn breaks the walk."""
    c = F.col
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv"), c("conv_id").cast("string")).alias("gfa_path_id"), F.lit("W").alias("record_type"),
        c("turn").alias("line_no"), (c("turn") * 100).cast("long").alias("start0"),
        F.when(c("role") == "user", c("turn") * 100 + 100).otherwise(c("turn") * 100 + 100 - F.length("text") % 2).cast("long").alias("end0"),
    )


def order_edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Steps of each order as a short walk, for links between consecutive parts."""
    steps = table(spark, sf_dir, "lineitem").select(
        *WALK_ORDER, F.col("l_partkey").cast("string").alias("segment"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("rev"),
    )
    return steps, tuple(WALK_ORDER[1:])


def _model_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*WALK_ORDER).distinct()


def model_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models and nodes of `model_steps`, without their order."""
    lines = _model_lines(spark, sf_dir).select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("model"), F.col("l_partkey").alias("segment"))
    return lines.join(nodes(spark, sf_dir), "segment").select("model", "node")


def model_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as source models: the first half of the lines is the left context, the rest the right context."""
    c = F.col
    rows = materialize(_model_lines(spark, sf_dir), "lines")
    ranked = ordered_scan(rows, ["l_orderkey"], WALK_ORDER[1:], {"pos": ("count", None)})
    sizes = rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    half = F.floor(c("n") / 2)
    placed = ranked.join(sizes, "l_orderkey").withColumn("pos", c("pos") - 1)
    side = F.when(c("pos") < half, "left").otherwise("right")
    return placed.join(nodes(spark, sf_dir), c("l_partkey") == c("segment")).select(
        F.concat(F.lit("o"), c("l_orderkey").cast("string")).alias("locus_id"),
        F.concat(F.lit("o"), c("l_orderkey").cast("string")).alias("model"), side.alias("side"),
        F.when(c("pos") < half, c("pos")).otherwise(c("pos") - half).cast("long").alias("idx"), c("node"),
        F.when(c("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("rev"),
        F.lit(0).cast("long").alias("s"), c("length").alias("e"),
    )


def occurrences(walk: DataFrame) -> DataFrame:
    return walk.select(
        F.lit("T").alias("genome"), F.col("path_id").alias("chrom"), "ordinal", "node", "rev",
        F.col("start0").alias("t_start"), F.col("end0").alias("t_end"),
    )
