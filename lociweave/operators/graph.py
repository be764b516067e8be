"""Sequence-graph records: inventory, segments, links and unfolded paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as k
from ..functions import scalars as sc
from ..session import materialize
from .interval_join import interval_join
from .scan import global_rank, ordered_scan

# Fixed values of the path inventory.
ACCEPTED_STATUS = ["not_applicable", "zero", "zero_verified_from_links", "zero_single_segment", "requires_link_verification"]


def _fields(lines: DataFrame, kind: str) -> DataFrame:
    return lines.filter(F.startswith("line", F.lit(kind + "\t"))).select(
        "line_no", F.split("line", "\t", -1).alias("f")
    )


def segments(lines: DataFrame, gfa_major: int = 1) -> DataFrame:
    """Segment names with lengths, from the sequence, an LN tag or (version 2) the declared length."""
    f = F.col("f")
    name = F.get(f, F.lit(1))
    if gfa_major == 2:
        declared, seq = F.get(f, F.lit(2)).cast("long"), F.get(f, F.lit(3))
        good = (seq == "*") | (F.length(seq) == declared)
        length = F.when(good, declared).otherwise(F.raise_error(F.lit("segment length does not match sequence")))
    else:
        seq = F.get(f, F.lit(2))
        tag = F.get(F.filter(F.slice(f, F.lit(4), F.greatest(F.size(f) - 3, F.lit(0))), lambda t: F.startswith(t, F.lit("LN:i:"))), F.lit(0))
        length = (
            F.when(seq != "*", F.length(seq))
            .when(tag.isNotNull(), F.substring(tag, 6, 2**31 - 1).cast("long"))
            .otherwise(F.raise_error(F.lit("segment has no sequence and no length tag")))
        )
    return _fields(lines, "S").select(name.alias("segment"), length.cast("long").alias("length"), "line_no")


def segment_statistics(segs: DataFrame) -> DataFrame:
    numeric = k.is_canonical_number(F.col("segment"))
    stats = segs.agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.coalesce(F.max(F.when(numeric, F.col("segment").try_cast("long"))), F.lit(-1)).alias("max_numeric"),
        F.coalesce(F.every(numeric), F.lit(True)).alias("all_numeric"),
    )
    return stats.withColumn(
        "dense_numeric",
        F.col("all_numeric") & (F.col("max_numeric") <= F.greatest(F.lit(1024), F.col("n_segments") * 2)),
    )


def number_segments(segs: DataFrame, dense_numeric: bool) -> DataFrame:
    """Node numbers: the name itself on dense numeric graphs, else positions in first-seen order."""
    if dense_numeric:
        return segs.select("segment", F.col("segment").cast("long").alias("node"), "length")
    ranked = global_rank(segs, ["line_no"], "__n")
    return ranked.select("segment", (F.col("__n") - 1).alias("node"), "length")


def link_table(links: DataFrame) -> DataFrame:
    """One row per canonical link (struct `key`) with its status; rows: key, overlap."""
    return links.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("overlap").alias("lo"), F.max("overlap").alias("hi")
    ).select(
        "key",
        F.when(F.col("n") != 1, "multiple_matching_links")
        .when((F.col("lo") != "0M") | (F.col("lo") != F.col("hi")), "link_overlap_unsupported")
        .otherwise("zero")
        .alias("status"),
    )


def links(lines: DataFrame) -> DataFrame:
    f = F.col("f")
    at = [F.get(f, F.lit(i)) for i in range(6)]
    signs = at[2].isin("+", "-") & at[4].isin("+", "-")
    key = F.when(signs, sc.link_key(at[1], at[2], at[3], at[4])).otherwise(F.raise_error(F.lit("invalid link orientation")))
    return _fields(lines, "L").select(key.alias("key"), at[5].alias("overlap"))


def path_records(lines: DataFrame) -> DataFrame:
    """Path and walk records with their ids, before unfolding."""
    f = F.col("f")
    at = [F.get(f, F.lit(i)) for i in range(7)]
    blank = F.lit("")
    walks = _fields(lines, "W").select(
        k.path_id(F.lit("W"), [at[1], at[2], at[3]]).alias("gfa_path_id"), F.lit("W").alias("record_type"),
        blank.alias("raw_path_name"), at[1].alias("w_sample_id"), at[2].alias("w_haplotype_index"),
        at[3].alias("sequence_id"), at[4].try_cast("long").alias("start0"), at[5].try_cast("long").alias("end0"),
        at[6].alias("tokens"), F.lit("not_applicable").alias("overlaps"), "line_no",
    )
    named = [
        _fields(lines, kind).select(
            k.path_id(F.lit(kind), [at[1]]).alias("gfa_path_id"), F.lit(kind).alias("record_type"),
            at[1].alias("raw_path_name"), blank.alias("w_sample_id"), blank.alias("w_haplotype_index"),
            at[1].alias("sequence_id"), F.lit(0).cast("long").alias("start0"), F.lit(None).cast("long").alias("end0"),
            at[2].alias("tokens"), F.coalesce(at[3], F.lit("*")).alias("overlaps"), "line_no",
        )
        for kind in ("P", "O")
    ]
    return walks.unionByName(named[0]).unionByName(named[1])


def fragment_breaks(records: DataFrame) -> DataFrame:
    """Walk fragments whose start is not the end of the previous fragment of the same path."""
    walks = records.filter("record_type = 'W'").select("gfa_path_id", "line_no", "start0", "end0")
    scanned = ordered_scan(walks, ["gfa_path_id"], ["line_no"], {"previous_end": ("lag", "end0")})
    return scanned.filter(F.col("previous_end") != F.col("start0"))


def inventory(records: DataFrame) -> DataFrame:
    """One row per path: span, fragments, source lines and overlap status."""
    c = F.col
    single = c("tokens").rlike(r"^[^,;\s]+[+-]$")
    status = (
        F.when(c("record_type") == "O", "gfa2_ordered_group_unsupported")
        .when((c("record_type") == "W") & (c("start0").isNull() | c("end0").isNull()), "w_coordinates_unknown_unsupported")
        .when(c("record_type") == "W", "not_applicable")
        .when((c("overlaps") == "*") & single, "zero_single_segment")
        .when(c("overlaps") == "*", "requires_link_verification")
        .when(F.forall(F.split("overlaps", ","), lambda e: e == "0M"), "zero")
        .otherwise("nonzero_unsupported")
    )
    jump = F.when((c("record_type") == "P") & F.contains("tokens", F.lit(";")), F.raise_error(F.lit("jump separators are unsupported")))
    rows = records.select("*", F.coalesce(jump.cast("string"), status).alias("overlap_status"))
    keys = ["gfa_path_id", "record_type", "raw_path_name", "w_sample_id", "w_haplotype_index", "sequence_id"]
    unknown = F.max(F.when(c("overlap_status") == "w_coordinates_unknown_unsupported", 1)).isNotNull()
    known = (c("record_type") == "W") & c("end0").isNotNull()
    return rows.groupBy(*keys).agg(
        F.when(~unknown, F.min("start0")).alias("start0"),
        F.when(~unknown, F.max("end0")).alias("end0"),
        F.when(~unknown, F.sum(F.when(known, c("end0") - c("start0")))).alias("path_length_bp"),
        F.count(F.lit(1)).alias("fragment_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list("line_no")), lambda v: v.cast("string")), ",").alias("source_lines"),
        F.when(unknown, "w_coordinates_unknown_unsupported").otherwise(F.min("overlap_status")).alias("overlap_status"),
    )


def located(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """Steps with the node of their segment; an undefined segment stops the job."""
    missing = F.raise_error(F.concat(F.lit("path step names an undefined segment: "), F.col("segment")))
    return steps.join(nodes, "segment", "left").withColumn("node", F.coalesce("node", missing.cast(nodes.schema["node"].dataType)))


def unfold(steps: DataFrame, nodes: DataFrame, path_key: str = "path_id", order: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """Cumulative offsets of ordered steps (path, order columns, segment, rev) over node lengths."""
    # Written first: the range partitioning of a scan samples its input, which would run the join twice.
    placed = ordered_scan(materialize(located(steps, nodes), "located"), [path_key], list(order), {"end0": ("sum", "length"), "step_no": ("count", None)})
    return placed.select(
        path_key, (F.col("step_no") - 1).alias("ordinal"), (F.col("end0") - F.col("length")).alias("start0"), "end0",
        "node", "rev",
    )


def record_steps(records: DataFrame) -> DataFrame:
    """Steps of path and walk records in order, as (path_id, line_no, pos, segment, rev)."""
    tokens = F.when(F.col("record_type") == "W", sc.walk_tokens(F.col("tokens"))).otherwise(sc.path_tokens(F.col("tokens")))
    return records.select(F.col("gfa_path_id").alias("path_id"), "line_no", F.posexplode(tokens).alias("pos", "token")).select(
        "path_id", "line_no", "pos", F.substring("token", 2, 2**31 - 1).alias("segment"),
        F.when(F.startswith("token", F.lit("<")), 1).otherwise(0).cast("long").alias("rev"),
    )


def unknown_segments(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    return steps.join(nodes.select("segment"), "segment", "left_anti")


def path_violations(records: DataFrame, nodes: DataFrame, table: DataFrame) -> DataFrame:
    """gfa_path_id, problem: what keeps a path from being unfolded. An empty table is a pass.

    records: `path_records`; nodes: `number_segments`; table: `link_table`.
    """
    c = F.col
    steps = record_steps(records)
    found = inventory(records)
    spans = steps.join(nodes, "segment").groupBy("path_id", "line_no").agg(F.sum("length").alias("bases"))
    walks = records.filter("record_type = 'W' and start0 is not null and end0 is not null")
    spans = walks.select(c("gfa_path_id").alias("path_id"), "line_no", (c("end0") - c("start0")).alias("span")).join(spans, ["path_id", "line_no"], "left")
    unverified = found.filter("overlap_status = 'requires_link_verification'").select(c("gfa_path_id").alias("path_id"))
    edges = edge_status(steps.join(unverified, "path_id", "left_semi"), table, "path_id", ("line_no", "pos"))
    problems = [
        (unknown_segments(steps, nodes).select("path_id"), "undefined_segment"),
        (fragment_breaks(records).filter("previous_end is not null").select("gfa_path_id"), "fragment_gap"),
        (records.filter("record_type <> 'W'").groupBy("gfa_path_id").count().filter("count > 1").select("gfa_path_id"), "duplicate_path"),
        (spans.filter(~c("span").eqNullSafe(c("bases"))).select("path_id"), "span_mismatch"),
        (found.filter(~c("overlap_status").isin(ACCEPTED_STATUS)).select("gfa_path_id"), "unsupported_overlap"),
        (edges.filter("status <> 'zero'").select("path_id"), "unverified_link"),
    ]
    return reduce(DataFrame.unionByName, [rows.distinct().toDF("gfa_path_id").withColumn("problem", F.lit(name)) for rows, name in problems])


def edges(steps: DataFrame, path_key: str, order: tuple[str, ...]) -> DataFrame:
    """Consecutive steps of each path as the key of the link between them."""
    packed = steps.withColumn("__me", F.struct("segment", F.when(F.col("rev") == 0, "+").otherwise("-").alias("sign")))
    scanned = ordered_scan(packed, [path_key], list(order), {"__was": ("lag", "__me")}).filter(F.col("__was").isNotNull())
    key = sc.link_key(F.col("__was.segment"), F.col("__was.sign"), F.col("__me.segment"), F.col("__me.sign"))
    return scanned.select(path_key, *order, key.alias("key"))


def with_link_status(found: DataFrame, table: DataFrame) -> DataFrame:
    """`edges` with the status of their link."""
    return found.join(table, "key", "left").withColumn("status", F.coalesce("status", F.lit("missing_link")))


def edge_status(steps: DataFrame, table: DataFrame, path_key: str, order: tuple[str, ...]) -> DataFrame:
    """Consecutive steps of each path with the status of the link between them."""
    return with_link_status(edges(steps, path_key, order), table)


def path_totals(unfolded: DataFrame, path_key: str = "path_id") -> DataFrame:
    return unfolded.groupBy(path_key).agg(
        F.count(F.lit(1)).alias("node_rows"), F.sum(F.col("end0") - F.col("start0")).alias("span_bp"),
        F.max("end0").alias("end0"),
    )


def discontinuities(walk: DataFrame, path_key: str = "path_id") -> DataFrame:
    """Rows that do not continue the walk: not at the previous end (zero for the first) or without length."""
    scanned = ordered_scan(walk, [path_key], ["ordinal"], {"previous_end": ("lag", "end0")})
    expected = F.coalesce("previous_end", F.lit(0))
    return scanned.filter((F.col("start0") != expected) | (F.col("end0") <= F.col("start0")))


def map_features(features: DataFrame, walk: DataFrame, flank_bp: int) -> DataFrame:
    """Steps of each feature and of its flanks, clipped, in node coordinates.

    features: contig, fid, lo, hi; walk: contig, ordinal, start0, end0, node, rev.  Output rows carry `side`
    (body, left, right), the ordinal on the walk, the node range and the bases.  The rows that hold a feature's first and last
    base are looked up first, so the steps, many times the features and the walk, are never shuffled.
    """
    c = F.col
    wide = features.select("contig", "fid", "lo", "hi", (c("lo") - flank_bp).alias("wide_lo"), (c("hi") + flank_bp).alias("wide_hi"))
    wide, walk = materialize(wide, "wide"), materialize(walk.select("contig", "ordinal", "start0", "end0", "node", "rev"), "walk")
    at = wide.select("*", F.explode(F.array("lo", c("hi") - 1)).alias("at")).withColumn("past", c("at") + 1)
    met = (c("start0") < c("wide_hi")) & (c("wide_lo") < c("end0")) & (c("start0") <= c("at")) & (c("at") < c("end0"))
    found = interval_join(at, walk.select("contig", "start0", "end0"), ["contig"], ("at", "past"), ("start0", "end0"), met)
    holds, ends = (c("start0") <= c("lo")) & (c("lo") < c("end0")), (c("start0") < c("hi")) & (c("hi") <= c("end0"))
    held = found.groupBy("fid").agg(F.max(F.when(holds, c("start0"))).alias("holder0"), F.max(F.when(ends, 1)).alias("ended"))
    known = interval_join(wide.join(held, "fid", "left"), walk, ["contig"], ("wide_lo", "wide_hi"), ("start0", "end0"))
    # The left flank keeps whole rows before the row that holds the feature start while they fit the flank,
    # and at least the nearest one; the cut to the flank length comes after that.
    near = (c("start0") == c("holder0")) | (c("end0") == c("holder0")) | (c("holder0") - c("start0") <= flank_bp)

    def part(side: str, when: Column, a: Column, b: Column) -> Column:
        return F.when(when & (a < b), F.struct(F.lit(side).alias("side"), a.alias("a"), b.alias("b")))

    parts = F.array(
        part("body", (c("start0") < c("hi")) & (c("lo") < c("end0")), F.greatest("lo", "start0"), F.least("hi", "end0")),
        part("left", (c("start0") < c("lo")) & near, F.greatest("wide_lo", "start0"), F.least("lo", "end0")),
        part("right", (c("end0") > c("hi")) & c("ended").isNotNull(), F.greatest("hi", "start0"), F.least("wide_hi", "end0")),
    )
    steps = known.select("fid", "ordinal", "node", "rev", "start0", "end0", F.explode(F.array_compact(parts)).alias("p")).select(
        "fid", "ordinal", "node", "rev", "start0", "end0", "p.*"
    )
    local_s = F.when(c("rev") == 0, c("a") - c("start0")).otherwise(c("end0") - c("b"))
    local_e = F.when(c("rev") == 0, c("b") - c("start0")).otherwise(c("end0") - c("a"))
    return steps.select(
        "fid", "side", "ordinal", "node", "rev", local_s.alias("s"), local_e.alias("e"), (c("b") - c("a")).alias("bp")
    )


def mapping_summary(features: DataFrame, steps: DataFrame) -> DataFrame:
    """Graph bases, coverage and step counts per feature; features without a step are kept."""

    def side(name: str, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == name, F.expr(value))), F.lit(0)).cast("long")

    totals = steps.groupBy("fid").agg(
        side("body", "bp").alias("graph_bp"), side("body", "1").alias("graph_nsteps"),
        side("left", "bp").alias("left_flank_bp"), side("left", "1").alias("left_flank_nsteps"),
        side("right", "bp").alias("right_flank_bp"), side("right", "1").alias("right_flank_nsteps"),
    )
    names = [n for n in totals.columns if n != "fid"]
    out = features.select("fid", "lo", "hi").join(totals, "fid", "left").na.fill(0, names)
    return out.withColumn("graph_cov", F.coalesce(F.try_divide(F.col("graph_bp"), F.col("hi") - F.col("lo")), F.lit(0.0))).drop("lo", "hi")


def merge_node_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Union of touching or overlapping [s, e) ranges per `keys`."""
    scanned = ordered_scan(materialize(ranges.distinct(), "ranges"), keys, ["s", "e"], {"__end": ("max_before", "e")}, keep_slices=True)
    fresh = F.col("__end").isNull() | (F.col("s") > F.col("__end"))
    marked = scanned.withColumn("__start", F.when(fresh, F.col("s"))).drop("__end")
    headed = ordered_scan(marked, keys, ["s", "e"], {"__head": ("max", "__start")})
    return headed.groupBy(*keys, "__head").agg(F.max("e").alias("e")).withColumnRenamed("__head", "s").select(*keys, "s", "e")
