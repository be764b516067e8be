"""Key, text and token queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as k
from ..functions import scalars as sc
from ..operators import align
from . import bridges as b
from .registry import query

FEATURES = """
feat AS (
  SELECT DISTINCT CAST(l_suppkey % 10 AS VARCHAR) AS contig,
         l_orderkey * 50 + CAST(l_linenumber AS BIGINT) * 7 AS start0,
         l_orderkey * 50 + CAST(l_linenumber AS BIGINT) * 7 + CAST(floor(l_quantity) AS BIGINT) AS end0,
         'S#0#c' || CAST(l_suppkey % 10 AS VARCHAR) || ':' || (l_orderkey * 50 + CAST(l_linenumber AS BIGINT) * 7) || '-' ||
         (l_orderkey * 50 + CAST(l_linenumber AS BIGINT) * 7 + CAST(floor(l_quantity) AS BIGINT)) AS fid
  FROM lineitem)
"""


@query("p01_feature_keys", f"""
WITH {FEATURES}
SELECT fid, regexp_extract(fid, '^([^#]+)#([^#]+)#(.+):([0-9]+)-([0-9]+)$', 1) AS sample,
       regexp_extract(fid, '^([^#]+)#([^#]+)#(.+):([0-9]+)-([0-9]+)$', 2) AS hap, 'c' || contig AS contig,
       start0, end0, greatest(0, end0 - start0) AS length, CAST(round_even((start0 + end0) / 2.0, 0) AS BIGINT) AS mid0
FROM feat""")
def feature_keys(spark, d):
    parsed = b.features(spark, d).select("fid", k.parse_feature_key(F.col("fid")).alias("p"))
    return parsed.select(
        "fid", "p.sample", "p.hap", "p.contig", "p.start0", "p.end0", k.key_length(F.col("fid")).alias("length"),
        k.midpoint(F.col("p.start0"), F.col("p.end0")).alias("mid0"),
    )


@query("p06_reverse_complement", """
SELECT doc_id, sha256(reverse(translate(text, 'ACGTNacgtn', 'TGCANtgcan'))) AS digest, CAST(length(text) AS BIGINT) AS n
FROM documents""")
def reverse_complement(spark, d):
    return b.table(spark, d, "documents").select(
        "doc_id", F.sha2(sc.reverse_complement(F.col("text")), 256).alias("digest"), F.length("text").cast("long").alias("n")
    )


@query("p07_reverse_tokens", """
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\n\\t\\r]+'), lambda x: x <> '') AS t FROM documents)
SELECT doc_id, sha256(array_to_string(list_transform(list_reverse(t), lambda x: '<' || x), '|')) AS digest, CAST(len(t) AS BIGINT) AS n
FROM w""")
def reverse_tokens(spark, d):
    tokens = F.transform(b.words(), lambda w: F.concat(F.lit(">"), w))
    return b.table(spark, d, "documents").select(
        "doc_id", F.sha2(F.array_join(sc.reverse_tokens(tokens), "|"), 256).alias("digest"),
        F.size(tokens).cast("long").alias("n"),
    )


@query("p09_storage_ids", """
SELECT page_id, 'C' || sha256('["' || replace(replace(url, '\\', '\\\\'), '"', '\\"') || '"]') AS contig_id,
       'G' || sha256('["' || url || '","' || CAST(page_id AS VARCHAR) || '"]') AS genome_id,
       'GP_' || left(sha256('W' || chr(0) || url || chr(0) || '0' || chr(0) || CAST(page_id AS VARCHAR)), 24) AS path_id
FROM pages""")
def storage_ids(spark, d):
    c = F.col
    page = c("page_id").cast("string")
    return b.table(spark, d, "pages").select(
        "page_id", k.storage_id("C", c("url")).alias("contig_id"), k.storage_id("G", c("url"), page).alias("genome_id"),
        k.path_id(F.lit("W"), [c("url"), F.lit("0"), page]).alias("path_id"),
    )


@query("p11_public_allele_ids", """
WITH t AS (SELECT conv_id, turn, trim(regexp_replace(text, '[ \\n\\t\\r]+', ' ', 'g'), ' ') AS name FROM conversations)
SELECT conv_id, CAST(turn AS BIGINT) AS turn,
       sha256(url_encode(name) || '_' || url_encode('seq ' || turn || '*~') || ':' || (turn * 10) || ':' || (turn * 10 + 5)) AS digest
FROM t""")
def public_allele_ids(spark, d):
    c = F.col
    name = F.trim(F.regexp_replace("text", "[ \\n\\t\\r]+", " "))
    seq = F.concat(F.lit("seq "), c("turn").cast("string"), F.lit("*~"))
    key = k.public_allele_id(name, seq, c("turn") * 10, c("turn") * 10 + 5)
    return b.table(spark, d, "conversations").select("conv_id", c("turn").cast("long").alias("turn"), F.sha2(key, 256).alias("digest"))


@query("p12_allele_id_collisions", """
SELECT url_encode(s) || '_' || l AS public_id, count(*) AS n
FROM (SELECT source AS s, lang AS l FROM documents) GROUP BY 1 HAVING count(*) > 1""")
def allele_id_collisions(spark, d):
    public = F.concat(k.percent_encode(F.col("source")), F.lit("_"), F.col("lang"))
    return b.table(spark, d, "documents").groupBy(public.alias("public_id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("p13_number_checks", """
WITH t AS (SELECT DISTINCT regexp_replace(w, '[^0-9+-]', '', 'g') AS t FROM
           (SELECT unnest(string_split_regex(html, '[ <>"/=?&]+')) AS w FROM pages))
SELECT t, regexp_full_match(t, '0|[1-9][0-9]*') AS canonical, regexp_full_match(t, '[0-9]+') AS whole,
       coalesce(regexp_full_match(t, '[+-]?[0-9]+') AND TRY_CAST(t AS BIGINT) > 0, FALSE) AS ins_ok,
       coalesce(regexp_full_match(t, '[+-]?[0-9]+') AND TRY_CAST(t AS BIGINT) < 0, FALSE) AS del_ok
FROM t""")
def number_checks(spark, d):
    t = F.col("t")
    words = b.table(spark, d, "pages").select(F.explode(F.split("html", '[ <>"/=?&]+')).alias("w"))
    return words.select(F.regexp_replace("w", "[^0-9+-]", "").alias("t")).distinct().select(
        "t", k.is_canonical_number(t).alias("canonical"), k.is_whole_number(t).alias("whole"),
        k.is_signed_length(t, F.lit("INS")).alias("ins_ok"), k.is_signed_length(t, F.lit("DEL")).alias("del_ok"),
    )


@query("p16_lenient_integers", """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 = 1 THEN 'None' WHEN o_orderkey % 7 = 2 THEN o_orderpriority
                  WHEN o_orderkey % 7 = 3 THEN CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) || '.75' END AS t FROM orders)
SELECT o_orderkey, t, CASE WHEN t IN ('', 'None') THEN -1 WHEN regexp_full_match(t, '[0-9]+') THEN CAST(t AS BIGINT)
       ELSE coalesce(CAST(trunc(TRY_CAST(t AS DOUBLE)) AS BIGINT), -1) END AS v FROM t""")
def lenient_integers(spark, d):
    c = F.col
    key = c("o_orderkey") % 7
    cust = c("o_custkey").cast("string")
    t = (
        F.when(key == 0, "").when(key == 1, "None").when(key == 2, c("o_orderpriority")).when(key == 3, cust)
        .otherwise(F.concat(cust, F.lit(".75")))
    )
    return b.table(spark, d, "orders").select("o_orderkey", t.alias("t")).withColumn(
        "v", k.lenient_int(c("t"), F.lit(-1).cast("long"))
    )


@query("p17_score_text", """
SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) / 7 AS v, TRY_CAST(printf('%.6f', s_acctbal / 7) AS DOUBLE) AS shown FROM supplier""")
def score_text(spark, d):
    v = F.col("s_acctbal") / F.lit(7)
    return b.table(spark, d, "supplier").select("s_suppkey", v.alias("v"), sc.score_text(v).cast("double").alias("shown"))


@query("p18_relative_strand", """
WITH t AS (SELECT CASE l_returnflag WHEN 'R' THEN '-' WHEN 'A' THEN '+' ELSE '' END ||
                  CASE WHEN l_returnflag = 'N' THEN '' WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS s FROM lineitem)
SELECT s, CASE WHEN s IN ('', '+', '-') THEN s WHEN s IN ('++', '--') THEN '+' ELSE '-' END AS strand, count(*) AS n FROM t GROUP BY 1, 2""")
def relative_strand(spark, d):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    s = F.concat(
        F.when(flag == "R", "-").when(flag == "A", "+").otherwise(""),
        F.when(flag == "N", "").when(status == "O", "+").otherwise("-"),
    )
    counted = b.table(spark, d, "lineitem").groupBy(s.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("s", sc.relative_strand(F.col("s")).alias("strand"), "n")


@query("p19_kind_priority", """
WITH r AS (SELECT s_suppkey, CASE s_nationkey WHEN 0 THEN 'reference_primary' WHEN 1 THEN 'reference_comparison' ELSE 'assembly' END AS kind FROM supplier)
SELECT s_suppkey, kind, CAST(CASE kind WHEN 'reference_primary' THEN 3 WHEN 'reference_comparison' THEN 2 ELSE 1 END AS BIGINT) AS priority,
       kind LIKE 'reference_%' AS is_reference FROM r""")
def kind_priority(spark, d):
    kind = F.when(F.col("s_nationkey") == 0, "reference_primary").when(F.col("s_nationkey") == 1, "reference_comparison").otherwise("assembly")
    return b.table(spark, d, "supplier").select("s_suppkey", kind.alias("kind")).select(
        "s_suppkey", "kind", sc.kind_priority(F.col("kind")).alias("priority"), sc.is_reference_kind(F.col("kind")).alias("is_reference")
    )


PATH_TEXT = """
w AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[ \\n\\t\\r]+'), lambda x: regexp_replace(x, '[,;<>]', '', 'g')), lambda x: x <> '') AS t
      FROM documents),
p AS (SELECT doc_id, list_transform(t, lambda x: x || CASE WHEN length(x) % 2 = 1 THEN '+' ELSE '-' END) AS t FROM w WHERE len(t) > 0)
"""


def _path_tokens(spark, d):
    kept = F.filter(F.transform(b.words(), lambda w: F.regexp_replace(w, "[,;<>]", "")), lambda w: w != "")
    signed = F.transform(kept, lambda w: F.concat(w, F.when(F.length(w) % 2 == 1, "+").otherwise("-")))
    return b.table(spark, d, "documents").select("doc_id", signed.alias("t")).filter(F.size("t") > 0)


@query("p45_path_tokens", f"""
WITH {PATH_TEXT}
SELECT doc_id, sha256(array_to_string(list_transform(t, lambda x: CASE WHEN x[-1] = '+' THEN '>' ELSE '<' END || x[:-2]), ' ')) AS digest,
       CAST(len(t) AS BIGINT) AS n FROM p""")
def path_tokens(spark, d):
    tokens = sc.path_tokens(F.array_join("t", ","))
    return _path_tokens(spark, d).select("doc_id", tokens.alias("x")).select(
        "doc_id", F.sha2(F.array_join("x", " "), 256).alias("digest"), F.size("x").cast("long").alias("n")
    )


@query("p44_walk_tokens", f"""
WITH {PATH_TEXT}
SELECT doc_id, sha256(array_to_string(list_transform(t, lambda x: CASE WHEN x[-1] = '+' THEN '>' ELSE '<' END || x[:-2]), ' ')) AS digest,
       CAST(len(t) AS BIGINT) AS n FROM p""")
def walk_tokens(spark, d):
    walk = F.array_join(
        F.transform("t", lambda x: F.concat(F.when(F.endswith(x, F.lit("+")), ">").otherwise("<"), F.substr(x, F.lit(1), F.length(x) - 1))), ""
    )
    return _path_tokens(spark, d).select("doc_id", sc.walk_tokens(walk).alias("x")).select(
        "doc_id", F.sha2(F.array_join("x", " "), 256).alias("digest"), F.size("x").cast("long").alias("n")
    )


@query("p48_overlap_status", f"""
WITH {PATH_TEXT},
o AS (SELECT doc_id, len(t) AS n, CASE doc_id % 4 WHEN 0 THEN '*' WHEN 1 THEN array_to_string(list_transform(range(len(t)), lambda x: '0M'), ',')
             WHEN 2 THEN array_to_string(list_transform(range(len(t) - 1), lambda x: '0M'), ',')
             ELSE array_to_string(list_transform(range(len(t) - 1), lambda x: '1M'), ',') END AS v FROM p)
SELECT doc_id, CASE WHEN v = '*' AND n = 1 THEN 'zero_single_segment' WHEN v = '*' THEN 'requires_link_verification'
       WHEN (CASE WHEN v = '' THEN 0 ELSE len(string_split(v, ',')) END) <> greatest(0, n - 1) THEN 'invalid_count'
       WHEN v = '' OR NOT contains(v, '1M') THEN 'zero' ELSE 'nonzero_unsupported' END AS status FROM o""")
def overlap_status(spark, d):
    n, key = F.size("t"), F.col("doc_id") % 4
    v = (
        F.when(key == 0, "*").when(key == 1, F.array_join(F.array_repeat(F.lit("0M"), n), ","))
        .when(key == 2, F.array_join(F.array_repeat(F.lit("0M"), n - 1), ","))
        .otherwise(F.array_join(F.array_repeat(F.lit("1M"), n - 1), ","))
    )
    return _path_tokens(spark, d).select("doc_id", sc.overlap_status(v, n).alias("status"))


@query("p66_replay_edit_strings", """
WITH t AS (SELECT a.conv_id, a.turn, a.text AS x, b.text AS y, length(a.text) AS n, length(b.text) AS m
           FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)
SELECT conv_id, CAST(turn AS BIGINT) AS turn, CAST(len(list_filter(range(1, least(n, m) + 1), lambda i: substr(x, i, 1) = substr(y, i, 1))) AS BIGINT) AS matches,
       CAST(greatest(n, m) AS BIGINT) AS columns, CAST(CASE WHEN n = m THEN 1 ELSE 2 END AS BIGINT) AS operations FROM t""")
def replay_edit_strings(spark, d):
    n, m = F.length("text_a"), F.length("text_b")
    tail = F.when(n > m, F.concat((n - m).cast("string"), F.lit("I"))).when(m > n, F.concat((m - n).cast("string"), F.lit("D"))).otherwise("")
    pairs = b.turns(spark, d).withColumn("cigar", F.concat(F.least(n, m).cast("string"), F.lit("M"), tail))
    played = pairs.withColumn("r", align.replay_cigar("text_a", "text_b", "cigar"))
    return played.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "r.matches", "r.columns",
        F.size(align.parse_cigar(F.col("cigar"))).cast("long").alias("operations"),
    )


@query("p60_nullable_typing", """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS BIGINT) AS n,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS v,
       CASE WHEN o_orderkey % 2 = 0 THEN 'NA' ELSE 'None' END AS label FROM orders""")
def nullable_typing(spark, d):
    c = F.col
    as_text = b.table(spark, d, "orders").select(
        "o_orderkey", F.when(c("o_orderkey") % 3 == 0, "").otherwise(c("o_custkey").cast("string")).alias("n"),
        F.when(c("o_orderkey") % 5 == 0, "").otherwise(c("o_totalprice").cast("string")).alias("v"),
        F.when(c("o_orderkey") % 2 == 0, "NA").otherwise("None").alias("label"),
    )
    return as_text.select("o_orderkey", F.nullif(c("n"), F.lit("")).cast("long").alias("n"), F.nullif(c("v"), F.lit("")).cast("double").alias("v"), "label")


@query("p68_contig_keys", """
SELECT s_suppkey, regexp_extract(s_name, '^([^#]+)#(.+)$', 1) AS sample, CAST(s_nationkey AS VARCHAR) AS hap,
       regexp_extract(s_name, '^([^#]+)#(.+)$', 2) AS contig FROM supplier""")
def contig_keys(spark, d):
    parts = F.split("s_name", "#", 2)
    key = F.concat_ws("#", parts[0], F.col("s_nationkey").cast("string"), parts[1])
    return b.table(spark, d, "supplier").select("s_suppkey", k.split_contig_key(key).alias("x")).select("s_suppkey", "x.sample", "x.hap", "x.contig")


@query("k04_fasta_lines", """
WITH s AS (SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS t FROM documents)
SELECT doc_id, sha256('>d' || doc_id || chr(10) || regexp_replace(t, '(.{60})', '\\1' || chr(10), 'g')) AS digest,
       CAST(ceil(length(t) / 60.0) AS BIGINT) AS lines FROM s""")
def fasta_lines(spark, d):
    from ..sinks.text import fasta_record

    seq = F.translate("text", "\n\r", "  ")
    return b.table(spark, d, "documents").select(
        "doc_id", F.sha2(fasta_record(F.concat(F.lit("d"), F.col("doc_id").cast("string")), seq), 256).alias("digest"),
        F.ceil(F.length(seq) / F.lit(60.0)).cast("long").alias("lines"),
    )
