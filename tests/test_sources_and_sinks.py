"""Readers, writers and key expressions on hand-made rows."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lociweave.contracts import results as rc
from lociweave.functions import intervals as iv
from lociweave.functions import keys as k
from lociweave.functions import scalars as sc
from lociweave.operators import graph as g
from lociweave.operators import stats as s
from lociweave.operators.hits import resolve_hits
from lociweave.sinks import text as sink
from lociweave.sources import genome as src
from lociweave.sources import text as st


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_ids_match_hashes_of_the_stated_text(spark):
    for names in (["a", 'q"\\'], ["Zoë\t", "漢字😀"], ["x\x7fy"]):
        row = _one(spark, k.storage_id("C", *[F.lit(n) for n in names]).alias("v"), k.path_id(F.lit("W"), [F.lit(n) for n in names]).alias("p"))
        assert row.v == "C" + hashlib.sha256(json.dumps(names, ensure_ascii=True, separators=(",", ":")).encode()).hexdigest()
        assert row.p == "GP_" + hashlib.sha256("\0".join(["W", *names]).encode()).hexdigest()[:24]
    row = _one(spark, k.public_allele_id(F.lit("a b*~"), F.lit("é/_-."), F.lit(1), F.lit(5)).alias("v"))
    assert row.v == "a%20b%2A~_%C3%A9%2F_-.:1:5"


def test_rejections(spark):
    bad = [
        k.parse_feature_key(F.lit("a#b")), k.whole_number(F.lit("+5")), k.signed_length(F.lit("-3"), F.lit("INS")), sc.flip_token(F.lit("x")),
        sc.relative_strand(F.lit("+*")), sc.path_tokens(F.lit("a+;b-")), sc.walk_tokens(F.lit(">a b")), k.split_contig_key(F.lit("a#b")),
        k.public_allele_id(F.lit(" a"), F.lit("b"), F.lit(1), F.lit(2)),
    ]
    for column in bad:
        with pytest.raises(Exception):  # noqa: B017
            spark.range(1).select(column.alias("v")).collect()


def test_tokens_and_overlaps(spark):
    row = _one(
        spark, sc.walk_tokens(F.lit(">unitig-A<segment.2")).alias("w"), sc.path_tokens(F.lit("1+,2-")).alias("p"),
        sc.reverse_complement(F.lit("ACGTNac")).alias("r"), sc.reverse_tokens(F.array(F.lit(">1"), F.lit("<2"))).alias("t"),
        sc.spaced_shingles(F.split(F.lit("a b c d e f g h i j k l m n o"), " "), 3, 8).alias("s"),
    )
    assert row.w == [">unitig-A", "<segment.2"] and row.p == [">1", "<2"] and row.r == "gtNACGT" and row.t == [">2", "<1"]
    words = "a b c d e f g h i j k l m n o".split()
    assert row.s == ["|".join(words[i:i + 3]) for i in sorted({round(i * 12 / 7) for i in range(8)})]


def test_event_hits_and_mechanisms(spark):
    def hit(a, b):
        return iv.event_hit(F.lit(a), F.lit(b), F.lit("DEL"), F.lit(500), F.lit(500)).alias(f"h{a}")

    assert list(_one(spark, hit(400, 600), hit(500, 600))) == [True, False]
    cases = {(1, 1, 1, 1): "INS+DEL", (1, 1, 1, 0): "INS-internal", (0, 1, 1, 0): "INS-junction", (0, 0, 1, 0): "INS-spanning", (0, 0, 0, 1): "DEL-junction", (0, 0, 0, 0): "non-SV"}
    for flags, want in cases.items():
        assert _one(spark, iv.mechanism_class(*[F.lit(bool(f)) for f in flags]).alias("v")).v == want


def test_hit_labels(spark):
    rows = [
        ("one", 1.0, 0.9, 90, 1, 90, "c", 0, 90, "+"), ("tie", 1.0, 0.9, 90, 1, 90, "c", 0, 90, "+"), ("tie", 1.0, 0.9, 85, 1, 90, "d", 0, 90, "+"),
        ("two", 1.0, 0.9, 90, 1, 90, "c", 0, 90, "+"), ("two", 0.5, 0.9, 90, 1, 90, "d", 0, 90, "+"), ("low", 1.0, 0.2, 20, 1, 20, "c", 0, 20, "+"),
    ]
    names = "fid string, identity double, coverage double, aligned_bp long, block_n long, span_bp long, chrom string, start0 long, end0 long, strand string"
    got = {r.fid: (r.label, r.chrom) for r in resolve_hits(spark.createDataFrame(rows, names)).collect()}
    assert got == {"one": ("unique", "c"), "tie": ("ambiguous_tie", None), "two": ("multi_clear_primary", "c"), "low": ("low_quality", None)}


def test_walks_round_trip_by_partition(spark, tmp_path):
    (tmp_path / "walk.tsv").write_text("c1\t0\t3\t>7\nc1\t3\t5\t<8\n")
    walk = src.read_path_table(spark, str(tmp_path / "walk.tsv")).withColumns({"genome": F.lit("g"), "ordinal": F.col("start0")})
    assert g.discontinuities(walk.withColumn("path_id", F.col("contig"))).count() == 0
    sink.write_path_table(walk, str(tmp_path / "walks"))
    back = spark.read.parquet(str(tmp_path / "walks")).filter("genome = 'g' and contig = 'c1'").orderBy("start0").collect()
    assert [(r.node, r.rev) for r in back] == [("7", 0), ("8", 1)]


def test_id_list_and_tables(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# note\nx\tlocus_id\n1\tL2\n2\tL1\n3\tL2\n")
    assert [r.locus_id for r in st.read_id_list(spark, str(tmp_path / "ids.txt")).orderBy("ordinal").collect()] == ["L2", "L1"]
    df = spark.createDataFrame([("NA", None), ("None", 3)], "a string, b long")
    sink.write_table(df, str(tmp_path / "t"), ["a", "b"])
    back = st.read_table(spark, str(tmp_path / "t"), ["a", "b"])
    assert sorted(map(tuple, back.collect())) == [("NA", ""), ("None", "3")]
    with pytest.raises(ValueError):
        sink.write_table(df, str(tmp_path / "u"), ["a", "c"])
    sink.write_json_lines(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert json.loads(sink.table_schema({"t": df}, {"t": ["a"]}, {}))["tables"]["t"]["primary_key"] == ["a"]


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 note\nacgt\nAC\n>s2\nGG\n")
    assert {r.name: r.sequence for r in src.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {"s1": "ACGTAC", "s2": "GG"}
    chunks = src.read_fasta_lines(spark, str(tmp_path / "a.fa"))
    wanted = spark.createDataFrame([("f", "s1 note", 2, 6), ("h", "s2", 1, 5)], "fid string, name string, lo long, hi long")
    out = src.extract_intervals(chunks, wanted)
    assert {r.fid: r.sequence for r in out.collect()} == {"f": "GTAC", "h": "G"}
    assert [r.reason for r in src.incomplete_extractions(out).collect()] == ["sequence_length_mismatch"]
    (tmp_path / "b.fa").write_text("AC\n>s\nA\n")
    with pytest.raises(Exception, match="before header"):
        src.read_fasta(spark, str(tmp_path / "b.fa")).collect()


def test_accounting_and_shards(spark):
    ids = spark.range(5).select(F.col("id").cast("string").alias("fid"))
    assert rc.accounting(ids, ids.filter("fid < 3"), ids.filter("fid >= 3"), "fid").first().closed
    assert not rc.accounting(ids, ids, ids.filter("fid >= 3"), "fid").first().closed
    loci = spark.createDataFrame([("10",), ("9",), ("x",), ("2",)], "locus_id string")
    assert [r.locus_id for r in s.select_loci(loci).orderBy("index").collect()] == ["2", "9", "10", "x"]
    parts = [{r.locus_id for r in s.select_loci(loci, shard_count=3, shard_index=i).collect()} for i in range(3)]
    assert parts == [{"2"}, {"9"}, {"10", "x"}]
    with pytest.raises(Exception, match="several shards"):
        s.merge_shards([loci, loci], loci.withColumn("rank", F.lit(1).cast("long"))).collect()
