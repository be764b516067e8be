import gzip

import pytest

from lociweave.sinks import text as sink
from lociweave.sources import genome as src
from lociweave.sources import text as st


def test_cells_of_strict_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("a\tb\nx\ty z\n")
    assert st.read_table(spark, str(tmp_path / "a.tsv"), ["a", "b"]).first().b == "y z"
    assert st.table_columns(spark, str(tmp_path / "a.tsv")) == ["a", "b"]
    (tmp_path / "b.tsv").write_text("a\tb\nx\t y\n")
    with pytest.raises(Exception, match="blanks around a cell"):
        st.read_table(spark, str(tmp_path / "b.tsv"), ["a", "b"]).collect()


def test_single_record_fasta(spark, tmp_path):
    (tmp_path / "one.fa").write_text(">s\nAC\nGT\n")
    assert src.read_single_fasta(spark, str(tmp_path / "one.fa")).count() == 2
    for name, text in (("two.fa", ">s\nA\n>t\nC\n"), ("none.fa", ">s\n"), ("twice.fa", ">s\nA\n>s\nC\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError, match="exactly one"):
            src.read_single_fasta(spark, str(tmp_path / name))


def psl(fid):
    return "\t".join([fid, "90", "5", "0", "0", "0", "0", "0", "0", "+", fid, "100", "0", "100", "chr1", "1000", "10", "110", "1", "100,", "0,", "10,"])


def test_known_ids_of_alignments(spark, tmp_path):
    features = spark.createDataFrame([("s#0#c:0-100",), ("s#0#c:200-300",)], "fid string")
    with_names = [x for x in src.PSL]
    line = dict(zip(range(30), psl("s#0#c:0-100").split("\t")))
    (tmp_path / "a.psl").write_text("\t".join(line[i] for i in range(len(with_names))) + "\n")
    _, counts = src.read_known_psl(spark, str(tmp_path / "a.psl"), features)
    assert {r.fid: r.hit_n for r in counts.collect()} == {"s#0#c:0-100": 1, "s#0#c:200-300": 0}
    with pytest.raises(ValueError, match="unknown feature ids"):
        src.read_known_psl(spark, str(tmp_path / "a.psl"), features.filter("fid like '%300'"))


def test_feature_json(spark, tmp_path):
    with gzip.open(tmp_path / "f.json.gz", "wt") as file:
        file.write('{"fid": "a", "start0": 1, "tokens": [">1"]}\n\n{"fid": "b", "other": 2}\n')
    assert {(r.fid, r.start0) for r in src.read_feature_json(spark, str(tmp_path / "f.json.gz")).collect()} == {("a", 1), ("b", None)}
    (tmp_path / "bad.json").write_text("{not json\n")
    with pytest.raises(Exception):
        src.read_feature_json(spark, str(tmp_path / "bad.json")).collect()


def test_catalogue(spark, tmp_path):
    columns = [*src.CATALOGUE_REQUIRED, "sv_tsv"]
    row = ["s1", "assembly", "s", "0", "g", "x.bed", "x.fa", "dir", "x.tsv"]
    (tmp_path / "c.tsv").write_text("\t".join(columns) + "\n" + "\t".join(row) + "\n")
    assert src.read_catalogue(spark, str(tmp_path / "c.tsv"), columns).count() == 1
    (tmp_path / "d.tsv").write_text("\t".join(columns) + "\n" + "\t".join([*row[:-1], ""]) + "\n" + "\t".join(["s2", "odd", *row[2:]]) + "\n")
    with pytest.raises(ValueError, match="empty fields: sv_tsv.*unsupported kind: odd"):
        src.read_catalogue(spark, str(tmp_path / "d.tsv"), columns)


def test_sinks(spark, tmp_path):
    walks = spark.createDataFrame([("g", "c", i, i * 5, i * 5 + 5, i, 0) for i in range(4)], "genome string, contig string, ordinal long, start0 long, end0 long, node long, rev long")
    one, again = sink.path_table_statistics(walks).first(), sink.path_table_statistics(walks.repartition(3, "node")).first()
    assert one == again and (one.row_count, one.start0, one.end0) == (4, 0, 20)
    assert sink.path_table_statistics(walks.filter("node < 3")).first().digest != one.digest
    features = spark.createDataFrame([("c1", 5, 9, "f"), ("c1", 0, 3, "e")], "contig string, start0 long, end0 long, fid string")
    names = spark.createDataFrame([("c1", "chrOne")], "contig string, sequence string")
    sink.write_bed4(features, names, str(tmp_path / "b"))
    assert [r.value for r in spark.read.text(str(tmp_path / "b")).collect()] == ["chrOne\t0\t3\te", "chrOne\t5\t9\tf"]
    with pytest.raises(Exception, match="no name for contig"):
        sink.named_bed4(features, names.filter("contig = 'x'")).collect()
    sink.write_parquet(features, str(tmp_path / "p"), ["contig"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
