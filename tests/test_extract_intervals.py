from lociweave.sources import genome as src


def test_wanted_intervals_are_evaluated_once(spark):
    chunks = spark.createDataFrame([("a", 0, 4, "ACGT"), ("a", 4, 6, "TT"), ("b", 0, 3, "GGC")], "name string, start0 long, end0 long, bases string")
    rows = [("x", "a", 2, 5), ("y", "a", 5, 9), ("z", "b", 0, 3), ("none", "c", 0, 3)]
    out = src.extract_intervals(chunks, spark.createDataFrame(rows, "fid string, name string, lo long, hi long"))
    read = out.inputFiles()
    assert any("/wanted-" in f for f in read) and not any("/left-" in f for f in read)
    got = sorted((r.fid, r.sequence, r.observed_bp) for r in out.collect())
    assert got == [("none", "", 0), ("x", "GTT", 3), ("y", "T", 1), ("z", "GGC", 3)]
