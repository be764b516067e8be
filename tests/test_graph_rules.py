import pytest

from lociweave.operators import graph as g
from lociweave.plans.catalogue import walks_from_graph

SEGMENTS = ["S\tA\tACGT", "S\tB\tAC", "S\tC\tG", "L\tA\t+\tB\t+\t0M", "L\tB\t+\tC\t-\t0M"]


def table(spark, records):
    return spark.createDataFrame([(line, i) for i, line in enumerate(SEGMENTS + records)], "line string, line_no long")


def problems(spark, records):
    lines = table(spark, records)
    nodes = g.number_segments(g.segments(lines), False)
    found = g.path_violations(g.path_records(lines), nodes, g.link_table(g.links(lines)))
    return sorted(r.problem for r in found.collect())


@pytest.mark.parametrize("records, want", [
    (["P\tp\tA+,B+\t0M"], []),
    (["P\tp\tA+,B+,C-\t*"], []),
    (["P\tp\tA+,X+,B+\t0M,0M"], ["undefined_segment"]),
    (["P\tp\tA+,C+\t*"], ["unverified_link"]),
    (["P\tp\tA+,B+\t1M"], ["unsupported_overlap"]),
    (["P\tp\tA+,B+\t0M", "P\tp\tB+\t*"], ["duplicate_path"]),
    (["W\ts\t0\tc\t0\t4\t>A", "W\ts\t0\tc\t4\t6\t>B"], []),
    (["W\ts\t0\tc\t0\t4\t>A", "W\ts\t0\tc\t9\t11\t>B"], ["fragment_gap"]),
    (["W\ts\t0\tc\t0\t5\t>A"], ["span_mismatch"]),
])
def test_path_rules(spark, records, want):
    assert problems(spark, records) == want


def test_no_walk_of_a_broken_graph(spark):
    lines = table(spark, ["P\tp\tA+,X+,B+\t0M,0M"])
    key = g.path_records(lines).first().gfa_path_id
    paths = spark.createDataFrame([(key, "g", "c")], "gfa_path_id string, genome string, contig string")
    with pytest.raises(ValueError, match="undefined_segment"):
        walks_from_graph(lines, paths)
    with pytest.raises(ValueError, match="missing_path"):
        walks_from_graph(table(spark, []), paths)


def test_undefined_segments_stop_unfolding(spark):
    steps = spark.createDataFrame([("p", 0, "A", 0), ("p", 1, "X", 0)], "path_id string, ordinal long, segment string, rev long")
    with pytest.raises(Exception, match="undefined segment"):
        g.unfold(steps, g.number_segments(g.segments(table(spark, [])), False)).collect()
