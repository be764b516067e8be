from lociweave.operators import graph as g
from lociweave.operators import scan
from lociweave.plans import bridges as b
from lociweave.plans import graphs


def test_edge_status_scans_the_steps_once(spark, monkeypatch):
    columns = ", ".join(f"{c} {'string' if c in ('l_returnflag', 'l_linestatus', 'l_shipdate') else 'long'}" for c in b.WALK_ORDER)
    parts = {1: [(7, "N", "O"), (8, "R", "O"), (9, "N", "F")], 2: [(7, "N", "F"), (8, "R", "F")], 11: [(9, "N", "O"), (9, "N", "O"), (7, "N", "O")]}
    rows = [(o, i, p, 1, 1, 1, 0, 0, flag, status, "d") for o, lines in parts.items() for i, (p, flag, status) in enumerate(lines)]
    lines = spark.createDataFrame(rows, columns)
    monkeypatch.setattr(b, "table", lambda *_: lines)
    written, real = [], scan.materialize
    monkeypatch.setattr(scan, "materialize", lambda df, label="stage": written.append(label) or real(df, label))
    got = sorted(map(tuple, graphs.edge_status(spark, "").collect()))
    assert written == ["scan"]
    steps, order = b.order_edges(spark, "")
    serial = g.edge_status(steps, graphs._links(graphs._edges(spark, "")), "l_orderkey", order)
    assert got == sorted(map(tuple, serial.groupBy("l_orderkey", "status").count().collect()))
    assert got == [(1, "missing_link", 1), (1, "zero", 1), (2, "zero", 1), (11, "link_overlap_unsupported", 2)]
