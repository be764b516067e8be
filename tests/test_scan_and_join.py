"""Prefix scans and interval joins against plain loops, also when one key holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators import interval_join as ij
from lociweave.operators.scan import global_rank, ordered_scan
from lociweave.operators.similarity import salted_join
from lociweave.operators.sites import cluster_sites
from lociweave.session import materialize


def _rows(seed, n):
    rng = random.Random(seed)
    keys = ["hot"] * 3 + ["a", "b", "c"]
    return [(rng.choice(keys), i, rng.randint(-5, 20)) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("slices", [1, 7])
def test_ordered_scan(spark, slices):
    rows = _rows(1, 300)
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    out = ordered_scan(
        df, ["k"], ["o"],
        {"s": ("sum", "v"), "n": ("count", None), "m": ("max", "v"), "p": ("max_before", "v"), "l": ("lag", "v")}, slices,
    )
    got = {(r.k, r.o): (r.s, r.n, r.m, r.p, r.l) for r in out.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        seen = []
        for _, o, v in sorted(r for r in rows if r[0] == key):
            before = max(seen) if seen else None
            last = seen[-1] if seen else None
            seen.append(v)
            want[key, o] = (sum(seen), len(seen), max(seen), before, last)
    assert got == want


def test_global_rank(spark):
    rows = _rows(2, 200)
    out = global_rank(spark.createDataFrame(rows, "k string, o long, v long"), ["k", "o"], "r", 6).collect()
    assert {(r.k, r.o): r.r for r in out} == {(k, o): i for i, (k, o, _) in enumerate(sorted(rows), 1)}


@pytest.mark.parametrize("hot_rows", [5, 200_000])
def test_interval_join(spark, hot_rows):
    rng = random.Random(3)

    def make(tag, n):
        out = []
        for i in range(n):
            s = rng.randint(0, 4000) if i % 3 else 77
            out.append((rng.choice("xxy"), f"{tag}{i}", s, s + rng.choice([0, 1, 5, 300, 5000, 200_000])))
        return out

    left, right = make("l", 120), make("r", 90)
    lhs = spark.createDataFrame(left, "c string, a string, ls long, le long")
    rhs = spark.createDataFrame(right, "c string, b string, rs long, re long")
    out = ij.interval_join(lhs, rhs, ["c"], ("ls", "le"), ("rs", "re"), hot_rows=hot_rows).collect()
    got = [(r.a, r.b) for r in out]
    want = {(a, b) for c, a, s, e in left for d, b, t, f in right if c == d and s < f and t < e}
    assert len(got) == len(set(got)) and set(got) == want


def test_interval_join_finds_long_interval_from_far_left(spark):
    lhs = spark.createDataFrame([("x", "q", 500, 600)], "c string, a string, ls long, le long")
    rhs = spark.createDataFrame([("x", "long", 0, 1000), ("x", "short", 100, 150)], "c string, b string, rs long, re long")
    assert [r.b for r in ij.interval_join(lhs, rhs, ["c"], ("ls", "le"), ("rs", "re")).collect()] == ["long"]


def test_salted_join_keeps_all_pairs_of_a_hot_key(spark):
    left = spark.range(500).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("i"))
    right = spark.range(0, 500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = sorted((r.k, r.i, r.v) for r in salted_join(left, right, "k", "i", rows_per_task=20).collect())
    want = sorted((r.k, r.i, r.v) for r in left.join(right, "k").select("k", "i", "v").collect())
    assert got == want


@pytest.mark.parametrize("window", [-1, 0, 1, 10, 100])
def test_site_clusters_equal_union_find(spark, window):
    rng = random.Random(window)
    rows = []
    for i in range(150):
        s = rng.randint(1, 3000)
        rows.append((rng.choice(["c1", "c1", "c2"]), s, s + rng.choice([0, 0, 30, 200]), i, rng.choice(["u", "v"])))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1], rows[i][2], i))
    for x, i in enumerate(ordered):
        for j in ordered[x + 1:]:
            if rows[i][0] != rows[j][0] or rows[j][1] > rows[i][2] + window:
                break
            if max(0, rows[j][1] - rows[i][2] - 1) <= window:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    numbered = sorted((rows[g[0]][0], min(rows[i][1] for i in g), max(rows[i][2] for i in g), min(g), g) for g in groups.values())
    want = {i: (n, len(g)) for n, (_, _, _, _, g) in enumerate(numbered, 1) for i in g}
    df = spark.createDataFrame(rows, "chrom string, start1 long, end1 long, ordinal long, source string")
    got = {r.ordinal: (r.cluster_ord, r.cluster_n) for r in cluster_sites(df, window).collect()}
    assert got == want


def test_interval_join_shuffles_each_side_once_and_writes_it_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [("xy"[i % 2], f"i{i}", i * 3, i * 3 + i % 40) for i in range(400)]
        lhs = materialize(spark.createDataFrame(rows, "c string, a string, ls long, le long"), "given")
        rhs = spark.createDataFrame(rows, "c string, b string, rs long, re long")
        out = ij.interval_join(lhs, rhs, ["c"], ("ls", "le"), ("rs", "re"))
        plan = out._jdf.queryExecution().sparkPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "/given-" in str(out.inputFiles())
        got = sorted((r.a, r.b) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == sorted((a, b) for c, a, s, e in rows for d, b, t, f in rows if c == d and s < f and t < e)


def test_interval_join_of_one_crowded_cell(spark):
    lhs = spark.createDataFrame([("x", i, 10, 12) for i in range(60)] + [("x", 60, 9000, 9010)], "c string, a long, ls long, le long")
    rhs = spark.createDataFrame([("x", i, 11, 15) for i in range(3)] + [("x", 3, 9005, 9006)], "c string, b long, rs long, re long")
    got = sorted((r.a, r.b) for r in ij.interval_join(lhs, rhs, ["c"], ("ls", "le"), ("rs", "re"), hot_rows=7).collect())
    assert got == sorted([(a, b) for a in range(60) for b in range(3)] + [(60, 3)])


def test_interval_join_of_very_long_ranges(spark):
    far = 1 << 62
    left = [("x", "whole", -far, far - 1), ("x", "up", 0, 2 * far - 1), ("x", "point", 5, 5), ("x", "top", far + 9, far + 11)]
    right = [("x", "low", 3, 9), ("x", "high", far + 10, far + 20), ("x", "below", -9, -3), ("x", "wide", -5, far)]
    lhs = spark.createDataFrame(left, "c string, a string, ls long, le long")
    rhs = spark.createDataFrame(right, "c string, b string, rs long, re long")
    got = sorted((r.a, r.b) for r in ij.interval_join(lhs, rhs, ["c"], ("ls", "le"), ("rs", "re")).collect())
    assert got == sorted((a, b) for _, a, s, e in left for _, b, t, f in right if s < f and t < e)
