"""Steps of features on walks: values against the rules in Python, and no shuffle of the steps."""

import random

from lociweave.operators import graph as g


def _serial(features, walk, flank):
    out = []
    for contig, fid, lo, hi in features:
        rows = [w for w in walk if w[0] == contig and w[2] < hi + flank and lo - flank < w[3]]
        holder = max((w[2] for w in rows if w[2] <= lo < w[3]), default=None)
        ended = any(w[2] < hi <= w[3] for w in rows)
        for _, ordinal, s0, e0, node, rev in rows:
            parts = [("body", max(lo, s0), min(hi, e0))] if s0 < hi and lo < e0 else []
            if holder is not None and s0 < lo and (s0 == holder or e0 == holder or holder - s0 <= flank):
                parts.append(("left", max(lo - flank, s0), min(lo, e0)))
            if ended and e0 > hi:
                parts.append(("right", max(hi, s0), min(hi + flank, e0)))
            for side, a, b in parts:
                if a < b:
                    out.append((fid, side, ordinal, node, rev, a - s0 if rev == 0 else e0 - b, b - s0 if rev == 0 else e0 - a, b - a))
    return sorted(out)


def test_mapped_steps_follow_the_rules_without_a_shuffle_by_feature(spark):
    rng = random.Random(8)
    walk, at = [], {"c1": 0, "c2": 5}
    for i in range(160):
        contig = rng.choice(["c1", "c2"])
        at[contig] += rng.choice([0, 0, 0, 0, 0, 40])  # walks with holes: some ends lie in none of their rows
        size = rng.choice([3, 10, 25, 400])
        walk.append((contig, i, at[contig], at[contig] + size, rng.randint(1, 9), rng.randint(0, 1)))
        at[contig] += size
    features = []
    for i in range(60):
        lo = rng.randint(-30, 5000)
        features.append((rng.choice(["c1", "c2", "c3"]), f"f{i}", lo, lo + rng.choice([0, 1, 20, 300])))
    table = spark.createDataFrame(features, "contig string, fid string, lo long, hi long")
    steps = spark.createDataFrame(walk, "contig string, ordinal long, start0 long, end0 long, node long, rev long")
    for flank in (0, 30):
        mapped = g.map_features(table, steps, flank)
        assert sorted(map(tuple, mapped.collect())) == _serial(features, walk, flank)
        plan = mapped._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan  # the pairs of a feature and its steps stay where the join has put them
