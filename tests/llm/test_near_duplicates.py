import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from llm_helpers import awkward, empty, frame, prose
from pyspark.sql import functions as F

from lociweave.llm import line_dedup, simhash_dedup
from lociweave.llm.components import components


def groups(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def bits(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def serial_fingerprint(text, width=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    return bits([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles])


def near(values, k=3):
    v = np.array(values, np.uint64)
    return [(i, int(j)) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= k) + i + 1]


def balls(seed, centres=3, members=120):
    """Crowded fingerprints: random flips of a few bits around some centres, and chains of them."""
    rng, out = random.Random(seed), []
    for _ in range(centres):
        at = centre = rng.getrandbits(64)
        for _ in range(members):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
            out.append(centre ^ flips)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            out.append(at)
    return sorted(set(out))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 380)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = groups(400, [x for x in links if x[0] is not None])
    assert found == {i: w for i, w in enumerate(want) if w != i}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("joined", [1, 2, 32])
def test_links_connect_all_near_fingerprints(spark, joined):
    values = balls(joined)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    place = {v: i for i, v in enumerate(values)}
    found = [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in simhash_dedup.near_links(table, joined=joined).collect()]
    assert all(bin(values[a] ^ values[b]).count("1") <= 3 for a, b in found)
    assert groups(len(values), found) == groups(len(values), near(values))


def test_near_duplicate_documents(spark):
    base = prose(1, 300).split()
    rows = awkward() + [(100 + i, " ".join(base[:i] + ["changed"] + base[i + 1 :])) for i in range(0, 60, 3)]
    got = simhash_dedup.near_duplicates(frame(spark, rows)).collect()
    values = [serial_fingerprint(t) for _, t in rows]
    root = groups(len(rows), near(values))
    least = defaultdict(lambda: None)
    for (i, _), r in zip(rows, root):
        least[r] = i if least[r] is None else min(x for x in (i, least[r]) if x is not None) if i is not None else least[r]
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] is None, x[2] or 0)
    want = [(i, v, least[r]) for (i, _), v, r in zip(rows, values, root)]
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == sorted(want, key=key)
    kept = simhash_dedup.representatives(frame(spark, rows)).collect()
    assert len(kept) == len(set(root))
    assert {serial_fingerprint(r.text) for r in kept} <= set(values)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(x for x in least.values() if x is not None)
    assert simhash_dedup.near_duplicates(empty(spark)).count() == 0 and simhash_dedup.representatives(empty(spark)).count() == 0


def cut(word):
    """Words of more than 24 bytes, after about every fourth character, by the bytes around the place."""
    data = word.encode()
    if len(data) <= 24:
        return [word]
    out, start = [], 0
    for i in range(1, len(data)):
        last = i + 1 == len(data)
        if last or (data[i] * 131 + data[i - 1] * 31 + (data[i] >> 3)) & 3 == 0 and data[i + 1] & 0xC0 != 0x80:
            out.append(data[start : i + 1].decode())
            start = i + 1
    return out


def serial_simhash(line):
    return bits([word_hash(x) for x in {x for w in line.split(" ") for x in cut(w)}])


@pytest.mark.parametrize("part", [1, 7, 1 << 20])
def test_lines_of_texts(monkeypatch, part):
    monkeypatch.setattr(line_dedup, "PART", part)
    values = [t or "" for _, t in awkward()] + ["a b\n\nÉé_x y-z\n", "\n", "的" * 40 + "。" + "日本語" * 12 + " x"]
    found = [
        (int(r), int(n), x.text(i), int(size), int(v) % (1 << 64), int(k), int(c))
        for x in line_dedup.lines_in(values)
        for i, (r, n, size, v, k, c) in enumerate(zip(x.rows, x.numbers, x.sizes, x.simhashes(), x.keys, x.checks))
    ]
    want = []
    for row, text in enumerate(values):
        for number, line in enumerate(text.lower().split("\n")):
            words = re.findall(r"[^\W_]+", line)
            if words:
                want.append((row, number, line := " ".join(words), len(line), serial_simhash(line)))
    assert [f[:5] for f in found] == want
    assert len({f[5] for f in found}) == len({f[6] for f in found}) == len({f[2] for f in found})


def test_lines_with_one_polynomial():
    """Two words in Thue-Morse order and its complement have equal sums over powers of any odd number modulo 2 ** 64."""
    order = "0"
    while len(order) < 2048:
        order += order.translate({48: 49, 49: 48})
    lines = next(line_dedup.lines_in(["\n".join(" ".join(order.translate({48: a, 49: b})) for a, b in ("ab", "ba"))]))
    assert len(set(lines.keys.tolist())) == len(set(lines.checks.tolist())) == 2


def edits(a, b):
    row, at = np.arange(len(b) + 1), np.arange(len(b) + 1)
    other = np.array([ord(c) for c in b])
    for i, x in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (other != ord(x)))
        row = np.minimum.accumulate(np.concatenate([[i], new]) - at) + at
    return int(row[-1])


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(500):
        a, b = ("".join(rng.choice("ab c") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert line_dedup.distance(a, b) == edits(a, b)
        assert line_dedup.similar(a, b, 0.8) == (edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)


def test_edit_similarity_of_many_pairs():
    rng = random.Random(5)
    left, right = [""], [""]
    for n in [0, 1, 3, 30, 63, 64, 65, 127, 128, 129, 300, 700, 2047, 2049] * 8:
        a = [rng.choice("abcdeé日 ") for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(0, n // 4 + 1)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 2)] = [rng.choice("abcxyz語") for _ in range(rng.randint(0, 2))]
        left.append("".join(a))
        right.append("".join(b))
    got = line_dedup.similar_pairs(left, right, 0.8)
    assert got.tolist() == [edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9 for a, b in zip(left, right)]
    assert 20 < got.sum() < len(left)


def test_simhashes_of_long_runs():
    h = np.random.default_rng(1).integers(0, 1 << 63, 1300, dtype=np.uint64)
    starts = np.array([0, 1, 256, 511, 1021])
    want = [bits([int(x) for x in h[a:b]]) for a, b in zip(starts, [*starts[1:], len(h)])]
    assert line_dedup.simhashes(h, starts).view(np.uint64).tolist() == want


def mix(x):
    full = (1 << 64) - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
    return x ^ (x >> 31)


def word_hash(word):
    return mix(sum((b + 1) * (mix(i + 1) | 1) for i, b in enumerate(word.encode())) % (1 << 64))


def serial_lines(rows, min_chars=25):
    """Texts after line dedup, all pairs of lines compared; rows that agree in key and text are one document."""
    order = sorted({(i is not None, i or 0, xx, t) for i, t, xx in rows})
    where = []
    for number, (_, _, _, t) in enumerate(order):
        for at, line in enumerate((t or "").split("\n")):
            words = re.findall(r"[^\W_]+", line.lower())
            if words:
                where.append((number, at, " ".join(words)))
    lines = sorted({x[2] for x in where})
    values = [serial_simhash(x) for x in lines]
    links = [
        (a, b) for a, b in near(values, 17)
        if min(len(lines[a]), len(lines[b])) >= max(min_chars, 0.8 * max(len(lines[a]), len(lines[b])) - 1e-9) and edits(lines[a], lines[b]) <= 0.2 * max(len(lines[a]), len(lines[b])) + 1e-9
    ]
    root, seen, gone = dict(zip(lines, groups(len(lines), links))), set(), defaultdict(set)
    for number, at, x in where:
        if root[x] in seen:
            gone[number].add(at)
        seen.add(root[x])
    return {o[1:]: (None if o[3] is None else "\n".join(x for at, x in enumerate(o[3].split("\n")) if at not in gone[n])) for n, o in enumerate(order)}


@pytest.mark.parametrize("joined, cell", [(1, 16), (32, 1024)])
def test_line_dedup(spark, joined, cell):
    from pyspark.sql import functions as F

    base = prose(3, 80).split()
    variants = [(200 + i, " ".join(base[:i] + ["other"] + base[i + 1 :]) + "\n" + prose(i + 50, 12)) for i in range(40)]
    orders = [(400 + i, " ".join(sorted(base[:30], key=lambda w: hash((w, i))))) for i in range(6)]  # equal words, hence equal fingerprints
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 5000] + variants + orders
    rows += [(300, prose(50, 12).upper() + "!\n" + prose(9, 4) + "\n" + prose(9, 4)), (301, "Les.\nle\n--\nLES\nles"), (302, "日本語" * 20 + "。\n" + "日本語" * 19 + "日本人")]
    docs = frame(spark, rows)
    hashed = [(r.doc_id, r.text, r.h) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
    want = serial_lines(hashed)
    got = line_dedup.deduplicate_lines(docs, joined=joined, cell=cell)
    assert set(docs.columns) <= set(got.columns)
    found = sorted(((r.doc_id or 0, r.text or "") for r in got.collect()))
    assert found == sorted((i or 0, want[(i or 0, h, t)] or "") for i, t, h in hashed)
    assert {i: t for i, t in found}[301] == "Les.\nle\n--" and {i: t for i, t in found}[302] == "日本語" * 20 + "。"
    assert line_dedup.deduplicate_lines(empty(spark)).count() == 0


@pytest.mark.parametrize("joined, cell", [(32, 1024)])
def test_line_dedup_finds_what_edit_similarity_accepts(spark, joined, cell):
    rng = random.Random(8)
    lines, copies = [prose(1000 + i, rng.choice([6, 10, 20, 35, 60])) for i in range(120)], []
    for line in lines:
        words, allowed = line.split(), 0.2 * len(line)
        for at in rng.sample(range(len(words)), len(words)):
            changed = words[:at] + ["other"] + words[at + 1 :]
            if edits(line, " ".join(changed)) > 0.7 * allowed:
                break
            words = changed
        copies.append(" ".join(words))
    assert all(edits(a, b) <= 0.2 * max(len(a), len(b)) for a, b in zip(lines, copies))
    docs = frame(spark, [(i, line) for i, line in enumerate(lines)] + [(1000 + i, line) for i, line in enumerate(copies)])
    out = line_dedup.deduplicate_lines(docs, joined=joined, cell=cell).collect()
    assert sum(r.lines_dropped for r in out) >= 0.97 * len(lines) and all(r.lines_dropped == 0 for r in out if r.doc_id < 1000)


def test_recall_on_documents(spark):
    """Every fourth line against all lines, by exact edit similarity; links must connect nine of ten pairs at least."""
    from pyspark.sql import functions as F

    from lociweave.llm.tables import read

    docs = read(spark, "/root/testdata/sf0.001", "documents").select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("hash"), F.coalesce("text", F.lit("")).alias("text"))
    shares = []
    for joined, cell in ((32, 1024), (1, 16)):
        nodes = line_dedup.lines_of(docs, 25).groupBy("key", "check").agg(*[F.min(c).alias(c) for c in ("size", "fp", *line_dedup.SIGNATURE)])
        nodes = nodes.filter("fp is not null").withColumn("node", F.xxhash64("key", "check"))
        found = line_dedup.links(nodes, docs, joined=joined, cell=cell).collect()
        text = {r.node: (r.line_text, r.key) for r in line_dedup.line_texts(docs, nodes).join(nodes.select("node", "key"), "node").collect()}
        names = sorted(text)
        place = {x: i for i, x in enumerate(names)}
        root = groups(len(names), [(place[r.a], place[r.b]) for r in found])
        values = [text[x][0] for x in names]
        sizes = np.array(list(map(len, values)))
        pairs = []
        for i, x in enumerate(names):
            if text[x][1] % 4 == 0:
                for j in np.flatnonzero((np.minimum(sizes, sizes[i]) >= 0.8 * np.maximum(sizes, sizes[i]) - 1e-9) & (np.arange(len(names)) != i)).tolist():
                    if line_dedup.similar(values[i], values[j], 0.8):
                        pairs.append((i, j))
        shares.append((sum(root[i] == root[j] for i, j in pairs), len(pairs)))
    print("recall", shares)
    assert shares[0] == shares[1] and shares[0][0] >= 0.9 * shares[0][1] > 0


def test_rows_after_an_explode_are_not_broadcast(spark):
    """Spark sizes them as before the explode: two million keys would count as a small table and go through the driver."""
    keyed = simhash_dedup.with_keys(spark.range(100).select(F.xxhash64("id").alias("fp")), 2, 32, F.lit(0))
    few = keyed.withColumn("n", F.lit(2))
    for rows in (simhash_dedup.shared(keyed, ["key"]), simhash_dedup._joined(few, ["key"], 3)):
        assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
