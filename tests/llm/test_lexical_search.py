import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import awkward, empty, frame, prose
from pyspark.sql import types as T

from lociweave.llm import lexical_search

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERMS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, top):
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, Counter(w), len(w)) for i, w in docs if w]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    held = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(found)[:top], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


def benchmark(spark, rows):
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("rank", T.IntegerType()), T.StructField("score", T.StringType())])
    return spark.createDataFrame([(*r, 1, "x") for r in rows], schema)


def cases():
    rng = random.Random(3)
    docs = awkward() + [(1000 + i, prose(rng.randint(1, 6), rng.randint(1, 90))) for i in range(300)] + [(5000 + i, "tied words here") for i in range(90)]
    items = [(i, prose(rng.randint(1, 6), rng.randint(1, 30))) for i in range(25)]
    items += [(100, "Tied WORDS here, once"), (101, None), (102, ""), (103, "?!"), (104, "İ ß 日本語 it"), (1, "a b c"), (1, "a b c"), (None, "one two three"), (105, "nowhere to be found")]
    return docs, items


@pytest.mark.parametrize("bucket, head, block_bytes, top", [(4096, 64, 2 << 20, 50), (7, 64, 300, 5), (1, 2, 2 << 20, 50), (64, 1, 1000, 1)])
def test_equals_brute_force(spark, monkeypatch, bucket, head, block_bytes, top):
    monkeypatch.setattr(lexical_search, "BUCKET", bucket)
    monkeypatch.setattr(lexical_search, "HEAD", head)
    docs, items = cases()
    got = lexical_search.top_documents(frame(spark, docs), benchmark(spark, items), top=top, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(tuple(r) for r in got.collect()) == order(brute_force(docs, items, top))


def test_empty_tables(spark):
    docs, items = cases()
    assert lexical_search.top_documents(empty(spark), benchmark(spark, items)).count() == 0
    assert lexical_search.top_documents(frame(spark, docs), benchmark(spark, [])).count() == 0
    assert lexical_search.top_documents(frame(spark, [(1, None), (2, "..")]), benchmark(spark, items)).count() == 0


def test_bounds_prune_and_keep(monkeypatch):
    """Buckets of short vectors are never opened, most others are cut down before they are scored, and no hit is lost."""
    rng = np.random.default_rng(4)
    items = lexical_search.Items([(0, "aa bb cc dd")])
    items.weigh(1000, np.array([2, 20, 200, 900]))
    seen = []
    scores = lexical_search.Bucket.scores
    monkeypatch.setattr(lexical_search.Bucket, "scores", lambda self, docs, weights: seen.append(len(docs)) or scores(self, docs, weights))
    vectors = [np.where(rng.random(4) < 0.6, rng.integers(1, 1000, 4), 0) * scale for scale in (1000, 300, 100, 30, 1) for _ in range(400)]
    exact = sorted((int((v * items.weights).sum()) for v in vectors), reverse=True)[:10]
    best = [lexical_search.Best(1, 10)]
    for start in range(0, len(vectors), 400):
        part = vectors[start : start + 400]
        lengths = np.array([math.sqrt((items.weights * v.astype(float) ** 2).sum()) for v in part])
        held = [np.flatnonzero(v) for v in part]
        bucket = lexical_search.Bucket(lengths, np.array(list(map(len, held))), np.concatenate(held), np.concatenate([v[h] for v, h in zip(part, held)]), items.weights)
        lexical_search.search(bucket, np.zeros(400, bool), np.arange(start, start + 400), items, best)
    assert best[0].scores.tolist() == exact
    assert len(seen) < 5 and sum(seen) < 1000
