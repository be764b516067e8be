"""Alignment with a cell's score, matches and columns in one number, and how pairs are spread."""

import random

import pytest

from lociweave.operators import align
from lociweave.operators import alleles as al


def _texts(rng, letters):
    a = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
    if rng.random() < 0.4:
        return a, "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
    b = "".join(rng.choice(["", c, c, c, c, c, c + rng.choice(letters), rng.choice(letters)]) for c in a)
    return a, b or "a"


@pytest.mark.parametrize("costs", [(2, -3, 5, 2, True), (0, -4, 8, 2, False), (1, -1, 1, 1, True), (1, -1, 0, 0, False)])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh "])
def test_packed_cells_equal_separate_tables(costs, letters):
    rng = random.Random(7)
    for _ in range(40):
        pairs = [_texts(rng, letters) for _ in range(rng.randint(1, 12))]
        assert align._packed_counts(pairs, *costs).tolist() == align._wide_counts(pairs, *costs).tolist()


def test_longest_texts_fit_and_longer_ones_use_separate_tables(monkeypatch):
    n = align.PACKED_LENGTH
    for costs in ((2, -3, 5, 2, True), (0, -4, 8, 2, False)):
        pairs = [("a" * n, "a" * n), ("a" * 50, "c" * n)]
        assert align._packed_counts(pairs, *costs).tolist() == align._wide_counts(pairs, *costs).tolist()
    monkeypatch.setattr(align, "_packed_counts", None)
    assert align.alignment_counts("a" * (n + 1), "a", 2, -3, 5, 2, True) == (1, 1)


def test_pairs_are_not_joined_up_by_their_bytes(spark):
    rows = [(1, 0, f"k{i:02}", "acgt" * 5 + "acgt"[i % 4] * (1 + i // 4), 21 + i // 4) for i in range(16)]
    sequences = spark.createDataFrame(rows, "locus_id long, band long, seq_key string, seq string, length long")
    pairs = al.similar_pairs(sequences)
    assert pairs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert pairs.count() == 120
