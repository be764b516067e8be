import math
import zlib
from collections import Counter as Bag

import pytest
from llm_helpers import awkward, empty, frame

from lociweave.llm import queries, sharding


@pytest.mark.parametrize("count, bucket_bytes", [(8, 500), (8, 1 << 20), (3, 100_000)])
def test_shards(spark, tmp_path, count, bucket_bytes):
    rows = awkward() * 3 + [(7, "hot")] * 40
    docs = frame(spark, rows).repartition(4)
    sharding.scatter(docs, str(tmp_path / "s"), bucket_bytes=bucket_bytes)
    got = sharding.shards(spark, str(tmp_path / "s"), count).collect()
    assert Bag((r.record.doc_id, r.record.text) for r in got) == Bag(rows)
    assert set(got[0].record.asDict()) == set(docs.columns)
    sizes = Bag(r.shard for r in got)
    assert set(sizes) <= set(range(count)) and max(sizes[s] for s in range(count)) - min(sizes[s] for s in range(count)) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    plan = sharding.shards(spark, str(tmp_path / "s"), count)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_order_is_random(spark, tmp_path):
    rows = [(i, "x" * 40) for i in range(4000)]
    sharding.scatter(frame(spark, rows).coalesce(2), str(tmp_path / "s"), bucket_bytes=60_000)
    got = sharding.shards(spark, str(tmp_path / "s"), 4).collect()
    order = [r.record.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    n, fixed = len(order), sum(a == b for a, b in enumerate(order))
    inversions = sum(order[i] > order[i + 1] for i in range(n - 1))
    assert fixed < 12 and abs(inversions - n / 2) < 6 * math.sqrt(n / 12)
    for shard in range(4):  # every shard holds its share of any stretch of the input
        assert 350 < sum(r.shard == shard and r.record.doc_id < 1600 for r in got) < 450


def test_empty_and_small(spark, tmp_path):
    sharding.scatter(empty(spark), str(tmp_path / "e"))
    assert sharding.shards(spark, str(tmp_path / "e")).count() == 0
    sharding.scatter(frame(spark, [(1, None)]), str(tmp_path / "o"))
    assert [(r.record.doc_id, r.shard, r.slot) for r in sharding.shards(spark, str(tmp_path / "o")).collect()] == [(1, 0, 0)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op5_sharding(spark, folder).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all((r.size, r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id]) + 1, zlib.crc32(docs[r.doc_id]), "rows", None) for r in got)


def test_more_buckets_than_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 7)
    rows = [(i, "x" * 40) for i in range(600)]
    sharding.scatter(frame(spark, rows), str(tmp_path / "s"), bucket_bytes=200)
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.select("bucket").distinct().count() > 100
    assert len(list((tmp_path / "s").glob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = sharding.shards(spark, str(tmp_path / "s"), 8).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(8) for i in range(75)]
    assert sorted(r.record.doc_id for r in got) == list(range(600))
