import gzip
import hashlib
import os
import random
from collections import defaultdict

import pytest
from llm_helpers import CLASHING, prose
from pyspark.sql import types as T

from lociweave.llm import queries, warc
from lociweave.llm.tables import read

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       *[T.StructField(c, T.IntegerType()) for c in [*CLASHING, "number", "payload", "original", "bytes", "part"]]])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *range(len(SCHEMA) - 3)) for r in rows], SCHEMA)


def pages():
    rng, long = random.Random(2), prose(1, 400)
    rows = [(i, f"http://WWW.site{rng.randrange(9)}.example.org/p{rng.randrange(4)}?b=1&a", prose(rng.randint(1, 5), 200 + rng.randrange(3))) for i in range(150)]
    rows += [(i, "http://hot.example/", long) for i in range(1000, 1090)]
    rows += [(7777, "https://a.example/x", long), (7777, "https://a.example/x", long), (None, None, long), (None, "x\r\ny", None), (1, "", ""), (2, "http://[bad", "\r\n\r\nWARC/1.1\r\n\r\n")]
    rows += [(3, "http://é.example/ü", "x" * 999), (4, "http://é.example/ü", "x" * 999), (5, "http://e.example:8080/", "x" * 1000), (6, "http://e.example:80/#f", "x" * 1000), (-9, "u", "é" * 500), (8, "u", "é" * 500)]
    return rows + [(9000, "http://long.example/", "\x00é" * 600_000)]


def brute_force(rows):
    last = defaultdict(list)
    for key, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000:
            last[payload].append(key)
    out = []
    for payload in [(html or "").encode() for _, _, html in rows]:
        out.append((len(payload), hashlib.sha1(payload).hexdigest()))
    answers = defaultdict(list)
    for (key, url, _), (n, digest), payload in zip(rows, out, [(h or "").encode() for _, _, h in rows]):
        top = max((k for k in last[payload] if k is not None), default=None) if payload in last else None
        revisit = len(last.get(payload, ())) > 1 and key != top
        answers[(key, n, digest)].append(("revisit", top) if revisit else ("response", None))
    for (key, n, digest), kinds in answers.items():  # of equal rows one is the response
        if len(kinds) > 1 and n >= 1000:
            kinds[1:] = [("revisit", key)] * (len(kinds) - 1)
    return sorted([(str(k), n, d, *map(str, x)) for (k, n, d), kinds in answers.items() for x in kinds])


@pytest.mark.parametrize("segment, run, span", [(1 << 20, 1 << 16, 200_000), (3000, 5, 40), (1, 1, 10)])
def test_round_trip(spark, monkeypatch, segment, run, span):
    for name, value in (("SEGMENT", segment), ("RUN", run), ("RANGE", span)):
        monkeypatch.setattr(warc, name, value)
    rows, path = pages(), warc.new_path(spark)
    warc.write(frame(spark, rows).repartition(3), path)
    got = warc.read(spark, path, payloads=True).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == brute_force(rows)
    # the index is in global order, without gaps, and every capture leads to the record of its page
    got.sort(key=lambda r: r.place)
    assert [r.place for r in got] == list(range(len(rows)))
    order = [(r.url_key, r.seconds) for r in got]
    assert order == sorted(order)
    assert sorted(order) == sorted((warc.url_key(u), (k or 0) % warc.SECONDS) for k, u, _ in rows)
    held = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    assert sorted(map(bytes, held.values())) == sorted({(h or "").encode() for _, _, h in rows})
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert {r.url for r in got} == {None if u is None else warc.one_line(u) for _, u, _ in rows}


def test_files(spark, tmp_path):
    path, folder = warc.new_path(spark), str(tmp_path)
    warc.write(frame(spark, pages()), path)

    def save(name, data):
        with open(os.path.join(folder, name), "wb") as out:
            out.write(data)

    warc.export(spark, path, save)
    text = b"".join(gzip.open(os.path.join(folder, n)).read() for n in sorted(os.listdir(folder)))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.count(b"WARC-Record-ID: <urn:capture:") == len(pages())


def test_empty_and_damaged(spark):
    path = warc.new_path(spark)
    warc.write(frame(spark, []), path)
    assert warc.read(spark, path).count() == 0
    good = warc.record(1, 2, "http://x.example/", 5, b"payload", None)
    assert warc.read_record(good)[:2] == (1, "http://x.example/")
    for bad in (good.replace(b"payload", b"Payload"), good[:-1], b"", good.replace(b"WARC/1.1", b"HTTP/1.1")):
        with pytest.raises(ValueError):
            warc.read_record(bad)
    with pytest.raises(ValueError):
        list(warc.members(warc.packed(good)[:-3]))


def test_loser_tree():
    rng = random.Random(1)
    for k in range(12):
        runs = [sorted((rng.randrange(50), rng.randrange(9)) for _ in range(rng.choice([0, 1, 7, 30]))) for _ in range(k)]
        assert list(warc.LoserTree(list(map(iter, runs)))) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www2.Example.org:80/A/?b&a#x") == "org,example)/a?a&b"
    assert warc.url_key("https://example.org:8443") == "org,example:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("Just Words") == "just%20words"


def test_query(spark):
    rows = [tuple(r) for r in read(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url", "html").collect()]
    got = queries.op12_warc(spark, "/root/testdata/sf0.01").collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == brute_force(rows)
