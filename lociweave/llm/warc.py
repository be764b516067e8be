"""WARC archives of web pages, with revisit records, and an index of all captures that is merged from sorted runs.

Writing. Pages get a number of their own and are stored with it. Payloads of at least `least_bytes` that occur more than once are
found by their SHA-256; the one with the largest key (then number) of each group becomes a response record, the others revisit records
that name it. Every record is a gzip member of its own. A row of the archive table holds a segment: members one after another, which is a
valid `.warc.gz` file (`export` writes them as files). The table is Parquet, so that Spark's commit protocol covers lost executors and
any shared store will do.

Index. While a task writes segments it keeps a capture per record: URL key (host labels reversed, path and sorted query in lower case),
time, number, place. Every `RUN` captures are sorted and written as a run. The runs are dealt by ranges of (URL key, time, number); in each
range a loser tree merges the pieces of all runs, which are sorted already. The ranges one after another are the captures of all
archives in global order, so the captures of a URL stand together, oldest first.

Reading. Every segment is unpacked and its records are parsed; payloads are counted and hashed anew, and a digest that differs from the
stated one stops the job. A record reaches the result through its capture in the merged index, by place.

Defined results: null html is an empty payload; empty payloads are response records; a null key is stated as such, counts as the
smallest and is null again after reading; equal rows are captures of their own, one of which is the response; ties in URL key and time
are ordered by number; a null or malformed URL is its own key; an empty table has no captures; a record longer than a segment is a segment
of its own; other columns are not read. Keys are integers. Without a time column a capture's time is its key in seconds (null: 0).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_root
from .tables import dropped, slices, stored

LEAST_BYTES = 1000
#: Compressed bytes of a segment, captures of a run, and captures of a merged range, about.
SEGMENT, RUN, RANGE = 1 << 20, 1 << 16, 200_000
#: Bytes that the unpacker takes at a time.
FED = 1 << 13
#: Seconds from the first to the last moment that a WARC date can state, from 1970 on.
SECONDS = 253_402_300_800

UNSAFE = re.compile(r"[\x00-\x20\x7f]")
WWW = re.compile(r"^www\d*\.")
PORTS = {"http": 80, "https": 443}


def one_line(url: str) -> str:
    """Percent-encoded where a header line could break."""
    return UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str | None) -> str:
    """`http://www.Example.org:80/A/?b&a#x` has the key `org,example)/a?a&b`."""
    whole = one_line((url or "").strip())
    try:
        parts = urlsplit(whole)
        host, port = parts.hostname, parts.port
    except ValueError:
        host, port = None, None
    if not host:
        return whole.lower()
    labels = ",".join(reversed(WWW.sub("", host).split(".")))
    shown = "" if port is None or port == PORTS.get(parts.scheme) else f":{port}"
    path = parts.path.lower().rstrip("/") or "/"
    query = "?" + "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return f"{labels}{shown}){path}{query}"


def date(seconds: int) -> str:
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")


def name_of(key: int | None, number: int) -> str:
    return f"<urn:capture:{'none' if key is None else key}:{number}>"


def key_of(name: str) -> int | None:
    key = name.split(":")[2]
    return None if key == "none" else int(key)


REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(key: int | None, number: int, url: str | None, seconds: int, payload: bytes, original: tuple | None) -> bytes:
    """A WARC record, uncompressed. `original` is (key, number, url, seconds) of the capture that it revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if original else 'response'}", f"WARC-Record-ID: {name_of(key, number)}", f"WARC-Date: {date(seconds)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}")
    if original:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name_of(*original[:2])}", f"WARC-Refers-To-Date: {date(original[3])}"]
        if original[2] is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {one_line(original[2])}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of a record, headers of the HTTP answer inside it, and the payload."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the length of record {fields.get('WARC-Record-ID')} is wrong")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def packed(data: bytes) -> bytes:
    worker = zlib.compressobj(6, zlib.DEFLATED, 31)
    return worker.compress(data) + worker.flush()


def members(segment: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of every gzip member."""
    start, view = 0, memoryview(segment)
    while start < len(segment):
        worker, parts, end = zlib.decompressobj(31), [], start
        while not worker.eof:
            if end >= len(segment):
                raise ValueError("a member of a segment is cut off")
            parts.append(worker.decompress(view[end : end + FED]))
            end = min(end + FED, len(segment))
        end -= len(worker.unused_data)
        yield start, end - start, b"".join(parts)
        start = end


class LoserTree:
    """Merges sorted iterators: an inner node keeps the loser of its match, so that the next winner replays one path only."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * len(runs)
        self.winner = -1
        for i in range(len(runs)):
            self.play(i, building=True)

    def before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def play(self, i: int, building: bool = False) -> None:
        at = (i + len(self.runs)) // 2
        while at:
            other = self.losers[at]
            if building and other < 0:
                self.losers[at] = i
                return
            if self.before(other, i):
                self.losers[at], i = i, other
            at //= 2
        self.winner = i

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and (head := self.heads[self.winner]) is not None:
            yield head
            i = self.winner
            self.heads[i] = next(self.runs[i], None)
            self.play(i)


CAPTURE = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("seconds", T.LongType()), T.StructField("number", T.LongType()),
    T.StructField("block", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
])
#: A row holds either a segment or a run of captures, both numbered in `block`.
ARCHIVE = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("data", T.BinaryType()), T.StructField("run", T.ArrayType(CAPTURE))])


def with_originals(captures: DataFrame, least_bytes: int) -> DataFrame:
    """number, original: the captures that revisit another one, and that one's key, number, url and seconds."""
    narrow = captures.filter(F.col("bytes") >= least_bytes)
    one = F.struct("key", "number", "url", "seconds")
    # the largest key with nulls first, then the largest number
    groups = narrow.groupBy("identity").agg(F.max(F.struct(F.col("key").isNotNull().alias("some"), "key", "number", "url", "seconds")).alias("last"), F.count(F.lit(1)).alias("n"))
    groups = groups.filter("n > 1").select("identity", F.struct("last.key", "last.number", "last.url", "last.seconds").alias("original"))
    return narrow.select("identity", one.number.alias("number")).join(groups, "identity").filter(F.col("number") != F.col("original.number")).select("number", "original")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", seconds: str | None = None, least_bytes: int = LEAST_BYTES) -> None:
    """Archive all pages, with the runs of their captures, as a table at `path`."""
    payload = F.coalesce(pages[html].cast("string"), F.lit("")).cast("binary")
    time = F.coalesce((pages[seconds] if seconds else pages[key]).cast("long"), F.lit(0))
    captures = pages.select(
        F.monotonically_increasing_id().alias("number"), pages[key].cast("long").alias("key"), pages[url].cast("string").alias("url"),
        F.pmod(time, F.lit(SECONDS)).alias("seconds"), F.octet_length(payload).alias("bytes"), F.sha2(payload, 256).alias("identity"), payload.alias("payload"),
    )
    captures = stored(captures, "warc-captures")
    originals = stored(with_originals(captures, least_bytes), "warc-originals")
    layout = to_arrow_schema(ARCHIVE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, size, held, runs, captured = TaskContext.get().partitionId(), 0, 0, [], 0, []

        def row(number: int, data: bytes | None, run: list[tuple] | None) -> pa.RecordBatch:
            entries = None if run is None else [dict(zip(CAPTURE.names, c)) for c in sorted(run)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, number, data, entries), layout)], schema=layout)

        for rows, payloads in slices(batches, "payload"):
            columns = [rows.column(c).to_pylist() for c in ("number", "key", "url", "seconds", "original")]
            for number, key, url, time, original, payload in zip(*columns, payloads):
                member = packed(record(key, number, url, time, payload, original and (original["key"], original["number"], original["url"], original["seconds"])))
                captured.append((url_key(url), time, number, block, size, len(member)))
                held.append(member)
                size += len(member)
                if size >= SEGMENT:
                    yield row(block, b"".join(held), None)
                    block, size, held = block + 1, 0, []
                if len(captured) >= RUN:
                    yield row(runs, None, captured)
                    runs, captured = runs + 1, []
        if held:
            yield row(block, b"".join(held), None)
        if captured:
            yield row(runs, None, captured)

    joined = captures.select("number", "key", "url", "seconds", "payload").join(originals, "number", "left")
    joined.select("number", "key", "url", "seconds", "original", "payload").mapInArrow(run, ARCHIVE).write.parquet(path)
    dropped(captures)
    dropped(originals)


def history(spark: SparkSession, path: str) -> DataFrame:
    """place, url_key, seconds, number, part, block, offset, length: all captures; `place` counts them in global order from 0."""
    runs = spark.read.schema(ARCHIVE).parquet(path).filter("run is not null")
    rows = runs.select("part", F.col("block").alias("run_no"), F.posexplode("run").alias("at", "c")).select("part", "run_no", "at", "c.*")
    n = max(1, -(-runs.agg(F.coalesce(F.sum(F.size("run")), F.lit(0))).first()[0] // RANGE))
    dealt = rows.repartitionByRange(n, "url_key", "seconds", "number").sortWithinPartitions("part", "run_no", "at")
    names = ["url_key", "seconds", "number", "part", "block", "offset", "length"]
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("url_key", T.StringType()), T.StructField("seconds", T.LongType()),
                           T.StructField("number", T.LongType()), T.StructField("part", T.IntegerType()), *CAPTURE.fields[3:]])
    layout = to_arrow_schema(schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces: dict[tuple, list[tuple]] = {}  # of each run, the captures in this range, sorted as they were written
        for batch in batches:
            for run_no, *capture in zip(*(batch.column(c).to_pylist() for c in ("run_no", *names))):
                pieces.setdefault((capture[3], run_no), []).append(tuple(capture))
        number, out, done = TaskContext.get().partitionId(), [], 0
        for capture in LoserTree([iter(p) for p in pieces.values()]):
            out.append((number, done + len(out), *capture))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), layout)], schema=layout)
                out, done = [], done + len(out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), layout)], schema=layout)

    merged = stored(dealt.select("run_no", *names).mapInArrow(merge, schema), "warc-history")
    sums = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", sums.cast("long").alias("first"))  # a row per range
    return merged.join(F.broadcast(first), "range").select((F.col("first") + F.col("at")).alias("place"), *names)


RECORD = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType()),
])


def read_record(data: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for a revisit)."""
    fields, http, payload = parsed(data)
    kind, key = fields["WARC-Type"], key_of(fields["WARC-Record-ID"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    url = fields.get("WARC-Target-URI")
    if kind == "revisit":
        return key, url, int(http["Content-Length"]), digest, kind, key_of(fields["WARC-Refers-To"]), None
    if hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"]):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return key, url, len(payload), digest, kind, None, payload


def records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of the archives at `path`, with their places; with `payloads`, also the payloads of response records."""
    schema = RECORD if payloads else T.StructType(RECORD.fields[:-1])
    layout = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, data in zip(*(batch.column(c) for c in ("part", "block", "data"))):
                found = [(part.as_py(), block.as_py(), offset, *read_record(x)) for offset, _, x in members(data.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), layout)], schema=layout)

    return spark.read.schema(ARCHIVE).parquet(path).filter("data is not null").select("part", "block", "data").mapInArrow(run, schema)


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records with their place in the merged index, URL key and time."""
    places = history(spark, path).select("place", "url_key", "seconds", "part", "block", "offset")
    return places.join(records(spark, path, payloads), ["part", "block", "offset"]).drop("part", "block", "offset")


def export(spark: SparkSession, path: str, save: Callable[[str, bytes], None]) -> None:
    """Hand every segment to `save` inside the tasks, as a file name and the bytes of a `.warc.gz` file. A retried task saves the same."""
    segments = spark.read.schema(ARCHIVE).parquet(path).filter("data is not null").select("part", "block", "data")

    def each(rows: Iterator) -> None:
        for row in rows:
            save(f"part-{row.part:06d}-{row.block:06d}.warc.gz", bytes(row.data))

    segments.foreachPartition(each)


def new_path(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
