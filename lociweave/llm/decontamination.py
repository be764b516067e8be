"""Benchmark decontamination: find short test items inside long documents.

Words are runs of letters and digits of the lower-cased text; a shingle is five of them (the whole sequence where there are fewer).
A document holds an item if it has at least `threshold` of the item's distinct shingles.

Search. Items are partitioned by size, in powers of two of their number of shingles. The MinHash sketch of an item with n shingles is
its s = n - ceil(threshold * n) + 1 smallest shingle hashes: a document that holds the item lacks at most s - 1 shingles, so it shares
one of any s. A partition's bound is the largest hash in its sketches, and the sketch of a document for that partition is all its
hashes up to the bound. Looking these up in the partition's table gives the candidates, and no item is missed whatever the length of the
document. (Banded signatures of fixed length cannot do that: an item of 30 shingles in a document of 5,000 has a Jaccard
similarity of 0.006.) Each candidate is verified by counting the item's shingles in the document, as words, not as hashes.

The documents are never shuffled. The items travel to the tasks in blocks of bounded size, one pass over the documents per block, so
a growing benchmark costs passes, not memory.

Defined results: items or documents without words match nothing; repeated item rows with the same id and text count once; repeated
document rows are reported each; null keys are kept; texts of any length are searched whole; an empty table of either kind matches
nothing; other columns are not read (`clean` returns them as they are). The index of all items is on the driver, block by block, and every
block is a pass over the documents.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .tables import slices, texts

WIDTH, THRESHOLD = 5, 0.8
#: Bytes of item text that travel to the tasks at a time.
BLOCK_BYTES = 8 << 20
#: Word hashes remembered per task before the table starts anew.
REMEMBERED = 1_000_000

WORDS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def shingles_of(words: list[str], width: int) -> list[str]:
    return [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


class Hashes(dict):
    """Hashes of words, remembered; `shingles` combines those of neighbouring words."""

    def __init__(self, width: int):
        self.width = width
        self.factors = [pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(width)]

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def shingles(self, words: list[str]) -> np.ndarray:
        values = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        out = np.zeros(n, np.uint64)
        for j in range(width):
            out += values[j : j + n] * np.uint64(self.factors[j])
        out ^= out >> np.uint64(32)  # the low bits of a product depend on few bits; the bound compares high ones
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out


def partition(sketches: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of items of about one size: the hashes of their sketches, sorted, and the item each belongs to. The last one is the bound."""
    hashes = np.concatenate([s for _, s in sketches])
    items = np.repeat(np.array([i for i, _ in sketches]), [len(s) for _, s in sketches])
    order = np.argsort(hashes, kind="stable")
    return hashes[order], items[order]


def candidates(sketch: np.ndarray, hashes: np.ndarray, items: np.ndarray) -> set[int]:
    """Items of a partition that share a sketch entry with the document whose hashes are `sketch`."""
    low = sketch[sketch <= hashes[-1]]
    first = np.searchsorted(hashes, low, "left")
    out: set[int] = set()
    for i in np.flatnonzero(hashes[first] == low).tolist():
        out.update(items[first[i] : np.searchsorted(hashes, low[i], "right")].tolist())
    return out


def index_of(items: list[tuple[object, str]], width: int, threshold: float) -> tuple[list[tuple], list[tuple]]:
    """Partitions by size, and per item: id, distinct shingles, how many of them a document must have."""
    hashes, held, by_size = Hashes(width), [], defaultdict(list)
    for key, text in items:
        shingles = sorted(set(shingles_of(words_of(text), width)))
        if shingles:
            need = math.ceil(round(threshold * len(shingles), 9))
            values = np.unique(np.concatenate([hashes.shingles(s.split(" ")) for s in shingles]))
            by_size[len(shingles).bit_length()].append((len(held), values[: len(shingles) - need + 1]))
            held.append((key, shingles, need))
    return [partition(x) for _, x in sorted(by_size.items())], held


def contained(text: str, hashes: Hashes, parts: list[tuple], held: list[tuple]) -> list[tuple[object, int, int]]:
    """Item id, number of its shingles, number of those in `text`, for each item that `text` holds."""
    words = words_of(text)
    if not words:
        return []
    sketch = hashes.shingles(words)
    found = sorted(set().union(*(candidates(sketch, *p) for p in parts)))
    if not found:
        return []
    whole = f" {' '.join(words)} "
    few = len(words) < hashes.width
    out = []
    for i in found:
        key, shingles, need = held[i]
        n = sum(s == whole.strip() for s in shingles) if few else sum(f" {s} " in whole for s in shingles if s.count(" ") == hashes.width - 1)
        if n >= need:
            out.append((key, len(shingles), n))
    return out


def blocks_of(items: DataFrame, item_key: str, item_text: str, width: int, threshold: float, block_bytes: int) -> list[Broadcast]:
    """The index of every block of items; a block holds about `block_bytes` of text."""
    wanted = items.select(items[item_key].alias("item_id"), items[item_text].cast("string").alias("text")).filter("text is not null").distinct()
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    mine = [wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]
    return [wanted.sparkSession.sparkContext.broadcast(index_of([tuple(r) for r in m.collect()], width, threshold)) for m in mine]


def matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    width: int = WIDTH, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment: every document with every item it holds."""
    source = texts(docs, key, text)
    item_type = items.schema[item_key].dataType
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("item_id", item_type), T.StructField("n_shingles", T.LongType()), T.StructField("n_shared", T.LongType()),
    ])
    layout = to_arrow_type(item_type)

    def search(index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = Hashes(width)
            for rows, values in slices(batches):
                found = [(i, *m) for i, v in enumerate(values) for m in contained(v, hashes, *index.value)]
                at, ids, sizes, hits = zip(*found) if found else ((), (), (), ())
                keys = rows.column("doc_id").combine_chunks().take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids, layout), pa.array(sizes, pa.int64()), pa.array(hits, pa.int64())], names=schema.names)

        return source.mapInArrow(run, schema)

    out = reduce(DataFrame.unionAll, map(search, blocks_of(items, item_key, item_text, width, threshold, block_bytes)))
    return out.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    width: int = WIDTH, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no item. A map stage per block of items, no shuffle."""

    def kept(rows: DataFrame, index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = Hashes(width)
            for part, values in slices(batches, text):
                yield from part.filter(pa.array([not contained(v or "", hashes, *index.value) for v in values], pa.bool_())).to_batches()

        return rows.mapInArrow(run, rows.schema)

    return reduce(kept, blocks_of(items, item_key, item_text, width, threshold, block_bytes), docs)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
       FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id)
SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_shared, count(*) / any_value(n) AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n)
"""
