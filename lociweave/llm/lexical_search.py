"""Ranked lexical search by inner products of impact vectors, with buckets of vectors of about one length.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lower-cased. A document is a vector
with an impact per term, an item one with a weight per term, and a score is their inner product. The square root of a weight goes to
either side, so that both lengths count. Only terms of items matter for any product, so documents are cut down to them.

Search. The vectors are written in falling order of their lengths; neighbours in that order are a bucket.

* A bucket whose longest vector times the item's length stays below the item's threshold holds no hit (Cauchy-Schwarz). Where that is so
  for all items, the scan skips the rows by the lengths in the file footers.
* Inside a bucket the item's heaviest coordinates are multiplied out, and the product of what is left of both lengths bounds the rest.
* Survivors are scored in whole numbers, and the best `top` of a task are kept.

A threshold is a score that `top` documents are known to reach: first those of the longest vectors (a share of about 1 / `HEAD`, searched in
a first pass), then the best seen in the task. Only what lies strictly below it goes, so ties are whole.

Documents are read once per block of items; a block holds a bounded amount of item text, so more items cost passes, not memory. Counts
that weights depend on cover all documents.

Defined results: documents without terms are found by no item and count in no statistic; items without terms have no rows; equal item rows
(id and text) are one item; repeated document rows are documents of their own; null keys (which are integers) rank behind all others of
their score; scores of zero are no hits; empty tables give no rows; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import dropped, slices, stored, texts

TOP = 50
#: Bytes of item text that are searched for at a time.
BLOCK_BYTES = 2 << 20
#: Rows per bucket, and the share of the longest vectors that set the first thresholds.
BUCKET, HEAD = 4096, 64
#: A sum of products in floating point may be off by less than this share.
SLACK = 1e-9

#: Lower-case letters for A-Z, spaces for all other bytes below 128 that are no letters or digits.
TABLE = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split(b" ") if text else []


def counts_of(text: str) -> Counter:
    counts = Counter(terms_of(text))
    counts.pop(b"", None)
    return counts


class Items:
    """Items of a block: their terms, numbered, and after `weigh` their vectors."""

    def __init__(self, rows: list[tuple[object, str]]):
        found = [(key, counts_of(text)) for key, text in rows]
        self.keys = [key for key, terms in found if terms]
        self.numbers = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in found))))}
        self.terms = [np.array(sorted(self.numbers[t] for t in terms), np.int64) for _, terms in found if terms]

    def weigh(self, n_docs: int, holders: np.ndarray) -> None:
        """Weights of all terms; per item its length, its heaviest terms that make up half of its squared length, and what is left."""
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in holders.tolist()], np.int64)
        self.lengths, self.focus, self.rest = np.zeros(len(self.keys)), [], np.zeros(len(self.keys))
        for i, terms in enumerate(self.terms):
            heavy = terms[np.argsort(-self.weights[terms], kind="stable")]
            sums = np.cumsum(self.weights[heavy])
            taken = int(np.searchsorted(sums, sums[-1] / 2)) + 1
            self.focus.append(heavy[:taken])
            self.lengths[i] = math.sqrt(sums[-1])
            self.rest[i] = math.sqrt(sums[-1] - sums[min(taken, len(sums)) - 1])


class Best:
    """The best documents seen for one item: score descending, then key ascending with nulls last."""

    def __init__(self, least: int, top: int):
        self.least, self.top = least, top
        self.scores, self.none, self.keys = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, none: np.ndarray, keys: np.ndarray) -> None:
        take = scores >= self.least
        if take.any():
            self.scores, self.none, self.keys = (
                np.concatenate(x) for x in ((self.scores, scores[take]), (self.none, none[take]), (self.keys, keys[take]))
            )
            order = np.lexsort((self.keys, self.none, -self.scores))[: self.top]
            self.scores, self.none, self.keys = self.scores[order], self.none[order], self.keys[order]
            if len(order) == self.top:
                self.least = max(self.least, int(self.scores[-1]))


class Bucket:
    """Vectors of about one length: entries by document, and the same entries by term."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray):
        self.lengths, self.sizes, self.terms, self.impacts = lengths, sizes, terms, impacts
        self.ends = np.cumsum(sizes)
        self.squares = lengths * lengths
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.by_term, self.holders = terms[order], doc[order]
        self.parts = np.sqrt(weights[self.by_term].astype(float)) * impacts[order]

    def near(self, focus: np.ndarray, roots: np.ndarray, rest: float, least: float) -> np.ndarray:
        """Documents whose product over the focus, with the lengths of the rest multiplied, reaches `least`."""
        first, last = np.searchsorted(self.by_term, focus), np.searchsorted(self.by_term, focus, "right")
        product, square = np.zeros(len(self.lengths)), np.zeros(len(self.lengths))
        for a, b, root in zip(first.tolist(), last.tolist(), roots.tolist()):
            held = self.parts[a:b]
            product[self.holders[a:b]] += root * held
            square[self.holders[a:b]] += held * held
        bound = product + rest * np.sqrt(np.maximum(self.squares - square, 0) + SLACK * self.squares)
        return np.flatnonzero(bound * (1 + SLACK) >= least)

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; `weights` has a weight for every term, 0 outside the item."""
        sizes = self.sizes[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[docs] - ends, sizes)
        sums = np.append(0, np.cumsum(weights[self.terms[at]] * self.impacts[at]))
        return sums[ends] - sums[ends - sizes]


def search(bucket: Bucket, none: np.ndarray, keys: np.ndarray, items: Items, best: list[Best]) -> None:
    """Add the hits of one bucket to the best of each item."""
    longest = float(bucket.lengths.max(initial=0))
    reach = items.lengths * longest * (1 + SLACK)
    weights = np.zeros(len(items.weights), np.int64)
    for i in np.flatnonzero(reach >= np.array([b.least for b in best])).tolist():
        terms, focus = items.terms[i], items.focus[i]
        docs = bucket.near(focus, np.sqrt(items.weights[focus].astype(float)), items.rest[i], best[i].least)
        if len(docs):
            weights[terms] = items.weights[terms]
            best[i].add(bucket.scores(docs, weights), none[docs], keys[docs])
            weights[terms] = 0


VECTORS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def vectors(source: DataFrame, items: Items) -> DataFrame:
    """doc_id, n, terms, counts: all documents with a term; item terms they hold, as numbers, and how often."""
    known = source.sparkSession.sparkContext.broadcast(items.numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for rows, values in slices(batches):
            keep, sizes, terms, counts = [], [], [], []
            for i, value in enumerate(values):
                found = counts_of(value)
                if found:
                    held = sorted((numbers[t], found[t]) for t in found.keys() & numbers.keys())
                    keep.append(i)
                    sizes.append(found.total())
                    terms.append(np.array([t for t, _ in held], "<u4").tobytes())
                    counts.append(np.array([c for _, c in held], "<u4").tobytes())
            keys = rows.column("doc_id").combine_chunks().take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=VECTORS.names)

    return source.mapInArrow(run, VECTORS)


def holders(found: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the block. A task sends a row per term at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for value in batch.column("terms"):
                total[np.frombuffer(value.as_buffer(), "<u4")] += 1
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(total[terms])], names=["term", "n"])

    out = np.zeros(n_terms, np.int64)
    for term, n in found.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


INDEX = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("length", T.DoubleType()), T.StructField("terms", T.BinaryType()), T.StructField("impacts", T.BinaryType())])


def indexed(found: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Impact vectors in falling order of their lengths; vectors without weight, which no item can reach, are left out."""
    known = found.sparkSession.sparkContext.broadcast(weights.astype(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lengths, impacts = [], [], []
            for i, (n, terms, counts) in enumerate(zip(batch.column("n").to_pylist(), batch.column("terms"), batch.column("counts"))):
                tf = np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * n * n_docs // n_terms))
                square = float((known.value[np.frombuffer(terms.as_buffer(), "<u4")] * impact * impact).sum())
                if square > 0:
                    keep.append(i)
                    lengths.append(math.sqrt(square))
                    impacts.append(impact.astype("<u4").tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), pa.array(lengths, pa.float64()), batch.column("terms").take(at), pa.array(impacts, pa.binary())], names=INDEX.names
            )

    ordered = found.mapInArrow(run, INDEX).repartitionByRange(F.desc("length"), "doc_id").sortWithinPartitions(F.desc("length"), "doc_id")
    return stored(ordered, "lexical-index")


HITS = "item int, score long, doc_id long"


def hits(index: DataFrame, items: Items, least: list[int], top: int) -> DataFrame:
    """item, score, doc_id: of every task the best documents that reach the thresholds."""
    known = index.sparkSession.sparkContext.broadcast((items, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = known.value
        best = [Best(x, top) for x in least]
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                terms = [np.frombuffer(x.as_buffer(), "<u4") for x in part.column("terms")]
                impacts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in part.column("impacts")]).astype(np.int64)
                keys = part.column("doc_id")
                bucket = Bucket(part.column("length").to_numpy(), np.array(list(map(len, terms))), np.concatenate(terms).astype(np.int64), impacts, items.weights)
                search(bucket, keys.is_null().to_numpy(zero_copy_only=False), keys.fill_null(0).to_numpy(), items, best)
        item = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        if len(item):
            scores, none, keys = (np.concatenate(x) for x in zip(*((b.scores, b.none, b.keys) for b in best)))
            yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(scores), pa.array(keys, mask=none)], names=["item", "score", "doc_id"])

    return index.mapInArrow(run, HITS)


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def searched(source: DataFrame, items: Items, top: int) -> DataFrame:
    """item, score, doc_id, rank for the items of one block."""
    found = stored(vectors(source, items), "lexical-vectors")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    items.weigh(n_docs, holders(found, len(items.numbers)))
    index = indexed(found, items.weights, n_docs, max(1, n_terms))
    dropped(found)
    cut = index.agg(F.percentile_approx("length", F.lit(1 - 1 / HEAD), F.lit(1000))).first()[0] or 0.0
    least = [1] * len(items.keys)
    first = stored(ranked(hits(index.filter(F.col("length") >= cut), items, least, top), top), "lexical-head")
    for item, score in first.filter(F.col("rank") == top).select("item", "score").collect():  # a row per item of the block
        least[item] = score
    reach = min((t / n for t, n in zip(least, items.lengths.tolist()) if n), default=0.0) * (1 - SLACK)
    rest = index.filter((F.col("length") < cut) & (F.col("length") >= reach))
    return ranked(first.select("item", "score", "doc_id").unionByName(hits(rest, items, least, top)), top)


def blocks_of(wanted: DataFrame, block_bytes: int) -> list[DataFrame]:
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    return [wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def top_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the `top` documents with the highest scores above 0."""
    spark = docs.sparkSession
    source = texts(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    kind = items.schema[item_key].dataType
    wanted = items.select(items[item_key].alias("item_id"), items[item_text].cast("string").alias("text")).filter("text is not null").distinct()
    out = []
    for block in blocks_of(wanted, block_bytes):
        held = Items([tuple(r) for r in block.collect()])
        names = spark.createDataFrame(list(enumerate(held.keys)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)]))
        out.append(searched(source, held, top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # as many rows as the block has items
    return reduce(DataFrame.unionAll, out)


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
q AS (SELECT item_id, row_number() OVER () AS i, list_distinct(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
      FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
qt AS (SELECT item_id, i, unnest(w) AS t FROM q),
tf AS (SELECT r, doc_id, any_value(n) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d)
       WHERE t IN (SELECT t FROM qt) GROUP BY r, doc_id, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t),
sc AS (SELECT item_id, i, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * docs) // terms))))) AS BIGINT) AS score
       FROM qt JOIN tf USING (t) JOIN w USING (t), s GROUP BY item_id, i, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0) WHERE rank <= 50
"""
