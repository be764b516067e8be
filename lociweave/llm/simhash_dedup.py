"""Near-duplicate documents by SimHash, with deletion-variant signatures.

Two fingerprints that differ in at most k bits, cut into k // 2 + 1 segments, have a segment in which they differ in at most one bit.
So every segment is indexed as it is and once per bit with that bit wiped out. Fingerprints that meet under a key are compared over
their whole length: under a wiped-out bit those that differ there, under an unchanged segment all of them, so that no pair is met
twice in one segment.

Only distinct fingerprints are indexed; equal ones are one node, however many documents share it. Keys with a single holder go away
after an aggregation. Keys with many holders are cut once more by the bits outside their segment, with the same variants, which
leaves at most 2 ** 18 holders for 64 bits and k = 3; such a group emits a spanning forest of its links, never all its pairs.

Defined results: null and empty texts have fingerprint zero, which links like any other; with fewer words than a shingle the whole
sequence is the shingle; repeated shingles count each time; repeated rows are documents of their own; a null key counts as no
candidate for the smallest key of its component; texts of any length count whole; an empty table gives an empty result. Other columns are
not read (`representatives` returns them as they are).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .tables import slices, stored, texts

BITS = 64
#: A key with up to this many holders is joined with itself; beyond it the key is cut further.
JOINED = 32
SEED = 42


def fingerprint(text: str, width: int = 3) -> int:
    """A bit is set where it is set in more than half of the XXH64 values of the text's word shingles."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and the six white-space characters of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    cuts = map(slice, starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, n)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (64 bits as a signed long)."""
    source = texts(docs, key, text)
    schema = T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in slices(batches):
            fps = np.fromiter((fingerprint(v, width) for v in values), np.uint64, len(values)).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), pa.array(fps)], names=["doc_id", "fp"])

    return source.mapInArrow(run, schema)


def _variants(value: Column, bits: int, at: Column) -> Column:
    """Key of variant `at` of a segment: variant w < bits has bit w wiped out, variant `bits` is the segment as it is."""
    wiped = F.when(at < bits, F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))).otherwise(F.lit(0).cast("long"))
    return value.bitwiseAND(F.bitwise_not(wiped))


def with_keys(rows: DataFrame, parts: int, bits: int, offset: Column, name: str = "key") -> DataFrame:
    """Each row once per segment and variant: `parts` segments of `bits` bits of fp, from bit `offset` on.

    Adds the key, `bit` (the position in fp that is wiped out, null for the unchanged segment).
    """
    at = F.explode(F.sequence(F.lit(0), F.lit(parts * (bits + 1) - 1)))
    rows = rows.withColumn("__at", at)
    part, variant = F.floor(F.col("__at") / (bits + 1)).cast("int"), F.col("__at") % (bits + 1)
    first = offset + part * bits
    segment = F.call_function("shiftrightunsigned", F.col("fp"), first.cast("int")).bitwiseAND(F.lit((1 << bits) - 1))
    tag = F.call_function("shiftleft", F.col("__at").cast("long"), F.lit(bits))
    return rows.select(
        *[c for c in rows.columns if c != "__at"],
        tag.bitwiseOR(_variants(segment, bits, variant)).alias(name),
        F.when(variant < bits, first + variant).cast("int").alias("bit"),
    )


def shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur at least twice, with `n`, how often. The count is combined before it is shuffled.

    Spark sizes rows after an explode as if each were still one, so it is told to shuffle both sides.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(counts.hint("merge"), keys)


def _joined(members: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Links among the few holders of each key. Files of sorted keys are many times smaller than their rows, so no side is broadcast."""
    bit = F.when(F.col("bit").isNull(), 0).otherwise(F.call_function("shiftrightunsigned", F.col("fp"), F.col("bit")).bitwiseAND(F.lit(1)))
    side = members.select(*keys, "bit", "fp", bit.alias("side"))
    left = side.filter("bit is null or side = 0").select(*keys, F.col("fp").alias("a"))
    right = side.filter("bit is null or side = 1").select(*keys, F.col("fp").alias("b"), F.col("bit").isNull().alias("whole"))
    return left.join(right.hint("merge"), keys).filter((~F.col("whole") | (F.col("a") < F.col("b"))) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= k)).select("a", "b")


def forest(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the links of a spanning forest over `values` (unsigned), which link at k or fewer differing bits."""
    left, sources, targets = values, [], []
    while left.size:
        frontier, left = left[:1], left[1:]
        while frontier.size and left.size:
            take = max(1, 2_000_000 // left.size)
            block, frontier = frontier[:take], frontier[take:]
            near = np.bitwise_count(block[:, None] ^ left[None, :]) <= k
            hit = near.any(axis=0)
            sources.append(block[near.argmax(axis=0)[hit]])
            targets.append(left[hit])
            frontier, left = np.concatenate([frontier, left[hit]]), left[~hit]
    empty = np.empty(0, values.dtype)
    return (np.concatenate(sources), np.concatenate(targets)) if sources else (empty, empty)


def near_links(distinct: DataFrame, k: int = 3, joined: int = JOINED) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect all those at k or fewer differing bits."""
    parts = k // 2 + 1
    if parts < 2 or BITS % parts:
        raise ValueError("k must give at least two segments of equal length")
    bits = BITS // parts
    members = stored(shared(with_keys(distinct.select("fp"), parts, bits, F.lit(0)), ["key"]), "simhash-members")
    few = _joined(members.filter(F.col("n") <= joined), ["key"], k)

    # Many holders: they agree in one segment up to a bit, so the next segment is cut in the same way.
    many = members.filter(F.col("n") > joined).select("key", "fp")
    segment = F.floor(F.call_function("shiftright", F.col("key"), F.lit(bits)) / (bits + 1))
    small = bits // parts
    cut = with_keys(many, parts, small, ((segment + 1) % parts * bits).cast("int"), "inner")
    inner = stored(shared(cut, ["key", "inner"]), "simhash-inner")
    few = few.unionByName(_joined(inner.filter(F.col("n") <= joined), ["key", "inner"], k))

    def span(group: pd.DataFrame) -> pd.DataFrame:
        a, b = forest(np.unique(group["fp"].to_numpy().view(np.uint64)), k)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    crowded = inner.filter(F.col("n") > joined).select("key", "inner", "fp").groupBy("key", "inner").applyInPandas(span, "a long, b long")
    return few.unionByName(crowded)


def near_duplicates(docs: DataFrame, k: int = 3, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id (the smallest key that can be reached over links, itself included), root (its smallest fingerprint)."""
    marks = stored(fingerprints(docs, width, key, text), "simhash-marks")
    nodes = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    linked = stored(components(near_links(nodes, k), "a", "b"), "simhash-roots")
    rooted = nodes.join(linked.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-named")
    return marks.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id", "root")


def representatives(docs: DataFrame, k: int = 3, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` per component, with all its columns: the smallest key, nulls last, then the smallest fingerprint."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    groups = near_duplicates(docs, k, width, key, text).groupBy("root").agg(F.min(order).alias("stays"))
    stays = stored(groups.select(F.col("stays.doc_id").alias("__doc_id"), F.col("stays.fp").alias("__stays")), "simhash-stays")
    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in slices(batches, text):
            fps = np.fromiter((fingerprint(v or "", width) for v in values), np.uint64, len(values)).view(np.int64)
            yield from rows.append_column("__fp", pa.array(fps)).combine_chunks().to_batches()

    marked = docs.mapInArrow(run, schema)
    kept = marked.join(stays, (marked["__fp"] == stays["__stays"]) & marked[key].eqNullSafe(stays["__doc_id"]), "left_semi")
    return kept.dropDuplicates([key, "__fp"]).drop("__fp")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
