"""Token ids in a binary file format: frequency-ranked, byte-aligned, control bytes apart from data bytes.

Format. A file set is a folder with two tables.

* `vocabulary`: `rank`, `id`, `n`. Ranks number the ids by falling frequency (equal frequencies: lower id first), so that frequent
  ids take one byte.
* `blocks`: one row per block of documents in ascending order. `part`, `block` order the blocks; `before` counts the ids of the part
  in front of the block; `keys` and `counts` (little-endian unsigned 32-bit) name the documents and their numbers of ids; `control`
  holds two bits per id, four ids to a byte, lowest bits first: the number of data bytes less one; `data` holds the bytes of the
  ranks, least significant first.

The tables are Parquet, so that Spark's commit protocol covers lost executors and retried tasks and any shared store will do; the
binary columns are the format. Decoding looks control bytes up in a table of byte masks.

Defined results: null and empty texts hold the end id alone; an empty table makes a file set without blocks; a null key sorts first; rows with equal keys are documents of their own,
in an order that depends on their ids only.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_root
from .hashing import equal_runs, spans, word_hashes
from .tables import dropped, per_worker, slices, stored, texts

#: Ids per block, about. A document is never cut, so one with more ids makes a larger block.
BLOCK_IDS = 1 << 18
#: Bytes of text whose words are worked out at a time.
PART = 1 << 22
#: Words that a worker remembers within a job (about 30 bytes each) before its table starts anew.
REMEMBERED = 2_000_000


class Words:
    """Ids of space-separated words, remembered by the worker for a job.

    Valid for vocabularies whose normaliser and pre-tokenizer treat words apart, which `checked` asks the library. The words of a text
    are found and hashed as arrays of bytes; only those whose hash is not known become strings and go to the library, many in one
    text, where the word-end mark tells their ids apart. Words with one hash are compared byte by byte; texts with different ones go to
    the library as they are.
    """

    MARK = "</w>"
    #: Punctuation that may follow a word without changing it; an apostrophe may start a suffix.
    AFTER = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'

    def __init__(self, vocabulary: str, known: tuple[bool, bool] | None = None):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(vocabulary)
        self.lib.no_padding()
        self.lib.no_truncation()
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for token, i in self.lib.get_vocab(with_added_tokens=True).items():
            self.ends[i] = token.endswith(self.MARK)
        self.forget()
        self.apart, self.folds = known or (self.checked(), self.folded())

    def checked(self) -> bool:
        """Whether words on both sides of a space or newline encode as they do alone, with each word of letters ending in a mark."""
        words = ["Abc", "don't", "'s", "ÉÀ", "e", "́x", "12", "a1,.", "ß", "<|endoftext|>", "日本", "…", "Σ", "ÉT!?.", "ab_", "Ab<|", "|>"]
        alone = [self.library(w).tolist() for w in words]
        pairs = all(
            self.library(a + gap + b).tolist() == x + y for a, x in zip(words, alone) for b, y in zip(words, alone) for gap in (" ", "\n", "  ")
        )
        return pairs and all(self.ends[x].sum() == 1 and self.ends[x[-1]] for w, x in zip(words, alone) if w.isalpha())

    def folded(self) -> bool:
        """Whether the library does not tell capital from small letters of Latin-1, alone and inside words."""
        capitals = [c for c in map(chr, range(256)) if c != c.lower()]
        return all(np.array_equal(self.library(w), self.library(w.lower())) for c in capitals for w in (c, f"{c}{c}", f"a{c}b", f"{c}ome", f"1{c}."))

    def library(self, text: str) -> np.ndarray:
        return np.asarray(self.lib.encode(text, add_special_tokens=False).ids, self.dtype)

    def forget(self) -> None:
        """Sorted hashes of the words known, and where their ids and their bytes are in the pools."""
        self.hashes = np.zeros(0, np.uint64)
        self.places, self.sizes, self.begins, self.lengths = (np.zeros(0, np.int64) for _ in range(4))
        self.pool, self.bytes = np.zeros(0, self.dtype), np.zeros(0, np.uint8)

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Letters with punctuation after them are two tokens of the splitting rule: both are encoded, and put together."""
        bases = [w if w.isalpha() else w.rstrip(self.AFTER) for w in words]
        letters = [b for b in dict.fromkeys(bases) if b.isalpha()]
        found: dict[str, bytes] = {}
        if letters:
            ids = np.asarray(self.lib.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, self.dtype)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            if len(cuts) == len(letters):
                data, cuts = ids.tobytes(), cuts.tolist()
                found = dict(zip(letters, map(data.__getitem__, map(slice, [0, *cuts], cuts))))
            else:  # a letter becomes a letter and a mark, which may join what follows
                apart = [(b, self.library(b)) for b in letters]
                found = {b: x.tobytes() for b, x in apart if self.ends[x].sum() == 1}
        out = []
        for w, b in zip(words, bases):
            start = found.get(b)
            if start is None:
                out.append(self.library(w).tobytes())
            elif len(b) == len(w):
                out.append(start)
            else:
                after = w[len(b) :]
                if after not in found:
                    found[after] = self.library(after).tobytes()
                out.append(start + found[after])
        return out

    def learn(self, data: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Add words, which no known hash stands for."""
        words = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        ids = self.ids_of([w.decode() for w in words])
        lengths = ends - starts
        begins = len(self.bytes) + np.cumsum(lengths) - lengths
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(words), np.uint8)])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        places = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), self.dtype)])
        order = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")
        known = (self.hashes, self.places, self.sizes, self.begins, self.lengths)
        self.hashes, self.places, self.sizes, self.begins, self.lengths = (
            np.concatenate(x)[order] for x in zip(known, (hashes, places, sizes, begins, lengths))
        )

    def prepared(self, text: str) -> str:
        """In lower case where every letter has one lower-case form that does not depend on its neighbours, and the marks of
        special tokens are lower-case already: that makes more words equal."""
        if not self.folds:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text if "<|" in text else text.lower()

    def group(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some prepared texts."""
        joined = b"\n".join(texts)
        data = np.frombuffer(joined, np.uint8)
        starts, ends = spans((data == 32) | (data == 10))
        once, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.hashes, once)
        new = np.ones(len(once), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != once[inside]
        if new.any():
            self.learn(joined, once[new], starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.hashes, once)
        lengths, place = ends - starts, at[which]
        if not np.array_equal(lengths, self.lengths[place]) or not equal_runs(data, starts, lengths, self.bytes, self.begins[place]):
            return [self.library(t.decode()).tobytes() for t in texts]  # different words with one hash
        sizes = self.sizes[at][which]
        total = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.places[at][which] - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)].tobytes()
        limits = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.append(0, total)[np.searchsorted(starts, limits)] * self.dtype.itemsize
        return [ids[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]

    def encode(self, values: list[str]) -> list[bytes]:
        if not self.apart:
            return [self.library(v).tobytes() for v in values]
        out, held, size = [b""] * len(values), [], 0
        pieces = [(i, piece) for i, v in enumerate(values) for piece in self.cut(self.prepared(v).encode())]
        for number, (i, piece) in enumerate(pieces):
            held.append((i, piece))
            size += len(piece)
            if size >= PART or number + 1 == len(pieces):
                for (k, _), ids in zip(held, self.group([p for _, p in held])):
                    out[k] += ids
                held, size = [], 0
        return out

    @staticmethod
    def cut(text: bytes) -> Iterator[bytes]:
        """Long texts in pieces, between words."""
        start = 0
        while len(text) - start > PART:
            ends = [x for x in (text.find(b" ", start + PART), text.find(b"\n", start + PART)) if x >= 0]
            if not ends:
                break
            yield text[start : min(ends)]
            start = min(ends) + 1
        yield text[start:]


def encode(docs: DataFrame, vocabulary_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """doc_id, ids (little-endian, of the returned number of bytes each), with the end id after each document."""
    source = texts(docs, key, text)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = source.sparkSession.sparkContext.broadcast(file.read())  # a fixed vocabulary file
    schema = T.StructType([source.schema["doc_id"], T.StructField("ids", T.BinaryType())])
    here, job = Words(vocabulary.value), uuid.uuid4().hex
    width, known = here.dtype.itemsize, (here.apart, here.folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker("words", job, lambda: Words(vocabulary.value, known))
        end = words.dtype.type(end_id).tobytes()
        for rows, values in slices(batches):
            out = [x + end for x in words.encode(values)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), pa.array(out, pa.binary())], names=schema.names)

    return source.mapInArrow(run, schema), width


def frequencies(encoded: DataFrame, width: int) -> DataFrame:
    """id, n. Each task sends at most one row per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 8 * width if width < 3 else 0, np.int64)
        for batch in batches:
            column = batch.column("ids")
            if len(column):
                ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
                found = np.bincount(np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(f"<u{width}"), minlength=len(total))
                found[: len(total)] += total
                total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(total[ids])], names=["id", "n"])

    return encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of `ranks` (unsigned 32-bit)."""
    lengths = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[: len(ranks)] = lengths
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    wide = 2 if not len(ranks) or lengths.max() < 2 else 4
    data = ranks.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide)
    return control.tobytes(), data[np.arange(wide, dtype=np.uint8) <= lengths[:, None]].tobytes()


def masks(wide: int) -> np.ndarray:
    """For every control byte, which bytes of four numbers of `wide` bytes are stored."""
    lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
    return (np.arange(wide)[None, None, :] <= lengths[:, :, None]).reshape(256, 4 * wide)


#: Control bytes whose four numbers have at most two bytes each.
NARROW = np.array([all(b >> s & 3 < 2 for s in (0, 2, 4, 6)) for b in range(256)])


def unpack(control: bytes, data: bytes, n: int, tables: dict[int, np.ndarray]) -> np.ndarray:
    """The `n` ranks again. The last control byte may stand for fewer than four; its spare numbers are no data."""
    marks = np.frombuffer(control, np.uint8)
    wide = 2 if NARROW[marks].all() else 4
    present = tables[wide][marks].reshape(-1, wide)
    present[n:] = False
    out = np.zeros(present.shape, np.uint8)
    out[present] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view(f"<u{wide}")[:n]


def write(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write the file set to `path`, documents in ascending order of their keys."""
    spark = docs.sparkSession
    encoded, width = encode(docs, vocabulary_path, end_id, key, text)
    encoded = stored(encoded, "token-ids")
    order = frequencies(encoded, width).orderBy(F.desc("n"), "id").collect()  # as many rows as the vocabulary has ids, at most
    names = [r["id"] for r in order]
    spark.createDataFrame([(i, r["id"], r["n"]) for i, r in enumerate(order)], "rank long, id long, n long").coalesce(1).write.parquet(f"{path}/vocabulary")
    rank_of = np.zeros(max(names, default=0) + 1, np.uint32)
    rank_of[names] = np.arange(len(names), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)
    kind = encoded.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("keys", T.ArrayType(kind)), T.StructField("counts", T.BinaryType()), T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, block, before, held, keys, ids = TaskContext.get().partitionId(), 0, 0, 0, [], []
        layout = to_arrow_schema(schema)

        def row() -> pa.RecordBatch:
            control, data = pack(ranks.value[np.concatenate(ids)])
            counts = np.array([len(x) for x in ids], "<u4").tobytes()
            values = [part, block, before, held, keys, counts, control, data]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, layout)], schema=layout)

        for rows, values in slices(batches, "ids"):
            for k, v in zip(rows.column("doc_id").to_pylist(), values):
                x = np.frombuffer(v, f"<u{width}")
                keys.append(k)
                ids.append(x)
                held += len(x)
                if held >= BLOCK_IDS:
                    yield row()
                    block, before, held, keys, ids = block + 1, before + held, 0, [], []
        if keys:
            yield row()

    # Equal keys are told apart by their ids, and the range may be cut inside them.
    ordered = encoded.withColumn("tie", F.xxhash64("ids"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    ordered.mapInArrow(run, schema).write.parquet(f"{path}/blocks")
    dropped(encoded)


def read(spark: SparkSession, path: str) -> DataFrame:
    """part, before, key, at (ids of the block before it), ids (little-endian unsigned 32-bit), n_tokens: the documents of a file set."""
    blocks = spark.read.parquet(f"{path}/blocks")
    rows = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").select("id").collect()  # the vocabulary
    names = spark.sparkContext.broadcast(np.array([r[0] for r in rows], "<u4"))
    kind = blocks.schema["keys"].dataType.elementType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("doc_id", kind),
        T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("ids_crc32", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {wide: masks(wide) for wide in (2, 4)}
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i]  # noqa: B023, E731
                ids = names.value[unpack(get("control").as_py(), get("data").as_py(), get("n_ids").as_py(), tables)]
                counts = np.frombuffer(get("counts").as_py(), "<u4").astype(np.int64)
                ends = np.cumsum(counts)
                found = [ids[e - c : e].tobytes() for c, e in zip(counts.tolist(), ends.tolist())]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([get("part").as_py()] * n, pa.int32()), pa.array([get("before").as_py()] * n, pa.int64()), get("keys").values,
                        pa.array(ends - counts), pa.array(counts), pa.array(found, pa.binary()), pa.array([zlib.crc32(x) for x in found], pa.int64()),
                    ],
                    names=schema.names,
                )

    return blocks.select("part", "before", "n_ids", "keys", "counts", "control", "data").mapInArrow(run, schema)


def with_starts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids, ids_crc32. Sums are carried over by one row per part."""
    from pyspark.sql import Window

    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("total"))
    sums = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = parts.select("part", sums.cast("long").alias("first"))
    docs = read(spark, path).join(F.broadcast(first), "part")  # one row per partition of the writing job
    return docs.select("doc_id", (F.col("first") + F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids", "ids_crc32")


def new_path(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/token-file-{uuid.uuid4().hex}"
