"""Byte-level BPE encoding and decoding with a local rank file.

The library splits a text by the vocabulary's pattern and merges the bytes of every match. Long texts are cut first, at places
where the pattern always starts a new match, so that no single call of the library sees an unbounded text.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows get one result each; a null key is kept;
an empty table gives an empty result; other input columns are not read, so their names do no harm. Ids are stored as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tables import slices, texts

#: Texts above this many characters are cut; a cut is made at the first safe place after it.
CUT_CHARS = 1 << 16

# A space or newline after a character that is no white space, and a change between ASCII letters and digits:
# no match of the pattern contains both sides, and its look-ahead only inspects white space.
SAFE = r"(?<=\S)(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pieces(text: str, safe: regex.Pattern, size: int = CUT_CHARS) -> Iterator[str]:
    """`text` in pieces that encode on their own to the same ids as inside the whole."""
    start = 0
    while len(text) - start > size:
        cut = safe.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Codec:
    """One library encoder per task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.encoder = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.safe = regex.compile(SAFE)

    def encode(self, text: str, size: int = CUT_CHARS) -> np.ndarray:
        if len(text) <= size:
            return np.asarray(self.encoder.encode_ordinary(text), dtype="<u4")
        return np.concatenate([np.asarray(self.encoder.encode_ordinary(p), dtype="<u4") for p in pieces(text, self.safe, size)])

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoder.decode_bytes(ids.tolist())


ENCODED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids; with `decoded`, also the bytes that the ids decode to. One map stage, no shuffle."""
    source = texts(docs, key, text)
    ranks = source.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # a fixed vocabulary file
    fields = [source.schema["doc_id"], *ENCODED.fields] + [T.StructField("decoded", T.BinaryType())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, pattern)
        for rows, values in slices(batches):
            found = [codec.encode(v) for v in values]
            columns = [rows.column("doc_id").combine_chunks(), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())]
            if decoded:
                columns.append(pa.array([codec.decode(x) for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the raw bytes of its ids. Bytes, because ids of a damaged or cut text need not be valid UTF-8."""
    source = encoded.select(encoded[key].alias("doc_id"), encoded[ids].alias("ids"))
    ranks = source.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, pattern)
        for rows, values in slices(batches, "ids"):
            out = [codec.decode(np.frombuffer(v or b"", dtype="<u4")) for v in values]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("decoded", T.BinaryType())]))
