"""Token counts by byte-pair merging with a heap and a linked list, without making ids.

Every symbol starts as one character; the adjacent pair whose concatenation has the lowest rank is merged until no pair is in the
vocabulary. The count is the number of initial symbols minus the merges. Characters outside the vocabulary fall back to one token
per UTF-8 byte, so they start as that many symbols and never merge.

A merge can only happen inside a piece of the vocabulary. Where no piece holds a certain pair of neighbouring characters, the text
may be cut between them; runs between a word and the next space mark are such places, which the vocabulary is asked for when it is
loaded. Equal runs are counted once per task and remembered in a bounded table.

Defined results: null and empty texts have 0 bytes and 0 tokens; every input row gives one row, an empty table none; long texts are counted whole;
other columns are not read, so their names do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import slices, texts, utf8_bytes

#: The character that stands for a space inside pieces.
SPACE = "▁"
#: Runs remembered per task before the table starts anew, and the longest run that is remembered.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 48
_SHIFT = 40
# Texts that tell whether a model normalises its input or joins spaces.
PROBES = ["", " ", "a", " a  b ", "\n", "x\n\n y", "ﬁ ① Ａ", "é é", "word's, 1234  end ", "<s> </s> <0x0A>", "日本 語", "😀​\t", SPACE + "a", "a b"]


def read_pieces(model: bytes) -> dict[str, int]:
    """Rank of every piece that merging may produce. The model is read once, on the driver."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = lib.get_piece_size()
    normal = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
    order = sorted(normal, key=lambda i: -lib.get_score(i))
    ranks = {lib.id_to_piece(i): rank for rank, i in enumerate(order)}
    counter = Counter(ranks)
    for probe in PROBES:
        if counter.count(probe) != len(lib.encode(probe)):
            raise ValueError(f"the model normalises or splits text in a way that merging alone does not give: {probe!r}")
    return ranks


class Counter(dict):
    """Token counts of runs, remembered; `count` adds them up over a text."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        inner = {x for p in ranks for x in zip(p, p[1:])}
        self.apart = not any(b == SPACE and a != SPACE for a, b in inner)
        # a newline that no piece holds beside another character is a run of its own
        lines = not any("\n" in x for x in inner)
        self.runs = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if lines else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        if any(len(p) > 1 and not all(c in ranks for c in p) for p in ranks):
            raise ValueError("a piece holds a character that is no piece")

    def __missing__(self, run: str) -> int:
        n = self.merged(run)
        if len(run) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[run] = n
        return n

    def merged(self, run: str) -> int:
        """Initial symbols minus merges of one run."""
        rank = self.ranks.get
        symbols: list[str | None] = list(run)
        n = len(symbols)
        count = n if all(map(self.ranks.__contains__, symbols)) else sum(1 if c in self.ranks else len(c.encode()) for c in symbols)
        heap = [(r << _SHIFT) | i for i, r in enumerate(map(rank, map("".join, zip(run, run[1:])))) if r is not None]
        if not heap:
            return count
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        mask = (1 << _SHIFT) - 1
        while heap:
            top = heappop(heap)
            i = top & mask
            left = symbols[i]
            j = after[i]
            if left is None or j >= n:
                continue
            joined = left + symbols[j]
            if rank(joined) != top >> _SHIFT:
                continue  # one of the two has been merged since
            count -= 1
            symbols[i], symbols[j] = joined, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(joined + symbols[k])
                if r is not None:
                    heappush(heap, (r << _SHIFT) | i)
            h = before[i]
            if h >= 0:
                r = rank(symbols[h] + joined)
                if r is not None:
                    heappush(heap, (r << _SHIFT) | h)
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if not self.apart:
            return self.merged(text)
        return sum(map(self.__getitem__, self.runs(text)))


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens). One map stage, no shuffle."""
    source = texts(docs, key, text).withColumn("n_bytes", utf8_bytes(F.col("text")))
    with open(model_path, "rb") as file:
        ranks = source.sparkSession.sparkContext.broadcast(read_pieces(file.read()))  # a fixed vocabulary file
    schema = T.StructType([source.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for rows, values in slices(batches):
            counts = pa.array([counter.count(v) for v in values], pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), rows.column("n_bytes").combine_chunks(), counts], names=schema.names)

    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
