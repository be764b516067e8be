"""Alignment of two tokenizers over the same texts, with corpus-wide counts of the id pairs that overlap.

A is byte-level BPE (a `tokenizers` file) over a space and the text, B is sentencepiece over the text, which adds that space itself. Every
text is encoded whole by both. Bytes of tokens give the places where they end, and a text takes part only if the bytes of either side
are those of the space and the text.

Windows. A place where tokens of both sides end, and where the next token of either side starts with a space, is an anchor. Anchors cut
both lists of ids into windows; no token crosses one, so neither groups nor links do. The same windows come up again and again:
their alignment is worked out once and remembered under the ids of both sides, in a table of the worker that starts anew when it is full. The
new windows of some documents are aligned together.

Counts. A document keeps its distinct id pairs with their numbers, eight bytes a pair. Their sums over all documents are one
aggregation; the pairs with their sums travel to the tasks in blocks of bounded size, one pass over the documents' pairs per block.

Defined results: null and empty texts, and texts whose bytes differ from those of the tokens of either side, have zeros and '' for their groups;
repeated rows are documents of their own, also in the counts; null keys are kept; an empty table has no rows; texts of any length are
aligned whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import Codec
from .hashing import equal_runs
from .tables import per_worker, slices, stored, texts
from .token_counts import PROBES, SPACE

#: Token ids remembered as windows by a task, id pairs summed up by a task, and pairs that travel to the tasks at a time.
REMEMBERED, HELD, BLOCK = 4_000_000, 4_000_000, 2_000_000
#: Characters of the documents whose new windows are aligned together.
TOGETHER = 1 << 18


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: visible Latin-1 characters for themselves, then letters from 256 on."""
    visible = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Side A. The file's vocabulary is merged by ranks, once probes agree with the file's own library; else that library encodes."""

    def __init__(self, file: str, pattern: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(file)
        self.lib.no_padding()
        self.lib.no_truncation()
        self.lib.encode_special_tokens = True  # their strings in a text are ordinary text
        letters, added = byte_letters(), {t["content"] for t in json.loads(file)["added_tokens"]}
        vocabulary = self.lib.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in added else bytes(map(letters.__getitem__, token))
        self.codec = Codec({self.bytes[i]: i for t, i in vocabulary.items() if t not in added}, pattern)
        self.ranked = all(self.codec.encode(" " + p).tolist() == self.library(" " + p) for p in [*PROBES, "x".join(PROBES), *added])

    def library(self, text: str) -> list[int]:
        return self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, text: str) -> list[int]:
        return self.codec.encode(" " + text).tolist() if self.ranked else self.library(" " + text)


class Pieces:
    """Side B."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = []
        for i in range(self.lib.get_piece_size()):
            piece = self.lib.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.lib.is_byte(i) else piece.replace(SPACE, " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.lib.encode(text, num_threads=1)


class Side:
    """Bytes of the tokens of one tokenizer, and their ids as text with a mark after them."""

    def __init__(self, tokens: list[bytes], last: str):
        self.sizes = np.array(list(map(len, tokens)))
        self.begins, self.pool = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])
        # the id before another one of its group, and then the last id of a group
        self.shown = np.array([f"{i}{mark}".encode() for mark in (",", last) for i in range(len(tokens))], object)
        self.widths = np.array(list(map(len, self.shown)))

    def give(self, ids: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> bool:
        """Whether the tokens, which end at `ends`, are the bytes of `whole`."""
        sizes = self.sizes[ids]
        return len(ids) > 0 and ends[-1] == len(whole) and equal_runs(whole, ends - sizes, sizes, self.pool, self.begins[ids])


class Windows(dict):
    """Number of each window that has been met, by the ids of both sides (A's, then B's counted on from A's size, four bytes each); the
    alignments are in lists."""

    def __init__(self, a_tokens: list[bytes], b_tokens: list[bytes]):
        self.a, self.b, self.n_a, self.n_b = Side(a_tokens, "|"), Side(b_tokens, ";"), len(a_tokens), len(b_tokens)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.held = 0
        self.n_groups: list[int] = []
        self.shown: list[bytes] = []  # groups as text
        self.pairs: list[bytes] = []  # codes of the links

    def windows(self, text: str, a: list[int], b: list[int]) -> list[bytes] | None:
        """The windows of a text; None if the tokens do not give the text."""
        whole = np.frombuffer(b" " + text.encode(), np.uint8)
        a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a.sizes[a_ids]), np.cumsum(self.b.sizes[b_ids])
        if not self.a.give(a_ids, a_ends, whole) or not self.b.give(b_ids, b_ends, whole):
            return None
        at = np.searchsorted(b_ends, a_ends)
        after_a = np.flatnonzero(b_ends[at] == a_ends) + 1  # first tokens after the shared ends
        after_b = at[after_a - 1] + 1
        # an anchor: both next tokens start with a space; the last shared end is that of the text
        spaced = self.a.spaced[a_ids[after_a[:-1]]] & self.b.spaced[b_ids[after_b[:-1]]]
        spaced = np.append(spaced, True)
        cuts_a, cuts_b = after_a[spaced], after_b[spaced]
        sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        ids = np.empty(len(a) + len(b), "<u4")
        ids[np.arange(len(a)) + np.repeat(cuts_b - sizes_b, sizes_a)] = a_ids
        ids[np.arange(len(b)) + np.repeat(cuts_a, sizes_b)] = b_ids + self.n_a
        ends = (4 * (cuts_a + cuts_b)).tolist()
        return list(map(ids.tobytes().__getitem__, map(slice, [0, *ends], ends)))

    def learn(self, keys: list[bytes]) -> None:
        """Align new windows, all at once: one after another they are a text, which shared ends cut."""
        ids = np.frombuffer(b"".join(keys), "<u4").astype(np.int64)
        of_a = ids < self.n_a
        a, b = ids[of_a], ids[~of_a] - self.n_a
        sizes = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)) // 4)
        last_a = np.cumsum(of_a)[sizes - 1]  # tokens of A up to the end of each window
        a_ends, b_ends = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        ends = np.union1d(a_ends, b_ends)  # a pair of tokens overlaps up to one of these, and every one of them ends such a pair
        at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        codes = (a[at_a] * self.n_b + b[at_b]).astype("<u8").tobytes()
        both = (a_ends[at_a] == ends) & (b_ends[at_b] == ends)
        shared = ends[both]
        # the text of the groups: A's tokens of a group, then B's
        group_a, group_b = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        shown_a, shown_b = a + self.n_a * (shared[group_a] == a_ends), b + self.n_b * (shared[group_b] == b_ends)
        after = np.append(0, np.searchsorted(b_ends, shared, "right"))[group_a]
        before = np.searchsorted(a_ends, shared, "right")[group_b]
        text, widths = np.empty(len(ids), object), np.empty(len(ids), np.int64)
        for at, side, tokens in ((np.arange(len(a)) + after, self.a, shown_a), (np.arange(len(b)) + before, self.b, shown_b)):
            text[at], widths[at] = side.shown[tokens], side.widths[tokens]
        joined, cuts = b"".join(text.tolist()), np.cumsum(widths)[sizes - 1].tolist()
        stops = np.searchsorted(ends, a_ends[last_a - 1]) + 1  # links up to the end of each window
        self.n_groups += np.diff(np.append(0, np.cumsum(both))[stops], prepend=0).tolist()
        self.shown += [joined[x : y - 1] for x, y in zip([0, *cuts], cuts)]
        stops = (8 * stops).tolist()
        self.pairs += [codes[x:y] for x, y in zip([0, *stops], stops)]
        self.update(zip(keys, range(len(self), len(self) + len(keys))))
        self.held += len(ids)

    def align(self, docs: list[list[bytes] | None]) -> Iterator[tuple[int, bytes, np.ndarray] | None]:
        """Of each document, given by its windows: number of groups, their text, and the codes of all links."""
        if self.held > REMEMBERED:
            self.forget()
        new = dict.fromkeys(k for keys in docs if keys for k in keys if k not in self)
        if new:
            self.learn(list(new))
        for keys in docs:
            if keys is None:
                yield None
                continue
            numbers = list(map(self.__getitem__, keys))
            codes = np.frombuffer(b"".join(map(self.pairs.__getitem__, numbers)), "<u8")
            yield sum(map(self.n_groups.__getitem__, numbers)), b";".join(map(self.shown.__getitem__, numbers)), codes


FIELDS = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")] + [T.StructField("groups_sha256", T.StringType())]
PAIRS = [T.StructField("codes", T.BinaryType()), T.StructField("numbers", T.BinaryType())]


def alignments(docs: DataFrame, a_path: str, b_path: str, pattern: str, key: str = "doc_id", text: str = "text", groups: bool = False) -> tuple[DataFrame, int]:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, codes, numbers (the document's id pairs: A's id times the returned size of B,
    plus B's id, and how many links hold each); with `groups`, also the groups as text."""
    source = texts(docs, key, text)
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        files = source.sparkSession.sparkContext.broadcast((a_file.read(), b_file.read()))  # two fixed vocabulary files
    schema = T.StructType([source.schema["doc_id"], *FIELDS, *PAIRS, *[T.StructField("groups", T.StringType())] * groups])
    size, job = len(Pieces(files.value[1]).bytes), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> tuple[ByteLevel, Pieces, Windows]:
            a, b = ByteLevel(files.value[0], pattern), Pieces(files.value[1])
            return a, b, Windows(a.bytes, b.bytes)

        side_a, side_b, windows = per_worker("windows", job, make)
        for rows, values in slices(batches):
            out, held, size = [], [], 0
            for number, value in enumerate(values):
                a, b = (side_a.encode(value), side_b.encode(value)) if value else ([], [])
                held.append((len(a), len(b), windows.windows(value, a, b) if value else None))
                size += len(value)
                if size < TOGETHER and number + 1 < len(values):
                    continue
                for (n_a, n_b, _), found in zip(held, windows.align([keys for _, _, keys in held])):
                    if found is None:
                        out.append((0, 0, 0, 0, "", b"", b"", ""))
                        continue
                    n_groups, shown, links = found
                    links = np.sort(links)
                    first = np.flatnonzero(np.diff(links, prepend=links[0] + np.uint64(1)))
                    codes, numbers = links[first], np.diff(first, append=len(links))
                    digest = hashlib.sha256(shown).hexdigest()
                    out.append((n_a, n_b, n_groups, len(links), digest, codes.tobytes(), numbers.astype("<u4").tobytes(), shown.decode() if groups else ""))
                held, size = [], 0
            columns = list(zip(*out))[: len(schema) - 1]
            kinds = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), *map(pa.array, columns, kinds)], names=schema.names)

    return source.mapInArrow(run, schema), size


def summed(codes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    once, at = np.unique(codes, return_inverse=True)
    sums = np.zeros(len(once), np.int64)
    np.add.at(sums, at, numbers)
    return once, sums


def pair_counts(found: DataFrame, size: int) -> DataFrame:
    """code, a, b, n (links that hold the pair, over all documents), best (no pair of b has more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(codes: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(numbers)], names=["code", "n"])

        codes, numbers, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            for c, n in zip(batch.column("codes"), batch.column("numbers")):
                codes.append(np.frombuffer(c.as_buffer(), "<u8"))
                numbers.append(np.frombuffer(n.as_buffer(), "<u4").astype(np.int64))
                held += len(codes[-1])
                if held > 2 * HELD:
                    c, n = summed(np.concatenate(codes), np.concatenate(numbers))
                    if len(c) > HELD:
                        yield row(c, n)
                        c, n = c[:0], n[:0]
                    codes, numbers, held = [c], [n], len(c)
        yield row(*summed(np.concatenate(codes), np.concatenate(numbers)))

    totals = found.select("codes", "numbers").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    b = (F.col("code") % F.lit(size)).alias("b")
    totals = stored(totals.select("code", F.floor(F.col("code") / F.lit(size)).alias("a"), b, "n"), "pair-totals")
    most = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(most, "b").select("code", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found, size = alignments(docs, a_path, b_path, pattern, key, text)
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "alignments")
    pairs = stored(pair_counts(found, size), "pair-counts")
    n = max(1, math.ceil(pairs.count() / block))
    plain = ["row", "doc_id", *[f.name for f in FIELDS]]
    schema = T.StructType([*found.select(plain).schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def looked_up(part: int) -> DataFrame:
        mine = pairs.filter(F.pmod(F.xxhash64("code"), F.lit(n)) == part).select("code", "n", "best").toArrow()  # `block` rows, about
        order = np.argsort(codes := mine.column("code").to_numpy())
        known = found.sparkSession.sparkContext.broadcast((codes[order], mine.column("n").to_numpy()[order], mine.column("best").to_numpy()[order]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, counts, best = known.value
            for batch in batches:
                sizes = np.array([len(x.as_buffer()) // 8 for x in batch.column("codes")], np.int64)
                all_codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), "<u8").astype(np.int64)
                numbers = np.frombuffer(b"".join(batch.column("numbers").to_pylist()), "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(codes, all_codes), max(0, len(codes) - 1))
                hit = codes[at] == all_codes if len(codes) else np.zeros(len(all_codes), bool)
                ends = np.cumsum(sizes)

                def totals(values: np.ndarray) -> pa.Array:
                    sums = np.append(0, np.cumsum(values))
                    return pa.array(sums[ends] - sums[ends - sizes])

                n_best = totals(numbers * (hit & best[at])) if len(codes) else totals(numbers * 0)
                count_sum = totals(numbers * counts[at] * hit) if len(codes) else totals(numbers * 0)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in plain), n_best, count_sum], names=schema.names)

        return found.select(*plain, "codes", "numbers").mapInArrow(run, schema)

    parts = reduce(DataFrame.unionAll, map(looked_up, range(n)))
    if n > 1:  # a row of each document per block
        parts = parts.groupBy(*plain).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return parts.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
