"""Pairwise alignment identity for use inside tasks, and edit-string checks."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..config import AlleleRules
from ..functions.keys import _reject


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


#: Cells of the score tables' rows that are worked on at a time; the rows stay in a core's cache.
CELLS = 1 << 15


def _padded(texts: list[str], fill: int) -> np.ndarray:
    out = np.full((len(texts), max(map(len, texts))), fill, np.int64)
    for i, t in enumerate(texts):
        out[i, : len(t)] = _codes(t)
    return out


#: Fields of a cell in one number, from the lowest bit: columns, matches, a place that decides between equal scores, the score.
MATCHES, TIE, SCORE = 15, 28, 41
#: Longest text whose lengths fit the fields, and largest cost.
PACKED_LENGTH, PACKED_COST = (1 << 13) - 1, 64


def alignment_counts_many(
    pairs: list[tuple[str, str]], match: int, mismatch: int, gap_open: int, gap_extend: int, free_ends: bool
) -> np.ndarray:
    """Matches and columns of the best affine-gap alignment of each pair; a gap of n costs open + (n-1)*extend.

    Equal scores prefer the diagonal, then the gap in `b`, then the gap in `a`.  With `free_ends` the gaps at both ends of
    both sequences are free and not counted.
    """
    costs = match, mismatch, gap_open, gap_extend
    fits = max(len(t) for pair in pairs for t in pair) <= PACKED_LENGTH and max(map(abs, costs)) <= PACKED_COST
    return (_packed_counts if fits else _wide_counts)(pairs, *costs, free_ends)


def _packed_counts(
    pairs: list[tuple[str, str]], match: int, mismatch: int, gap_open: int, gap_extend: int, free_ends: bool
) -> np.ndarray:
    """As `_wide_counts`, with score, matches and columns of a cell in one number, so that a choice is one maximum."""
    order = sorted(range(len(pairs)), key=lambda i: -len(pairs[i][0]))
    x, y = _padded([pairs[i][0] for i in order], -1).astype(np.int32), _padded([pairs[i][1] for i in order], -2).astype(np.int32)
    n, width = np.array([len(pairs[i][0]) for i in order]), np.array([len(pairs[i][1]) for i in order])
    m, every = y.shape[1], np.arange(len(order))
    cols, low = np.arange(m + 1, dtype=np.int64), -(1 << 21)
    tie, clear = 1 << TIE, ~(((1 << SCORE - TIE) - 1) << TIE)
    step, equal = (mismatch << SCORE) + 1 + tie, (match - mismatch << SCORE) + (1 << MATCHES)
    opened, longer = (-gap_open << SCORE) + 1 + tie, (-gap_extend << SCORE) + 1
    # gaps along a row: the best start, the leftmost of equal ones, is a running maximum
    begin = (cols * gap_extend << SCORE) + (m - cols << TIE) + (m - cols)
    reach = (-(gap_open + (cols[1:] - 1) * gap_extend) << SCORE) + cols[1:] - m
    start = np.zeros(m + 1, np.int64) if free_ends else (-(gap_open + gap_extend * (cols - 1)) << SCORE) + cols
    start[0] = 0
    h, p, u = np.tile(start, (len(order), 1)), np.empty((len(order), m + 1), np.int64), np.empty((len(order), m + 1), np.int64)
    e, best = np.full((len(order), m + 1), low << SCORE, np.int64), np.full(len(order), low << SCORE, np.int64)
    for i in range(1, x.shape[1] + 1):
        live = int(np.searchsorted(-n, -i, "right"))
        if live < len(h):
            h, p, u, e = (t[:live] for t in (h, p, u, e))
        np.add(h, opened, out=u)
        e += longer
        np.maximum(e, u, out=e)
        e &= clear
        p[:, 0] = 0 if free_ends else (-(gap_open + gap_extend * (i - 1)) << SCORE) + i
        inner = p[:, 1:]
        np.multiply(y[:live] == x[:live, i - 1 : i], equal, out=inner)
        inner += h[:, :-1]
        inner += step
        np.maximum(inner, e[:, 1:], out=inner)
        inner &= clear
        np.add(p, begin, out=u)
        np.maximum.accumulate(u, axis=1, out=u)
        u &= clear
        side = u[:, :-1]
        side += reach
        inner += tie
        np.maximum(inner, side, out=inner)
        inner &= clear
        h, p = p, h
        done = np.flatnonzero(n[:live] == i)
        if free_ends:
            _best_cells(best, every[:live], h[every[:live], width[:live]])
            if len(done):
                last = np.where(cols <= width[done, None], h[done] >> SCORE, low)
                _best_cells(best, done, h[done, last.argmax(axis=1)])
        elif len(done):
            best[done] = h[done, width[done]]
    out = np.empty((len(order), 2), np.int64)
    out[order, 0], out[order, 1] = best >> MATCHES & (1 << TIE - MATCHES) - 1, best & (1 << MATCHES) - 1
    return out


def _best_cells(best: np.ndarray, at: np.ndarray, cells: np.ndarray) -> None:
    wins = cells >> SCORE > best[at] >> SCORE
    best[at[wins]] = cells[wins]


def _wide_counts(
    pairs: list[tuple[str, str]], match: int, mismatch: int, gap_open: int, gap_extend: int, free_ends: bool
) -> np.ndarray:
    """`alignment_counts_many` for texts of any length, with a table each for score, matches and columns.

    One row of all score tables at a time, each row as whole-array steps.
    Columns beyond a pair's own are to the right of them and cannot reach back; pairs leave as their last row is done.
    """
    order = sorted(range(len(pairs)), key=lambda i: -len(pairs[i][0]))
    x, y = _padded([pairs[i][0] for i in order], -1), _padded([pairs[i][1] for i in order], -2)
    n, width = np.array([len(pairs[i][0]) for i in order]), np.array([len(pairs[i][1]) for i in order])
    m, every = y.shape[1], np.arange(len(order))
    low = -(10**9)
    cols = np.arange(m + 1, dtype=np.int64)
    start = np.zeros(m + 1, np.int64) if free_ends else -(gap_open + gap_extend * (cols - 1))
    start[0] = 0

    def rows(row: np.ndarray) -> np.ndarray:
        return np.tile(row, (len(order), 1))

    h, hm, hl = rows(start), rows(cols * 0), rows(cols * 0 if free_ends else cols)
    e, em, el = rows(cols * 0 + low), rows(cols * 0), rows(cols * 0)
    best = np.tile(np.array([low, 0, 0], np.int64), (len(order), 1))
    for i in range(1, x.shape[1] + 1):
        live = int(np.searchsorted(-n, -i, "right"))
        if live < len(h):
            h, hm, hl, e, em, el = (t[:live] for t in (h, hm, hl, e, em, el))
        opened = h - gap_open >= e - gap_extend
        e, em, el = np.where(opened, h - gap_open, e - gap_extend), np.where(opened, hm, em), np.where(opened, hl, el) + 1
        same = y[:live] == x[:live, i - 1 : i]
        p, pm, pl = np.empty_like(h), np.empty_like(h), np.empty_like(h)
        p[:, 0], pm[:, 0], pl[:, 0] = (0, 0, 0) if free_ends else (-(gap_open + gap_extend * (i - 1)), 0, i)
        p[:, 1:], pm[:, 1:], pl[:, 1:] = h[:, :-1] + np.where(same, match, mismatch), hm[:, :-1] + same, hl[:, :-1] + 1
        up = e[:, 1:] > p[:, 1:]
        for mine, other in ((p, e), (pm, em), (pl, el)):
            mine[:, 1:] = np.where(up, other[:, 1:], mine[:, 1:])
        packed = np.maximum.accumulate((p + cols * gap_extend) * (m + 1) + (m - cols), axis=1)
        k = m - packed[:, :-1] % (m + 1)
        f = np.take_along_axis(p, k, 1) - gap_open - (cols[1:] - k - 1) * gap_extend
        side = f > p[:, 1:]
        h, hm, hl = p.copy(), pm.copy(), pl.copy()
        h[:, 1:] = np.where(side, f, p[:, 1:])
        hm[:, 1:] = np.where(side, np.take_along_axis(pm, k, 1), pm[:, 1:])
        hl[:, 1:] = np.where(side, np.take_along_axis(pl, k, 1) + cols[1:] - k, pl[:, 1:])
        done = np.flatnonzero(n[:live] == i)
        if free_ends:
            at = every[:live], width[:live]
            _better(best, every[:live], h[at], hm[at], hl[at])
            if len(done):
                last = np.where(cols <= width[done, None], h[done], low)
                j = last.argmax(axis=1)
                _better(best, done, h[done, j], hm[done, j], hl[done, j])
        elif len(done):
            at = done, width[done]
            best[done] = np.stack([h[at], hm[at], hl[at]], axis=1)
    out = np.empty((len(order), 2), np.int64)
    out[order] = best[:, 1:]
    return out


def _better(best: np.ndarray, at: np.ndarray, score: np.ndarray, matches: np.ndarray, columns: np.ndarray) -> None:
    wins = score > best[at, 0]
    best[at[wins]] = np.stack([score, matches, columns], axis=1)[wins]


def alignment_counts(a: str, b: str, match: int, mismatch: int, gap_open: int, gap_extend: int, free_ends: bool) -> tuple[int, int]:
    matches, columns = alignment_counts_many([(a, b)], match, mismatch, gap_open, gap_extend, free_ends)[0]
    return int(matches), int(columns)


def sequence_identities(left: list[str], right: list[str], rules: AlleleRules = AlleleRules()) -> np.ndarray:
    """Matches per alignment column: with free ends, or (`ends` is `global`) end to end with the penalties 4/6/2.

    Equal-score alignments can differ in identity by argument order, so the order of the two texts is fixed.  Pairs of
    about one size are aligned together; a pair larger than that is aligned on its own.
    """
    if rules.ends not in ("free", "global"):
        raise ValueError(f"unknown kind of ends {rules.ends!r}")
    costs = (rules.match, rules.mismatch, rules.gap_open, rules.gap_extend, True) if rules.ends == "free" else (0, -4, 8, 2, False)
    out, rest = np.ones(len(left)), []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if not a or not b:
            raise ValueError("missing sequence")
        if a != b:
            rest.append((max(len(a), len(b)), i, (min(a, b), max(a, b))))
    rest.sort(key=lambda r: r[:2])
    start = 0
    for stop in range(1, len(rest) + 1):
        if stop == len(rest) or rest[stop][0] * (stop + 1 - start) > CELLS or rest[stop][0] > 1.25 * rest[start][0] + 8:
            counts = alignment_counts_many([pair for _, _, pair in rest[start:stop]], *costs)
            out[[i for _, i, _ in rest[start:stop]]] = np.where(counts[:, 1] > 0, counts[:, 0] / np.maximum(1, counts[:, 1]), 0.0)
            start = stop
    return out


def sequence_identity(a: str, b: str, rules: AlleleRules = AlleleRules()) -> float:
    return float(sequence_identities([a], [b], rules)[0])


def identity_udf(rules: AlleleRules = AlleleRules()):
    @F.pandas_udf(DoubleType())
    def identity(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(sequence_identities(a.tolist(), b.tolist(), rules), dtype="float64")

    return identity


def parse_cigar(cigar: Column) -> Column:
    """Operations of an edit string as an array of (n, op); anything else in the text is an error."""
    found = F.regexp_extract_all(cigar, F.lit(r"([0-9]+)([MID=X])"), F.lit(0))
    ops = F.transform(
        found,
        lambda t: F.struct(
            F.substr(t, F.lit(1), F.length(t) - 1).cast("long").alias("n"), F.right(t, F.lit(1)).alias("op")
        ),
    )
    clean = cigar.rlike(r"^(0*[1-9][0-9]*[MID=X])+$")
    return _reject(clean, ops, "invalid edit string")


@F.pandas_udf(StructType([StructField("matches", LongType()), StructField("columns", LongType())]))
def replay_cigar(a: pd.Series, b: pd.Series, cigar: pd.Series) -> pd.DataFrame:
    """Replay an edit string on both sequences; it must fit them exactly."""

    def replay(x: str, y: str, text: str) -> tuple[int, int]:
        i = j = matches = columns = 0
        for count, op in re.findall(r"([0-9]+)([MID=X])", text):
            n = int(count)
            if op in "M=X":
                same = int((_codes(x)[i : i + n] == _codes(y)[j : j + n]).sum()) if i + n <= len(x) and j + n <= len(y) else -1
                if same < 0 or (op == "=" and same != n) or (op == "X" and same):
                    raise ValueError("edit string contradicts the sequences")
                matches += same
            i += n if op in "M=XI" else 0
            j += n if op in "M=XD" else 0
            columns += n
        if (i, j) != (len(x), len(y)):
            raise ValueError("edit string does not consume both sequences")
        return matches, columns

    rows = [replay(x, y, t) for x, y, t in zip(a, b, cigar, strict=True)]
    return pd.DataFrame(rows, columns=["matches", "columns"], dtype="int64")
