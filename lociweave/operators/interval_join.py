"""Overlap join of two interval tables by multi-level bins.

An interval of length n lives on the smallest level whose bin width is at least n, so it touches at most two bins
there and at most two on every wider level.  A pair meets on the wider of its two levels only, and there in the bin
that holds the larger start, so each pair is produced once.  Bins shared by very many rows on either side are cut
into a grid of salted cells, by a table of their sizes; that table has few rows and travels to the tasks, so each side
is shuffled once.  Both inputs are evaluated once: they are written, and everything else is read from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BASE_BITS = 8
STEP_BITS = 3
LEVELS = 18


def _level(start: Column, end: Column) -> Column:
    length = F.greatest(end - start, F.lit(1))
    return reduce(
        lambda a, b: a + b,
        [(length > F.lit(1 << (BASE_BITS + STEP_BITS * i))).cast("int") for i in range(LEVELS)],
    )


def _bin(position: Column, level: Column) -> Column:
    shift = (level * STEP_BITS + BASE_BITS).cast("int")
    return F.call_function("shiftright", position, shift)


def _levels(df: DataFrame, start: str, end: str) -> dict[int, int]:
    """Rows of each level in use: at most LEVELS + 1 numbers."""
    return {r[0]: r[1] for r in df.groupBy(_level(F.col(start), F.col(end))).count().collect()}


def _spread(df: DataFrame, start: str, end: str, mine: Iterable[int], other: Iterable[int]) -> DataFrame:
    """Rows once per bin they touch on their own level (one of `mine`) and on the levels of the `other` side above it."""
    levels = sorted({*mine, *other}) or [0]
    last = F.greatest(F.col(end) - 1, F.col(start))
    cells = []
    for v in levels:
        held = F.lit(True) if len(levels) == 1 else F.col("__own") <= v if v in other else F.col("__own") == v
        low, high = _bin(F.col(start), F.lit(v)), _bin(last, F.lit(v))
        bins = [(held, low), (held & (high > low), high)]
        if v == LEVELS:  # the widest may be shorter than a range
            bins.append((held & (high > low + 1), low + 1))
        cells += [F.when(test, F.struct(F.lit(v).alias("__level"), at.alias("__bin"))) for test, at in bins]
    found = df.withColumn("__own", _level(F.col(start), F.col(end))).withColumn("__cell", F.explode(F.array(*cells)))
    return found.filter("__cell is not null").select(*df.columns, "__cell.__level", "__cell.__bin")


def _hot_cells(side: DataFrame, keys: list[str], rows: int, hot_rows: int, name: str) -> DataFrame | None:
    """Cells with more than `hot_rows` rows, and into how many parts they are cut; None if there are none.

    Rows are counted by a hash of their cell first, in so many groups that one without a hot cell stays well below
    `hot_rows`; only cells of larger groups are counted one by one.
    """
    groups = max(256, 16 * rows // hot_rows)
    group = F.pmod(F.xxhash64(*keys), F.lit(groups))
    large = [r[0] for r in side.groupBy(group.alias("__group")).count().filter(F.col("count") > hot_rows).collect()]
    if not large:
        return None
    counted = side.filter(group.isin(large)).groupBy(*keys).count().filter(F.col("count") > hot_rows)
    return counted.select(*keys, F.ceil(F.col("count") / hot_rows).cast("int").alias(name))


def _salted(df: DataFrame, cells: DataFrame, keys: list[str], mine: str, other: str) -> DataFrame:
    """Rows of a hot cell: each in one part of its own side (`mine`), for every part of the other side."""
    return (
        df.join(cells, keys, "left")
        .withColumn(f"__s{mine}", F.pmod(F.xxhash64("__row"), F.coalesce(f"__k{mine}", F.lit(1))).cast("int"))
        .withColumn(f"__s{other}", F.explode(F.sequence(F.lit(0), F.coalesce(f"__k{other}", F.lit(1)) - 1)))
        .drop("__kl", "__kr", "__row")
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    predicate: Column | None = None,
    hot_rows: int = 200_000,
) -> DataFrame:
    """Inner join of rows with equal `on` columns whose half-open ranges overlap (a zero-length range is a point).

    The two tables share the `on` columns and no other column.  `predicate` replaces the default half-open overlap
    test; it must imply that the ranges share a base.
    """
    on = list(on)
    (ls, le), (rs, re) = left_range, right_range
    columns = [c for c in left.columns if c not in on], [c for c in right.columns if c not in on]
    left, right = materialize(left, "left"), materialize(right, "right")
    keys = [*on, "__level", "__bin"]
    levels_l, levels_r = _levels(left, ls, le), _levels(right, rs, re)

    def sides(row: Column | None) -> tuple[DataFrame, DataFrame]:
        both = [t if row is None else t.withColumn("__row", row) for t in (left, right)]
        return _spread(both[0], ls, le, levels_l, levels_r), _spread(both[1], rs, re, levels_r, levels_l)

    lhs, rhs = sides(None)
    copies = 2 * (1 + len(levels_l.keys() | levels_r.keys()))
    hot_l = _hot_cells(lhs, keys, copies * sum(levels_l.values()), hot_rows, "__kl")
    hot_r = _hot_cells(rhs, keys, copies * sum(levels_r.values()), hot_rows, "__kr")
    if hot_l is not None or hot_r is not None:
        one = F.lit(1).alias
        cells = (
            hot_l.join(hot_r, keys, "full") if hot_l is not None and hot_r is not None
            else hot_l.select("*", one("__kr")) if hot_l is not None else hot_r.select("*", one("__kl"))
        ).na.fill(1, ["__kl", "__kr"])
        cells = F.broadcast(materialize(cells, "cells"))
        # Rows are numbered as files hold them: a salt must not change when a lost task runs again, and equal rows must spread.
        lhs, rhs = sides(F.monotonically_increasing_id())
        lhs, rhs = _salted(lhs, cells, keys, "l", "r"), _salted(rhs, cells, keys, "r", "l")
        keys = [*keys, "__sl", "__sr"]
    own_l, own_r = _level(F.col(ls), F.col(le)), _level(F.col(rs), F.col(re))
    meets = F.col("__level") == F.greatest(own_l, own_r)
    once = F.col("__bin") == _bin(F.greatest(F.col(ls), F.col(rs)), F.col("__level"))
    if predicate is None:
        predicate = (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le))
    return (
        lhs.join(rhs, keys, "inner")
        .filter(predicate & once & meets)
        .select(*on, *columns[0], *columns[1])
    )
