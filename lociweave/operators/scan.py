"""Ordered prefix computations that never place a whole group in one task.

A window partitioned by a group key puts the whole group in one task.  Here rows are range-partitioned on
(group, order), every slice is scanned on its own, and the state at the end of the earlier slices is carried in
through a table with at most one row per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SLICE = "__slice"


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, tuple[str, str | None]],
    slices: int | None = None,
    keep_slices: bool = False,
) -> DataFrame:
    """Add prefix columns computed per `group` in ascending `order` (which must be total within the group).

    `outputs` maps a new column to `(kind, column)`; kinds are `sum`, `max`, `count` (inclusive prefixes),
    `max_before` (prefix without the current row) and `lag` (value of the previous row of the group).
    With `keep_slices` the result can be scanned again in the same order without another range shuffle.
    """
    group, order = list(group), list(order)
    keys = [F.col(c) for c in group + order]
    if _SLICE in df.columns:
        ranged = df
    else:
        ranged = df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)
        ranged = materialize(ranged.withColumn(_SLICE, F.spark_partition_id()), "scan")

    local = Window.partitionBy(_SLICE, *group).orderBy(*order)
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = ranged
    totals = []
    for name, (kind, column) in outputs.items():
        if kind == "count":
            scanned = scanned.withColumn(name, F.count(F.lit(1)).over(running))
            totals.append(F.count(F.lit(1)).alias(name))
        elif kind in ("sum", "max"):
            fn = F.sum if kind == "sum" else F.max
            scanned = scanned.withColumn(name, fn(column).over(running))
            totals.append(fn(column).alias(name))
        elif kind == "max_before":
            before_me = local.rowsBetween(Window.unboundedPreceding, -1)
            scanned = scanned.withColumn(name, F.max(column).over(before_me))
            totals.append(F.max(column).alias(name))
        elif kind == "lag":
            scanned = scanned.withColumn(name, F.lag(column).over(local))
            scanned = scanned.withColumn(f"__first_{name}", F.row_number().over(local) == 1)
            totals.append(F.max_by(F.col(column), F.struct(*order)).alias(name))
        else:
            raise ValueError(f"unknown scan kind {kind!r}")

    earlier = Window.partitionBy(*group).orderBy(_SLICE) if group else Window.orderBy(_SLICE)
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carry = ranged.groupBy(_SLICE, *group).agg(*totals)
    carried: list[Column] = []
    for name, (kind, _) in outputs.items():
        if kind == "lag":
            carried.append(F.lag(name).over(earlier).alias(f"__carry_{name}"))
        elif kind in ("max", "max_before"):
            carried.append(F.max(name).over(before).alias(f"__carry_{name}"))
        else:
            carried.append(F.sum(name).over(before).alias(f"__carry_{name}"))
    # A slice can continue only one group (its first), so the carry table holds at most one row per slice.
    carry = (
        carry.select(_SLICE, *group, F.row_number().over(earlier).alias("__nth"), *carried)
        .filter("__nth > 1")
        .drop("__nth")
    )
    joined = scanned.join(F.broadcast(carry), [_SLICE, *group], "left")
    kept = [c for c in df.columns if c not in outputs and c != _SLICE]
    result: list[Column] = [F.col(c) for c in kept + ([_SLICE] if keep_slices else [])]
    for name, (kind, _) in outputs.items():
        carry_col = F.col(f"__carry_{name}")
        if kind == "lag":
            value = F.when(F.col(f"__first_{name}"), carry_col).otherwise(F.col(name))
        elif kind in ("max", "max_before"):
            value = F.greatest(F.col(name), carry_col)
        else:
            value = F.col(name) + F.coalesce(carry_col, F.lit(0))
        result.append(value.alias(name))
    return joined.select(*result)


def global_rank(df: DataFrame, order: Sequence[str], name: str, slices: int | None = None) -> DataFrame:
    """1-based position in a total order over the whole table, without a single-partition window."""
    return ordered_scan(df, [], order, {name: ("count", None)}, slices)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """First `k` rows per key.  Spark limits each map task to `k` rows per key before the shuffle, so a hot key is cheap."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
