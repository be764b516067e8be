"""Checks as violation tables: an empty table is a pass.  Columns: rule, subject, detail."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as k

# Genome roles.
ROLES = ["primary_reference", "comparison_reference", "sample"]


def violation(df: DataFrame, rule: str, subject: Column, detail: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), subject.cast("string").alias("subject"),
        (detail if detail is not None else F.lit("")).cast("string").alias("detail"),
    )


def all_of(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def duplicates(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return violation(counted, rule, F.concat_ws("|", *[F.col(c).cast("string") for c in keys]), F.col("n"))


def missing_parent(child: DataFrame, fk: str, parent: DataFrame, pk: str, rule: str) -> DataFrame:
    """Distinct foreign keys without a parent; the distinct comes first, so a frequent key is shuffled once."""
    keys = child.filter(F.col(fk).isNotNull()).select(F.col(fk).alias("__k")).distinct()
    return violation(keys.join(parent.select(F.col(pk).alias("__k")), "__k", "left_anti"), rule, F.col("__k"))


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    one, two = left.select(*keys).distinct(), right.select(*keys).distinct()
    subject = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    return all_of([
        violation(one.join(two, list(keys), "left_anti"), rule, subject, F.lit("only_left")),
        violation(two.join(one, list(keys), "left_anti"), rule, subject, F.lit("only_right")),
    ])


def where(df: DataFrame, test: Column, rule: str, subject: Column, detail: Column | None = None) -> DataFrame:
    return violation(df.filter(F.coalesce(test, F.lit(False))), rule, subject, detail)


def row_checks(df: DataFrame, subject: Column, tests: Sequence[tuple]) -> DataFrame:
    """Row rules (test, rule) or (test, rule, detail), all evaluated in one scan."""
    found = [
        F.when(
            F.coalesce(t[0], F.lit(False)),
            F.struct(F.lit(t[1]).alias("rule"), (t[2] if len(t) > 2 else F.lit("")).cast("string").alias("detail")),
        )
        for t in tests
    ]
    hits = df.select(subject.cast("string").alias("subject"), F.explode(F.array_compact(F.array(*found))).alias("x"))
    return hits.select("x.rule", "subject", "x.detail")


def cell_problem(value: Column, kind: str, nullable: bool = False, unit: str = "", allowed: Sequence[str] | None = None) -> Column:
    """Name of the rule a text cell breaks, or null."""
    blank = value == ""
    tests: list[tuple[Column, str]] = []
    if kind == "integer":
        tests.append((~k.is_whole_number(value), "not_a_whole_number"))
    elif kind == "signed_integer":
        tests.append((~value.rlike("^[+-]?[0-9]+$"), "not_a_signed_integer"))
    elif kind == "number":
        number = value.try_cast("double")
        tests.append((number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")) | (number < 0), "not_a_number"))
        if unit == "fraction":
            tests.append((number > 1, "fraction_above_one"))
    elif kind == "json_array":
        tests.append((~F.coalesce(F.json_array_length(value) >= 0, F.lit(False)), "not_a_json_array"))
    elif kind == "json_object":
        tests.append((F.json_object_keys(value).isNull(), "not_a_json_object"))
    if allowed is not None:
        tests.append((~value.isin(*allowed), "value_not_allowed"))
    out = F.when(blank, F.lit(None if nullable else "missing_value").cast("string"))
    for test, name in tests:
        out = out.when(test, F.lit(name))
    return out


def check_cells(table: DataFrame, fields: dict[str, dict], subject: Column, name: str) -> DataFrame:
    """Cell problems of a text table.  All columns are tested in one scan."""
    tests = [
        F.struct(F.lit(c).alias("c"), F.col(c).alias("v"), cell_problem(F.col(c), **spec).alias("p"))
        for c, spec in fields.items()
    ]
    cells = table.select(subject.alias("s"), F.explode(F.array(*tests)).alias("x")).filter("x.p is not null")
    return cells.select(
        F.concat(F.lit(f"{name}:"), F.col("x.c"), F.lit(":"), F.col("x.p")).alias("rule"),
        F.col("s").cast("string").alias("subject"), F.col("x.v").alias("detail"),
    )
