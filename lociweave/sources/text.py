"""Line and table readers: exact headers, fixed schemas, no inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.scan import global_rank


def numbered_lines(spark: SparkSession, path: str, number: bool = True) -> DataFrame:
    """Lines of text files with their position in file order (`line_no`, 1-based over all files)."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    if not number:
        return lines.select("line")
    return global_rank(lines, ["file", "block", "row"], "line_no").select("line", "line_no")


def _string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_table(spark: SparkSession, path: str, columns: Sequence[str], allow_empty: bool = False) -> DataFrame:
    """Tab-separated text with exactly these columns in this order; every cell stays a string.

    Empty cells are empty strings, and words such as `None`, `null` and `NA` are data. A cell with blanks around it or
    a NUL in it is an error.
    """
    header = spark.read.text(path).limit(1).first()
    if header is None or header[0].rstrip("\r").split("\t") != list(columns):
        raise ValueError(f"{path}: expected exactly the columns {list(columns)}")
    frame = _read(spark, path, columns)
    if not allow_empty and frame.limit(1).count() == 0:
        raise ValueError(f"{path}: no records")
    return frame.select(*[_clean(F.col(c), c).alias(c) for c in columns])


def read_loose_table(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text with a header of any columns, all strings."""
    header = spark.read.text(path).limit(1).first()
    if header is None:
        raise ValueError(f"{path}: no header")
    return _read(spark, path, header[0].rstrip("\r").split("\t"))


def table_columns(spark: SparkSession, path: str) -> list[str]:
    header = spark.read.text(path).limit(1).first()
    return header[0].rstrip("\r").split("\t") if header else []


def _read(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return (
        spark.read.schema(_string_schema(columns))
        .option("sep", "\t")
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("quote", "")
        .option("nullValue", "\0")
        .option("emptyValue", "")
        .csv(path)
        .na.fill("")
    )


def _clean(cell: Column, name: str) -> Column:
    bad = (F.trim(cell) != cell) | F.contains(cell, F.lit("\0"))
    return F.when(bad, F.raise_error(F.concat(F.lit(f"column {name}: blanks around a cell or a NUL in it: "), cell)).cast("string")).otherwise(cell)


def read_headerless(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headerless tab-separated lines with exactly these columns; blank lines and `#` lines are skipped."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"))
    kept = lines.filter((F.trim("line") != "") & ~F.startswith("line", F.lit("#")))
    parts = F.split("line", "\t", -1)
    checked = F.when(F.size(parts) == len(columns), parts).otherwise(
        F.raise_error(F.lit(f"expected exactly {len(columns)} tab-separated columns"))
    )
    return kept.select(checked.alias("p")).select(*[F.col("p")[i].alias(c) for i, c in enumerate(columns)])


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids in first-seen order; `#` lines and an optional `locus_id` header are not ids."""
    lines = numbered_lines(spark, path).filter((F.col("line") != "") & ~F.startswith("line", F.lit("#")))
    first = lines.orderBy("line_no").limit(1).first()
    fields = first["line"].split("\t") if first else []
    at = fields.index("locus_id") if "locus_id" in fields else 0
    parts = F.split("line", "\t", -1)
    value = F.trim(F.coalesce(F.get(parts, F.lit(at)), F.get(parts, F.lit(0))))
    return (
        lines.select(value.alias("locus_id"), "line_no")
        .filter((F.col("locus_id") != "") & (F.col("locus_id") != "locus_id"))
        .groupBy("locus_id")
        .agg(F.min("line_no").alias("ordinal"))
    )
