"""What the operators of this package share: input projection, intermediate tables, slices of Arrow batches."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root

#: Text that is handled at a time inside a task, in characters.
SLICE_CHARS = 4 << 20


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; a null text is an empty one."""
    return docs.select(docs[key].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.Table, list[str]]]:
    """Cut Arrow batches into row ranges of bounded text, so that what a task holds besides the batch stays small."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        ends = table.column(text).combine_chunks()
        sizes = pc.binary_length(ends).to_pylist() if len(ends) else []
        start = total = 0
        for row, size in enumerate(sizes):
            total += size or 0
            if total >= SLICE_CHARS or row - start >= 2000 or row + 1 == len(sizes):
                part = table.slice(start, row + 1 - start)
                yield part, part.column(text).to_pylist()
                start, total = row + 1, 0


def per_worker(name: str, job: str, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and keeps across the tasks of one job (functions travel by value, so their globals
    do not last). Another job's object takes its place."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if kept.get(name, ("", None))[0] != job:
        kept[name] = job, make()
    return kept[name][1]


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write `df` as a table in the cluster's shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table made by `stored` once its last reader is done."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")
