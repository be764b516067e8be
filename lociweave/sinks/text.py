"""Writers: tab-separated tables, FASTA, JSON lines and Parquet; the Spark committer makes each of them all-or-nothing."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fasta_record(name: Column, sequence: Column, width: int = 60) -> Column:
    """Header and bases wrapped to `width`, with a line break after every full line."""
    return F.concat(F.lit(">"), name, F.lit("\n"), F.regexp_replace(sequence, f"(.{{{width}}})", "$1\n"))


def write_table(df: DataFrame, path: str, columns: Sequence[str], partition: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Gzip tab-separated text with a header and exactly these columns; nulls become empty cells."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns {missing}")
    keep = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    writer = keep.write.mode(mode).option("sep", "\t").option("header", True).option("compression", "gzip")
    writer = writer.option("emptyValue", "").option("quote", "").option("escapeQuotes", False)
    (writer.partitionBy(*partition) if partition else writer).csv(path)


def write_fasta(df: DataFrame, path: str, name: str = "name", sequence: str = "sequence", width: int = 60) -> None:
    """One FASTA record per row."""
    record = F.regexp_replace(fasta_record(F.col(name), F.col(sequence), width), "\n$", "")
    df.select(record.alias("value")).write.mode("errorifexists").option("compression", "gzip").text(path)


def write_json_lines(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    writer = df.write.mode("errorifexists").option("compression", "gzip")
    (writer.partitionBy(*partition) if partition else writer).json(path)


def write_parquet(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Partition values that hold very many rows are still written by many tasks: the data is not moved first."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def write_path_table(walks: DataFrame, path: str) -> None:
    """Unfolded walks partitioned by genome and contig, ordered inside each file."""
    ordered = walks.repartitionByRange("genome", "contig", "ordinal").sortWithinPartitions("genome", "contig", "ordinal")
    ordered.write.mode("errorifexists").partitionBy("genome", "contig").parquet(path)


def path_table_statistics(walks: DataFrame) -> DataFrame:
    """Rows, span and a digest of the rows per path (genome, contig); the digest does not depend on row order or files."""
    row = F.xxhash64("ordinal", "start0", "end0", "node", "rev").cast("decimal(38,0)")
    return walks.groupBy("genome", "contig").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("start0").alias("start0"), F.max("end0").alias("end0"),
        F.sha2(F.sum(row).cast("string"), 256).alias("digest"),
    )


def named_bed4(features: DataFrame, names: DataFrame) -> DataFrame:
    """sequence, start0, end0, fid with the names of another inventory (contig, sequence); a contig without a name is an error."""
    joined = features.join(names.select("contig", F.col("sequence").alias("__to")), "contig", "left")
    name = F.coalesce("__to", F.raise_error(F.concat(F.lit("no name for contig "), F.col("contig"))).cast("string"))
    return joined.select(name.alias("sequence"), "start0", "end0", "fid")


def write_bed4(features: DataFrame, names: DataFrame, path: str) -> None:
    rows = named_bed4(features, names).repartitionByRange("sequence", "start0", "end0").sortWithinPartitions("sequence", "start0", "end0", "fid")
    rows.select(F.concat_ws("\t", *rows.columns).alias("value")).write.mode("errorifexists").text(path)


def table_schema(tables: dict[str, DataFrame], keys: dict[str, list[str]], parents: dict[str, dict[str, str]]) -> str:
    """Columns, types, primary keys and foreign keys of the published tables as JSON."""
    out = {
        name: {
            "columns": df.columns, "types": {f.name: f.dataType.simpleString() for f in df.schema.fields},
            "primary_key": keys.get(name, []), "foreign_keys": parents.get(name, {}),
        }
        for name, df in tables.items()
    }
    return json.dumps({"delimiter": "tab", "missing_value": "", "genotype_missing_value": "NA", "tables": out}, indent=2)
