"""Session construction and lineage cuts that survive executor loss."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "lociweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution; shuffle width and memory stay with the cluster settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir`, else (local runs only) a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = getattr(scratch_root, "_local", None)
    if root is None:
        root = tempfile.mkdtemp(prefix="lociweave-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        scratch_root._local = root
    return root


def materialize(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    This cuts lineage like a reliable checkpoint, and the reader keeps column pruning and real file sizes,
    so later joins are planned on measured bytes.  A table that was written here is returned as it is.
    Tables that are large and never a small side of a join may have a codec of their own.
    """
    if getattr(df, "_written", False):
        return df
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path, compression=codec)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = True
    return table
