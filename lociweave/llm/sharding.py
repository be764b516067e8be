"""Two-pass external shuffle into shards, on DataFrame functions only.

Pass one scatters the records over buckets of bounded size by a seeded hash of their position in the input, which no key or source
can skew: a third of all rows with one key spreads like the rest. Pass two shuffles every bucket by Fisher-Yates (the seeded
`shuffle` function over the bucket's records in a fixed order) and writes it. The buckets one after another are a random
permutation of all records; shards are equal cuts of it, so their row counts differ by one at most (law `rows`), and a record's slot
is its place in its shard. A table with a row per bucket carries the places over, in blocks of buckets. A task has many buckets once there
are more of them than the session has shuffle partitions. The permutation depends on how the input is split, as positions do.

The records are shuffled and written once. Defined results: null texts have no bytes; repeated rows and null keys are records like any
other; an empty table gives an empty result; all input columns are kept, in a struct, so their names cannot clash.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_root

#: Bytes of text that a bucket holds, about.
BUCKET_BYTES = 16 << 20
#: Buckets whose sizes are summed up together.
BLOCK = 4096


def scatter(docs: DataFrame, path: str, text: str = "text", seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write `docs` to `path`: bucket, place (in the shuffled bucket, from 0), record (all columns)."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(docs[text].cast("string")).cast("long") + 64), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / bucket_bytes))
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    placed = docs.select(record, F.monotonically_increasing_id().alias("row"))
    placed = placed.select("record", F.xxhash64(F.lit(seed), "row").alias("draw")).withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("int"))
    # The draw puts the records of a bucket in one order, whichever way they arrive; ties do not occur, as it permutes 64 bits.
    tasks = min(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = placed.repartition(tasks, "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("draw", "record"))).alias("records"))
    shuffled = groups.sortWithinPartitions("bucket").select("bucket", F.posexplode(F.shuffle("records", seed)).alias("place", "drawn"))
    shuffled.select("bucket", "place", "drawn.record").write.parquet(path)


def shards(spark: SparkSession, path: str, count: int = 8) -> DataFrame:
    """record, shard, slot of what `scatter` wrote."""
    buckets = spark.read.parquet(path)
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("n"))  # a row per block of buckets
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(total).alias("rows"))
    first = F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    sizes = sizes.join(F.broadcast(blocks), "block").select("bucket", first.alias("first"), "rows")
    rows = buckets.join(sizes, "bucket")
    shard = F.expr(f"cast((first + place) * {count} div rows as int)")
    start = F.expr(f"(shard * rows + {count - 1}) div {count}")
    return rows.withColumn("shard", shard).select("record", "shard", (F.col("first") + F.col("place") - start).alias("slot"))


def new_path(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/shards-{uuid.uuid4().hex}"
