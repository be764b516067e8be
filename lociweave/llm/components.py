"""Connected components of a link table, by alternating star contractions.

Each round joins every node to the smallest node in its neighbourhood; a round is two aggregations and two joins on the links that
are left, and the number of rounds grows with the logarithm of the component size. Minima are combined before the shuffle, so a node
with very many links costs one row per map task there; in the joins adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import dropped, stored


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of a node that are larger than it (or those that are not, and itself) to the smallest of them all."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    if larger:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = joined.filter("v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        )
    return out.filter("hi > lo").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root: the smallest node of the component, for every node that some link touches except the roots themselves.

    Links may repeat, point either way or join a node to itself; rows with a null end are no links.
    """
    pairs = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = stored(pairs.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi > lo").distinct(), "links")
    state = _state(now)
    while state[0]:
        after = stored(_star(_star(now, True), False), "links")
        found = _state(after)
        dropped(now)
        now = after
        if found == state:
            break
        state = found
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
