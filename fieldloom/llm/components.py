"""Connected components of a distributed edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import discard, materialise

#: Edges of one node in one part, about; a hub's edges lie in as many parts as that asks for.
PART = 20_000


def _least(edges: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """edges (u, v) with their part, and (w, at, m): the least v of each u, for every part of u's edges.

    Joined on node and part, no task gets a hub's edges whole.
    """
    parted = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)))
    own = parted.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = own.groupBy("u").agg(F.min("m").alias("m")).withColumnRenamed("u", "w")
    return parted, own.select("u", F.col("part").alias("at")).join(least, F.col("u") == F.col("w")).select("w", "at", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node that is not the smallest of its component; root is that smallest node.

    Each round is a few aggregations and joins over the edges; the number of rounds grows with the logarithm of the
    longest path. Nothing but a count and a checksum reaches the driver.
    """
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    cur, seen = materialise(cur, "edges"), None
    n = cur.count()
    met = (F.col("u") == F.col("w")) & (F.col("part") == F.col("at"))
    while n:
        parts = 8 + n // PART
        both, least = _least(cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v"))), parts)
        least = least.select("w", "at", F.least("w", "m").alias("m"))
        large = materialise(both.filter("v > u").join(least, met).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large")
        parted, least = _least(large, parts)
        hung = parted.join(least, met).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
        after = materialise(hung.filter("u <> v").unionByName(stars).distinct(), "small")
        discard(cur, large)
        cur = after
        n, check = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, check) == seen:
            break
        seen = n, check
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
