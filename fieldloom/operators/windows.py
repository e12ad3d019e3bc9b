"""Order-dependent operators; every one takes its order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.operators.storage import settled


def ordinal(df: DataFrame, keys: list[str], order: list[str | Column], into: str = "ordinal", spread: bool = False) -> DataFrame:
    """1-based place of a row among those with its key.

    A key's rows are numbered in one task unless spread is set: then rows are dealt by ranges of key and order, each range
    is numbered by itself, and the keys that go on from one range to the next get one count a range. It costs another
    shuffle and suits tables in which one key holds much of the rows.
    """
    if not spread:
        return df.withColumn(into, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    placed = settled(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    own = placed.withColumn(into, F.row_number().over(W.partitionBy("_part", *keys).orderBy(*order)))
    names = [f"_of_{c}" for c in keys]
    counts = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a range that the key is in
    carried = counts.withColumn("_base", F.sum("_n").over(before)).filter(F.col("_base").isNotNull())
    base = settled(carried.select(F.col("_part").alias("_to"), "_base", *[F.col(f"`{c}`").alias(n) for c, n in zip(keys, names, strict=True)]), "carried")  # a row a range at most
    same = [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in zip(keys, names, strict=True)]
    met = reduce(lambda x, y: x & y, same, F.col("_part") == F.col("_to"))
    return own.join(base, met, "left").withColumn(into, (F.col(into) + F.coalesce("_base", F.lit(0))).cast("int")).select(*[F.col(f"`{c}`") for c in df.columns], into)


def ffill(df: DataFrame, order: list[str], partition: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Nulls take the last value before them.

    Without a partition the order is total: rows are range-partitioned and filled where they are, and what a partition
    hands on to the next is one row, so no task sees the whole table.
    """
    partition = partition or []
    columns = columns or [c for c in df.columns if c not in (*order, *partition)]
    if partition:
        before = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(before) for c in columns})
    placed = settled(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")  # one placement for both uses
    within = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    own = placed.withColumns({f"_own_{c}": F.last(F.col(c), ignorenulls=True).over(within) for c in columns})
    last = placed.groupBy("_part").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_last_{c}") for c in columns])
    carried = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    carry = last.select(F.col("_part").alias("_to"), *[F.last(f"_last_{c}", ignorenulls=True).over(carried).alias(f"_carry_{c}") for c in columns])
    joined = own.join(carry, F.col("_part") == F.col("_to"))
    return joined.select(*[F.coalesce(f"_own_{c}", f"_carry_{c}").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key.

    Spark keeps one row a key in each task before the shuffle (a group limit under the window), so a key of many rows
    sends one row a task on.
    """
    return ordinal(df, keys, order, "_place").filter("_place = 1").drop("_place")


def number_rows(df: DataFrame, into: str = "row_no", order: list[str] | None = None) -> DataFrame:
    """A gapless 1-based number in front (W04), in the given order or as the partitions lie.

    Rows are numbered where they are; what partitions tell each other is one count each.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = settled(placed.withColumns({"_part": F.spark_partition_id(), "_pos": within}), "numbered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select(F.col("_part").alias("_to"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    number = (F.col("_base") + F.col("_pos") + 1).alias(into)
    return placed.join(base, F.col("_part") == F.col("_to")).select(number, *[F.col(f"`{c}`") for c in df.columns])


def nth_snapshot(df: DataFrame, column: str, n: int = 0) -> DataFrame:
    """Rows of the n-th latest date; it is an error if there is none."""
    dates = df.select(column).distinct().orderBy(F.desc(column)).limit(n + 1).collect()  # n + 1 dates
    if len(dates) <= n:
        raise ValueError(f"there are {len(dates)} snapshots")
    return df.filter(F.col(column) == F.lit(dates[n][0]))


def last_success(runs: DataFrame, started: str = "task started", success: str = "success", keys: list[str] | None = None) -> DataFrame:
    """The latest successful run of each key."""
    latest = runs.filter(F.col(f"`{success}`")).groupBy(*(keys or [])).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in runs.columns]), F.col(f"`{started}`")).alias("r"))
    return latest.select("r.*")
