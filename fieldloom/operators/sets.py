"""Unions, distinct rows and differences."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.columns import q


def union(frames: Iterable[DataFrame]) -> DataFrame:
    """By name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def column_diff(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """Names that b lacks, names that b has besides."""
    return [c for c in a.columns if c not in b.columns], [c for c in b.columns if c not in a.columns]


def changed_since(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of after that are new or differ in a column; what is gone isn't reported."""
    old = before.select(q(key).alias("_key"), F.struct(*columns).alias("_old"))
    joined = after.join(old, q(key) == F.col("_key"), "left")
    return joined.filter(~F.struct(*columns).eqNullSafe(F.col("_old"))).select(*[q(c) for c in after.columns])
