"""Sorts, samples and top-k."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.operators.columns import q


def sort(df: DataFrame, *columns: str, descending: bool = False) -> DataFrame:
    return df.orderBy(*[F.desc(c) if descending else F.asc(c) for c in columns])


def head(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def _place(seed: int, columns: list[str]) -> Column:
    """A seeded digest of the printed columns: an order that neither partitions nor engines change."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(q(c).cast("string"), F.lit("")) for c in columns]))


def sample_n(df: DataFrame, n: int, seed: int, keys: list[str] | None = None) -> DataFrame:
    """Exactly n rows (all if there are fewer), in the order of a seeded hash of keys (all columns unless given); a top-n, not a sort."""
    return df.orderBy(_place(seed, keys or df.columns), *[q(c) for c in keys or []]).limit(n)


def sample_fields(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Up to n distinct filled values of each column, as (field, value).

    A task keeps a bottom-k sketch for each column, the n values whose seeded digests are least, and sends only those on;
    the sketches' union has the n least of all.
    """
    fields = df.columns

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, dict[str, str]] = {f: {} for f in fields}
        for batch in batches:
            for i, field in enumerate(fields):
                kept = least[field]
                new = [v for v in batch.column(i).unique().to_pylist() if v is not None and v not in kept]
                placed = [(hashlib.md5(f"{seed}|{field}|{v}".encode()).hexdigest(), v) for v in new]
                if len(kept) + len(placed) > n:
                    bound = max(((p, v) for v, p in kept.items()), default=("", "")) if len(kept) >= n else None
                    placed = [x for x in placed if bound is None or x < bound]
                    kept = dict((v, p) for p, v in sorted([*placed, *((p, v) for v, p in kept.items())])[:n])
                else:
                    kept = kept | {v: p for p, v in placed}
                least[field] = kept
        rows = [(f, v, p) for f, kept in least.items() for v, p in kept.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["field", "value", "place"])

    cells = df.select(*[q(c).cast("string").alias(f"c{i}") for i, c in enumerate(fields)])
    few = cells.mapInArrow(sketch, "field string, value string, place string").distinct()
    best = W.partitionBy("field").orderBy("place", "value")  # n rows a task at most
    return few.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= n).select("field", "value")


def nulls_in_row(df: DataFrame) -> Column:
    return sum([q(c).isNull().cast("int") for c in df.columns], F.lit(0))


def fullest_records(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The n rows with the fewest nulls; ties by order."""
    return df.withColumn("_nulls", nulls_in_row(df)).orderBy("_nulls", *order).limit(n).drop("_nulls")


def sample_records(df: DataFrame, n: int, seed: int, pool: int | None = None) -> DataFrame:
    """Distinct rows, a seeded sample of them, the fullest n first."""
    rows = sample_n(df.distinct(), pool or 10 * n, seed)
    return fullest_records(rows, n, df.columns)


def top_k(df: DataFrame, column: str, k: int, ties: list[str] | None = None) -> DataFrame:
    return df.orderBy(F.desc(column), *(ties or [])).limit(k)


def array_argmax(column: str, score) -> Column:
    """The element with the greatest score, the first on ties."""
    scored = F.transform(q(column), lambda x, i: F.struct(score(x).alias("s"), (-i).alias("i"), x.alias("x")))
    return F.array_max(scored)["x"]


def prefer(df: DataFrame, columns: list[str], into: str) -> DataFrame:
    """The first filled of the columns; rows without any go."""
    return df.withColumn(into, F.coalesce(*[q(c) for c in columns])).filter(F.col(into).isNotNull())
