"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.storage import remove, shared_folder

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df to the shared folder and read it back, so that a lost executor costs no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove tables of materialise that nothing will read again."""
    for t in tables:
        remove(t.sparkSession, t._written_to)


def fresh(columns: Iterable[str], name: str) -> str:
    """A name for a helper column that no column of the input has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows in an Arrow batch that goes to Python at most; Spark's own 10,000 texts are tens of megabytes on both sides.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, in a session that sends texts to Python in small Arrow batches; a smaller setting of the user's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(df.sparkSession.conf.get(name))
    if not 0 < rows <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def all_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def one_of(df: DataFrame, keys: list[Column]) -> DataFrame:
    """One row for each combination of keys, the one whose printed columns have the smallest hash; combined on the map side."""
    printed = F.xxhash64(F.to_json(F.struct(*all_of(df)), {"ignoreNullFields": "false"}))
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    best = df.groupBy(*named).agg(F.min_by(F.struct(*all_of(df)), printed).alias("row"))
    return best.select("row.*")


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def with_global_rank(df: DataFrame, order: list[Column], name: str, rank: str = "rank") -> DataFrame:
    """Add a gapless 1-based rank in the given order without a one-partition window.

    Rows are range-partitioned and sorted; only one count per partition is brought together.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    )
    placed = materialise(placed, name)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect()  # one row per partition
    offsets, total = {}, 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets[row["_part"]] = total
        total += row["_n"]
    base = F.lit(0).cast("long")
    if offsets:
        base = F.element_at(F.create_map(*[F.lit(x) for k, v in offsets.items() for x in (k, v)]), F.col("_part")).cast("long")
    return placed.withColumn(rank, base + F.col("_pos") + 1).drop("_part", "_pos")


def row_pieces(frames: Iterator[pd.DataFrame], max_chars: int = 8_000_000, column: str = "text") -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into pieces of bounded text, so that a run of very long documents can't fill a worker."""
    for frame in frames:
        lengths = frame[column].str.len().fillna(0).cumsum()
        for _, piece in frame.groupby((lengths // max_chars).astype("int64"), sort=False):
            yield piece


def arrow_pieces(batches: Iterator[pa.RecordBatch], max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of bounded text; nothing is copied until a slice's values are asked for."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
