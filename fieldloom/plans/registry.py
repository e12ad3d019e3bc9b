"""Where queries and their DuckDB SQL are registered, and what they share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators.storage import remove, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Total order of lineitem rows.
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def query(sql: str | None = None) -> Callable:
    def mark(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return mark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt to many tasks, before each row becomes much work: a file of few row groups is read by few tasks."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


#: Folders below which this process's queries land their files, by session.
_LANDED: dict[int, str] = {}


def landing(spark: SparkSession, name: str) -> str:
    """A new folder for files that a query writes and reads back; all of a session's are removed when the process ends.

    A query's rows are read after it has returned, so it can't remove them itself.
    """
    if id(spark) not in _LANDED:
        _LANDED[id(spark)] = root = f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"
        atexit.register(lambda: remove(spark, root) if spark.sparkContext._jsc is not None else None)  # before the session's own end
    return f"{_LANDED[id(spark)]}/{name}-{uuid.uuid4().hex}"
