"""Batches of several tables that readers see whole or not at all, in runs of one setting each.

Layout below a target: ``run=<fingerprint>/<table>/batch=<number>`` holds rows, ``run=<fingerprint>/_commits/<number>`` says
that all tables of a batch are written, ``_current`` names the run that readers go by. Each of those marks is one file that
appears by a rename. A batch that is tried again replaces what its last try left, marked or not.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators.storage import discard, exists, list_names, read_text, remove, settled, write_text


def fingerprint(*settings) -> str:
    """A short digest of settings, the same for equal ones whatever the order of their keys."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()[:16]


def begin(spark: SparkSession, target: str, run: str) -> None:
    """Readers go by this run from now on; rows of other runs stay until ``drop_others``."""
    write_text(spark, f"{target}/_current", run)


def current(spark: SparkSession, target: str) -> str | None:
    return read_text(spark, f"{target}/_current") if exists(spark, f"{target}/_current") else None


def write_batch(tables: DataFrame, target: str, run: str, batch: int) -> None:
    """One table for each struct column, all of them visible at once.

    The batch is worked out once, into the shared folder; each table then reads its own columns from there.
    """
    spark, mark = tables.sparkSession, f"{target}/run={run}/_commits/{batch}"
    if exists(spark, mark):
        remove(spark, mark)  # tried again: not to be seen until it is whole
    staged = settled(tables, "batch")
    for name in tables.columns:
        staged.select(f"`{name}`.*").write.mode("overwrite").parquet(f"{target}/run={run}/{name}/batch={batch}")
    write_text(spark, mark, json.dumps({"batch": batch, "tables": tables.columns}))
    discard(staged)


def committed(spark: SparkSession, target: str, run: str | None = None) -> list[int]:
    """Numbers of the batches that are whole."""
    run = run or current(spark, target)
    return sorted(int(n) for n in list_names(spark, f"{target}/run={run}/_commits") if n.isdigit()) if run else []


def read_table(spark: SparkSession, target: str, name: str, run: str | None = None) -> DataFrame:
    """Rows of a table's whole batches; folders of others aren't listed into the scan."""
    run = run or current(spark, target)
    found = spark.read.option("basePath", f"{target}/run={run}/{name}").option("mergeSchema", True)
    paths = [f"{target}/run={run}/{name}/batch={b}" for b in committed(spark, target, run)]
    if not paths:
        raise ValueError(f"no batch of {name} is committed")
    return found.parquet(*paths).drop("batch")


def drop_others(spark: SparkSession, target: str) -> None:
    """Remove the rows of all runs but the current one."""
    run = current(spark, target)
    for n in list_names(spark, target):
        if n.startswith("run=") and n != f"run={run}":
            remove(spark, f"{target}/{n}")
