"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a fresh folder in local mode (tests) and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, and survives a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove tables of settled that nothing will read again."""
    for t in tables:
        remove(t.sparkSession, t._written_to)


def _at(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside its place, then renamed."""
    at, system = _at(spark, path)
    beside, _ = _at(spark, f"{path}.{uuid.uuid4().hex}")
    out = system.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if system.exists(at):
        system.delete(at, False)
    if not system.rename(beside, at):
        raise OSError(f"{path} can't be written")


def read_text(spark: SparkSession, path: str) -> str:
    at, system = _at(spark, path)
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it isn't there."""
    at, system = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
