"""Writers (K01-K15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.columns import align
from fieldloom.sources import commits
from fieldloom.sources.readers import read_files


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = ",", mode: str = "overwrite") -> None:
    """Delimited text with a header; columns sets their order, missing ones are empty."""
    (align(df, columns) if columns else df).write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, columns: list[str] | None = None, as_text: bool = False, mode: str = "overwrite") -> None:
    """Parquet; as_text casts every value and writes nulls as blanks (K03), else nulls stay nulls."""
    out = align(df, columns) if columns else df
    if as_text:
        out = out.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in out.columns])
    out.write.mode(mode).parquet(path)


def write_events(df: DataFrame, path: str, mode: str = "overwrite", batch: int | None = None) -> None:
    """One table for each struct column of a converted table.

    With a batch number readers (``commits.read_table``) see all its tables at once or none; without one they are plain
    folders, written one after another.
    """
    if batch is not None:
        if commits.current(df.sparkSession, path) is None:
            commits.begin(df.sparkSession, path, "events")
        return commits.write_batch(df, path, commits.current(df.sparkSession, path), batch)
    for event in df.columns:
        df.select(f"`{event}`.*").write.mode(mode).parquet(f"{path}/{event}")


def compact(spark: SparkSession, source: str, target: str, files: int = 1) -> None:
    """Few files out of many; rows are moved, never shuffled."""
    spark.read.parquet(source).coalesce(files).write.mode("overwrite").parquet(target)


def merge_files(spark: SparkSession, paths: list[str], target: str, **options) -> None:
    """Files with different columns into one table, columns in first-seen order (K07); one scan of each format, however many files."""
    parquet, text = [p for p in paths if p.endswith(".parquet")], [p for p in paths if not p.endswith(".parquet")]
    frames = ([read_files(spark, text, **options)] if text else []) + ([spark.read.option("mergeSchema", True).parquet(*parquet)] if parquet else [])
    if parquet and paths[0] in parquet:
        frames.reverse()
    write_csv(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), target)


def convert_format(spark: SparkSession, source: str, target: str, source_format: str = "parquet", target_format: str = "csv") -> None:
    spark.read.format(source_format).option("header", True).load(source).write.mode("overwrite").option("header", True).format(target_format).save(target)


def write_parts(df: DataFrame, path: str, max_records: int, format_: str = "csv") -> None:
    """Part files of at most max_records rows."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", max_records).format(format_).save(path)


def write_examples(df: DataFrame, path: str) -> None:
    """A small sample as TSV, with a column that numbers it."""
    from fieldloom.operators.windows import number_rows

    write_csv(number_rows(df, "Example #"), path, sep="\t")


def to_list_payload(df: DataFrame, name: str, item: str, values: list[str], group: list[str] | None = None) -> DataFrame:
    """One JSON text a group: {listName, listItems: [{itemName, kvpValues: [{key, value}]}]}."""
    pairs = F.array(*[F.struct(F.lit(v).alias("key"), F.col(v).cast("string").alias("value")) for v in values])
    kept = F.filter(pairs, lambda p: p["value"].isNotNull())
    rows = df.select(*(group or []), F.struct(F.col(item).alias("itemName"), kept.alias("kvpValues")).alias("i"))
    lists = rows.groupBy(*(group or [])).agg(F.array_sort(F.collect_list("i")).alias("listItems"))
    return lists.select(*(group or []), F.to_json(F.struct(F.lit(name).alias("listName"), "listItems")).alias("payload"))


def write_ids(df: DataFrame, column: str, path: str) -> None:
    """One id a line."""
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def write_snapshot(df: DataFrame, path: str, date: str) -> None:
    """A dated run; only its own partition is replaced."""
    df.withColumn("snapshot_date", F.lit(date).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)
