"""Aggregations (A01-A14). Order-dependent ones take an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.columns import q


def count_by(df: DataFrame, key: str, column: str, into: str = "n") -> DataFrame:
    """Filled cells of a group, the most first."""
    return df.groupBy(key).agg(F.count(q(column)).alias(into)).orderBy(F.desc(into), key)


def value_counts(df: DataFrame, column: str, into: str = "n") -> DataFrame:
    """Rows of each value, nulls left out."""
    return df.filter(q(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(into)).orderBy(F.desc(into), column)


def collect_structs(df: DataFrame, key: str, fields: list[str], order: list[str], into: str = "items") -> DataFrame:
    """A list of structs for each key in a given order, other columns from the first row; one aggregation."""
    place = F.struct(*[q(c) for c in order])
    rest = [c for c in df.columns if c not in (key, *fields)]
    items = F.array_sort(F.collect_list(F.struct(place.alias("at"), F.struct(*fields).alias("x"))))
    return df.groupBy(key).agg(*[F.min_by(q(c), place).alias(c) for c in rest], F.transform(items, lambda i: i["x"]).alias(into))


def set_join(df: DataFrame, keys: list[str], column: str, sep: str = "|", into: str | None = None) -> DataFrame:
    """Sorted distinct values of a group as text."""
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(q(column))), sep).alias(into or column))


def pivot_last(df: DataFrame, key: str, name: str, value: str, order: list[str], names: list[str]) -> DataFrame:
    """A column for each listed name, with the last value in order."""
    last = [F.max_by(q(value), F.when(q(name) == n, F.struct(*order))).alias(n) for n in names]
    return df.groupBy(key).agg(*last)


def pivot_lists(df: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """A column for each listed name with the sorted list of values, null where there is none."""
    lists = [F.array_sort(F.collect_list(F.when(q(name) == n, q(value)))).alias(n) for n in names]
    found = df.groupBy(key).agg(*lists)
    return found.select(key, *[F.when(F.size(q(n)) > 0, q(n)).alias(n) for n in names])


def kv_to_columns(df: DataFrame, key: str, name: str, value: str, order: list[str], names: list[str]) -> DataFrame:
    """Key/value rows to a record for each id: later ones win, dots in names become underscores."""
    flat = pivot_last(df, key, name, value, order, names)
    return flat.select(key, *[q(n).alias(n.replace(".", "_")) for n in names])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(q(column)).distinct()


def fill_profile(df: DataFrame) -> DataFrame:
    """(column, filled), the fullest first; one pass (A10)."""
    counts = df.agg(*[F.count(q(c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), q(c).alias("filled")) for c in df.columns])
    return counts.select(F.inline(pairs)).orderBy(F.desc("filled"), "column")


def empty_count(df: DataFrame, column: str) -> int:
    """Nulls in a column, -1 if it isn't there."""
    return df.agg(F.count_if(q(column).isNull())).first()[0] if column in df.columns else -1


def filled_count(df: DataFrame, column: str) -> int:
    return df.agg(F.count(q(column))).first()[0] if column in df.columns else -1


def folder_sizes(files: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """Bytes below each folder at each depth."""
    parts = F.split(F.regexp_replace(q(path), "^/+", ""), "/")
    depths = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    folders = F.transform(depths, lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("folder")))
    return files.select(F.explode(folders).alias("f"), q(size).alias("s")).groupBy("f.depth", "f.folder").agg(F.sum("s").alias("size"))


def count_elements(df: DataFrame, column: str) -> DataFrame:
    """Elements of an array over all rows."""
    return df.agg(F.sum(F.when(q(column).isNotNull(), F.size(q(column))).otherwise(0)).alias("n"))


def merge_last(pairs: Column) -> Column:
    """A map of an array of (key, value) structs; of equal keys the last one stays."""
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["key"]), F.create_map(x["key"].cast("string"), x["value"].cast("string"))))
