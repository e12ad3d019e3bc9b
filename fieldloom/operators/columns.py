"""Schema and projection operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import clean_text
from fieldloom.operators.windows import ordinal


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename what is there (P10)."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def map_names(df: DataFrame, f: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[f(c) for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    return map_names(df, str.lower)


def snake_name(name: str) -> str:
    return re.sub("([A-Z]+)", lambda m: "_" + m[1].lower(), name)


def snake_columns(df: DataFrame) -> DataFrame:
    """Each run of capitals in a name gets an underscore and is lower-cased, at the start too."""
    return map_names(df, snake_name)


def underscore_columns(df: DataFrame) -> DataFrame:
    return map_names(df, lambda c: c.replace(" ", "_"))


def drop_strict(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; a missing one is an error."""
    columns = list(columns)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*columns)


def keep(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the listed columns that are there, in the table's order."""
    wanted = set(columns)
    return df.select(*[q(c) for c in df.columns if c in wanted])


def filled_counts(df: DataFrame) -> dict[str, int]:
    return df.agg(*[F.count(q(c)).alias(c) for c in df.columns]).first().asDict()


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold nulls alone; one pass counts all of them."""
    counts = filled_counts(df)
    return df.select(*[q(c) for c in df.columns if counts[c]])


def drop_any_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold any null."""
    counts = df.agg(F.count(F.lit(1)).alias("all rows"), *[F.count(q(c)).alias(c) for c in df.columns]).first()
    return df.select(*[q(c) for c in df.columns if counts[c] == counts["all rows"]])


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def copy_columns(df: DataFrame, copies: dict[str, str]) -> DataFrame:
    """{new: old}."""
    return df.withColumns({new: q(old) for new, old in copies.items()})


def align(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly these columns in this order, missing ones null (P20)."""
    return df.select(*[q(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def union_schema(frames: Iterable[DataFrame]) -> list[str]:
    """All column names in first-seen order."""
    return list(dict.fromkeys(c for df in frames for c in df.columns))


def invert_map(df: DataFrame, key: str, values: str) -> DataFrame:
    """(new, [old, ...]) to (old, [new, ...]), the new ones sorted."""
    pairs = df.select(F.explode(values).alias("old"), q(key).alias("new"))
    return pairs.groupBy("old").agg(F.array_sort(F.collect_list("new")).alias("new"))


def unique_keys(df: DataFrame, key: str, order: list[str], limit: int | None = None) -> DataFrame:
    """From its second use on, a key gets _1, _2, ...; uses beyond the limit go."""
    out = ordinal(df, [key], order, "_use")
    if limit is not None:
        out = out.filter(F.col("_use") <= limit + 1)
    return out.withColumn(key, F.when(F.col("_use") > 1, F.concat(q(key), F.lit("_"), (F.col("_use") - 1).cast("string"))).otherwise(q(key))).drop("_use")


def right_only(df: DataFrame, other: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """other with its keys and the columns that df lacks, sorted."""
    keys = list(keys)
    return other.select(*[q(c) for c in keys], *[q(c) for c in sorted(set(other.columns) - set(df.columns) - set(keys))])


def transposed(df: DataFrame, limit: int = 20) -> DataFrame:
    """Columns as rows, for a few rows (P25)."""
    return df.limit(limit).select(*[q(c).cast("string").alias(c) for c in df.columns]).transpose()


def cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast; what can't be is null."""
    return df.withColumns({c: q(c).try_cast(t) for c, t in types.items()})


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def over_text(df: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    """f on every text column, in one projection."""
    wanted = set(text_columns(df))
    return df.select(*[f(q(c)).alias(c) if c in wanted else q(c) for c in df.columns])


def remove_spaces(df: DataFrame) -> DataFrame:
    """Tabs and line breaks, real and printed, cut from all text columns."""
    return over_text(df, clean_text)


def null_out(df: DataFrame, *values: str) -> DataFrame:
    """Cells that are one of the values to null, in all text columns."""
    return over_text(df, lambda c: F.when(~F.coalesce(c.isin(*values), F.lit(False)), c))


def replace_values(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Whole cells replaced by the map, in all text columns."""
    return df.replace(values)


def fill(df: DataFrame, value: str | dict[str, Column]) -> DataFrame:
    """Nulls filled by a literal, or by a column for each name."""
    if isinstance(value, dict):
        return df.withColumns({c: F.coalesce(q(c), v) for c, v in value.items()})
    return df.na.fill(value)
