"""Filters with pinned null rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.columns import q


def filter_eq(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(q(column) == F.lit(value))


def filter_ne(df: DataFrame, column: str, value: object) -> DataFrame:
    """Other values and nulls."""
    return df.filter(~q(column).eqNullSafe(F.lit(value)))


def filter_in(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    return df.filter(q(column).isin(*values))


def apply_exclusions(df: DataFrame, exclusions: dict[str, Iterable[object]]) -> DataFrame:
    """Without the rows that have a listed value in a column that is there; nulls stay."""
    tests = [F.coalesce(q(c).isin(*values), F.lit(False)) for c, values in exclusions.items() if c in df.columns]
    return df.filter(~reduce(lambda a, b: a | b, tests)) if tests else df


def filter_regex(df: DataFrame, column: str, pattern: str, negate: bool = False) -> DataFrame:
    """Rows whose cell has a match, or the others and nulls."""
    hit = F.coalesce(q(column).rlike(pattern), F.lit(False))
    return df.filter(~hit if negate else hit)


def filter_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(q(column).isNull())


def filter_notnull(df: DataFrame, column: str) -> DataFrame:
    return df.filter(q(column).isNotNull())


def printed_items(c: Column) -> Column:
    """Items of a printed list such as ['A' 'B']; null for other text."""
    return F.when(c.rlike(r"(?s)^\s*\[.*\]\s*$"), F.regexp_extract_all(c, F.lit("'([^']*)'|\"([^\"]*)\""), F.lit(0)))


def filter_list_overlap(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose printed list has one of the values; what is no list goes."""
    items = F.transform(printed_items(q(column)), lambda x: F.substring(x, F.lit(2), F.length(x) - 2))
    return df.filter(F.coalesce(F.arrays_overlap(items, F.array(*[F.lit(v) for v in values])), F.lit(False)))


def drop_where(df: DataFrame, test: Column) -> DataFrame:
    """Rows for which the test isn't true."""
    return df.filter(~F.coalesce(test, F.lit(False)))


def split_where(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """The rest, and the rows that pass; each row is in one of them."""
    hit = F.coalesce(test, F.lit(False))
    return df.filter(~hit), df.filter(hit)


def filter_array(df: DataFrame, column: str, field: str, value: object, into: str | None = None) -> DataFrame:
    """Elements of an array of structs whose field has the value."""
    return df.withColumn(into or column, F.filter(q(column), lambda x: x[field] == F.lit(value)))


def predicate(spec: dict | tuple | list) -> Column:
    """A test from nested data: {'and': [...]}, {'or': [...]}, {'not': x}, {'in': (c, values)}, {'eq': (c, v)}, {'notnull': c}."""
    ((kind, arg),) = spec.items()
    if kind in ("and", "or"):
        parts = [predicate(x) for x in arg]
        return reduce((lambda a, b: a & b) if kind == "and" else (lambda a, b: a | b), parts)
    if kind == "not":
        return ~predicate(arg)
    if kind == "in":
        return q(arg[0]).isin(*arg[1])
    if kind == "eq":
        return q(arg[0]) == F.lit(arg[1])
    if kind == "notnull":
        return q(arg).isNotNull()
    raise ValueError(f"no such test: {kind}")


#: Occurrences that are taken: kinds of record, one country, coordinates without issues, a status.
BASES = ("PRESERVED_SPECIMEN", "HUMAN_OBSERVATION", "OBSERVATION", "MACHINE_OBSERVATION", "MATERIAL_SAMPLE", "OCCURRENCE")


def select_occurrences(df: DataFrame, spec: dict) -> DataFrame:
    """Rows for which a nested test holds."""
    return df.filter(predicate(spec))


def select_any(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    return filter_in(df, column, values)


def skip_names(df: DataFrame, column: str) -> DataFrame:
    """Without blank names, '..' and names that start with an underscore."""
    name = F.trim(q(column))
    return df.filter(name.isNotNull() & (name != "") & (name != "..") & ~F.startswith(name, F.lit("_")))
