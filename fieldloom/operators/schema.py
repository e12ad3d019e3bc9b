"""Columns that the data decide (N04, N08, A07): a pass over the data finds the keys and their types, a bound says how many
become columns, and a map keeps every other key, so nothing is lost and no schema grows with the data.

The pass is a count of keys that is combined on the map side and an aggregation of types; at most ``width`` keys reach the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.columns import q

#: Keys that become columns, unless told otherwise.
WIDTH = 200


def frequent_keys(keys: DataFrame, column: str, width: int = WIDTH) -> list[str]:
    """The values of a column that most rows have, at most width of them; ties by name, the result by name."""
    counts = keys.filter(q(column).isNotNull()).groupBy(q(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return sorted(r["_key"] for r in counts.orderBy(F.desc("_n"), "_key").limit(width).collect())


def _path(key: str) -> str | None:
    """A key as a path; one with both sorts of quotes can't be written as one."""
    quote = "'" if "'" not in key else '"' if '"' not in key else None
    return quote and f"$[{quote}{key}{quote}]"


def _data_type(told: str | None) -> T.DataType:
    """The type that Spark tells for variants; what is void or mixed is text."""
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", told or "VOID").replace("OBJECT", "STRUCT<>")
    kind = T.DataType.fromDDL(ddl) if ddl != "STRUCT<>" else T.StringType()

    def plain(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in t.fields]) if t.fields else T.StringType()
        if isinstance(t, T.ArrayType):
            return T.ArrayType(plain(t.elementType))
        if isinstance(t, T.DecimalType):
            return T.DoubleType()
        return T.StringType() if isinstance(t, (T.NullType, T.VariantType)) else t

    return plain(kind)


def json_columns(df: DataFrame, column: str, width: int = WIDTH, rest: str = "rest", keys: list[str] | None = None) -> DataFrame:
    """A column of JSON objects as one column for each of its most frequent keys, with the types that all rows agree on.

    Other keys stay in the map ``rest`` (key to JSON text; null where there is none). Text that is no JSON object gives
    nulls. Keys that are columns of df already get an underscore behind them.
    """
    listed = F.from_json(q(column), "map<string,string>")
    if keys is None:
        keys = frequent_keys(df.select(F.explode(F.map_keys(listed)).alias("k")), "k", width)
    keys = [k for k in keys if _path(k)]  # the others stay in the map
    variant = F.try_parse_json(q(column))
    kinds = df.select(variant.alias("v")).agg(*[F.schema_of_variant_agg(F.try_variant_get("v", _path(k), "variant")).alias(f"k{i}") for i, k in enumerate(keys)]).first() if keys else ()
    taken = {c.lower() for c in df.columns if c != column} | {rest.lower()}
    out = []
    for k, told in zip(keys, kinds, strict=True):
        name = k
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(F.try_variant_get("_variant", _path(k), _data_type(told).simpleString()).alias(name))
    others = F.map_filter(listed, lambda k, _: ~k.isin(keys)) if keys else listed
    left = F.when(F.size(others) > 0, others)
    return df.withColumn("_variant", variant).select(*[q(c) for c in df.columns if c != column], *out, left.alias(rest))


def key_values(df: DataFrame, key: str, name: str, value: str, order: list[str], width: int = WIDTH, rest: str = "rest") -> DataFrame:
    """Key/value rows to a record for each id whose columns the data name: the most frequent names, later rows win.

    Dots in names become underscores. All other names stay in the map ``rest``, with their last value.
    """
    names = frequent_keys(df, name, width)
    place = F.struct(*[q(o) for o in order])
    last = df.groupBy(q(key).alias("_id"), q(name).alias("_name")).agg(F.max_by(q(value), place).alias("_value"))
    shown = F.when(q("_name").isin(names), q("_name")) if names else F.lit(None).cast("string")
    pairs = last.withColumn("_shown", shown)
    picked = [F.max_by("_value", F.when(F.col("_shown") == n, F.lit(1))).alias(n.replace(".", "_")) for n in names]
    others = F.map_from_entries(F.array_sort(F.collect_list(F.when(q("_name").isNotNull() & F.col("_shown").isNull(), F.struct(q("_name").alias("key"), q("_value").cast("string").alias("value"))))))
    made = pairs.groupBy("_id").agg(*picked, others.alias(rest))
    return made.select(F.col("_id").alias(key), *[q(n.replace(".", "_")) for n in names], F.when(F.size(rest) > 0, q(rest)).alias(rest))


def keyed_records(df: DataFrame, column: str, key: str, width: int = WIDTH, default: str = "Unknown", rest: str = "rest") -> DataFrame:
    """A list of records to a column for each of the most frequent values of their key; the other records stay in ``rest`` as JSON."""
    of = lambda x: F.coalesce(x[key].cast("string"), F.lit(default))
    keys = frequent_keys(df.select(F.explode(F.array_distinct(F.transform(q(column), of))).alias("k")), "k", width)
    last = lambda k: F.try_element_at(F.filter(q(column), lambda x: of(x) == k), F.lit(-1))
    named = [last(k).alias(k) for k in keys]
    others = F.filter(q(column), lambda x: ~of(x).isin(keys)) if keys else q(column)
    return df.select(*[q(c) for c in df.columns if c != column], *named, F.when(F.size(others) > 0, F.to_json(others)).alias(rest))


def flatten_json(df: DataFrame, column: str, width: int = WIDTH, sep: str = "|", rest: str = "rest") -> DataFrame:
    """JSON text without a declared schema, fully flattened: structs split to a|b|c, arrays exploded."""
    from fieldloom.operators.nested import fully_flatten

    wide = json_columns(df, column, width, rest)
    return fully_flatten(wide, sep)


