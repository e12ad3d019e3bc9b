"""Joins (J01-J18). SQL null rules unless null_keys=True; colliding names need explicit suffixes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.columns import q
from fieldloom.operators.windows import keep_first


def _suffixed(left: DataFrame, right: DataFrame, shared: list[str], suffixes: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    clash = [c for c in left.columns if c in right.columns and c not in shared]
    if clash and suffixes[0] == suffixes[1]:
        raise ValueError(f"columns on both sides need suffixes: {clash}")
    return left.withColumnsRenamed({c: c + suffixes[0] for c in clash}), right.withColumnsRenamed({c: c + suffixes[1] for c in clash})


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_keys: bool = False, suffixes: tuple[str, str] = ("", "")) -> DataFrame:
    """Equi-join on shared keys, kept once; with null_keys null meets null."""
    left, right = _suffixed(left, right, keys, suffixes)
    if not null_keys:
        return left.join(right, keys, how)
    other = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [q(k).eqNullSafe(q(f"_key_{k}")) for k in keys])
    joined = left.join(other, on, how)
    return joined.withColumns({k: F.coalesce(q(k), q(f"_key_{k}")) for k in keys}).drop(*[f"_key_{k}" for k in keys])


def join_left(left: DataFrame, right: DataFrame, on: str | list[str], null_keys: bool = False, suffixes: tuple[str, str] = ("", "")) -> DataFrame:
    return join_on(left, right, [on] if isinstance(on, str) else on, "left", null_keys, suffixes)


def join_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "left", null_keys: bool = False, suffixes: tuple[str, str] = ("", "")) -> DataFrame:
    """Keys with different names, both kept."""
    left, right = _suffixed(left, right, [], suffixes)
    a, b = q(left_on), q(right_on)
    return left.join(right, a.eqNullSafe(b) if null_keys else a == b, how)


def join_outer(left: DataFrame, right: DataFrame, left_on: str, right_on: str, suffixes: tuple[str, str] = ("", "")) -> DataFrame:
    return join_keys(left, right, left_on, right_on, "full_outer", suffixes=suffixes)


def join_outer_chain(frames: list[DataFrame], key: str) -> DataFrame:
    """Full outer joins one after another, the key coalesced."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), frames)


def add_parent(df: DataFrame, key: str, parent_key: str, columns: dict[str, str], null_keys: bool = False) -> DataFrame:
    """Columns of the parent row, {column: new name}, by a self-join."""
    parent = df.select(q(key).alias("_parent"), *[q(c).alias(n) for c, n in columns.items()])
    on = q(parent_key).eqNullSafe(q("_parent")) if null_keys else q(parent_key) == q("_parent")
    return df.join(parent, on, "left").drop("_parent")


def add_accepted(df: DataFrame, key: str, columns: dict[str, str], accepted: Column, statuses: tuple[str, list[str]]) -> DataFrame:
    """Columns of the accepted row with the same key; then rows of two statuses alone."""
    usage = df.filter(accepted).select(q(key).alias("_own"), *[q(c).alias(n) for c, n in columns.items()])
    return df.join(usage, q(key) == q("_own"), "left").drop("_own").filter(q(statuses[0]).isin(*statuses[1]))


def fetch_from_twin(rows: DataFrame, twins: DataFrame, key: str, column: str, order: list[str] | None = None) -> DataFrame:
    """A column of rows replaced by that of the first twin with the same key, by order (the column itself unless given)."""
    return rows.drop(column).join(keep_first(twins, [key], order or [column]).select(q(key), q(column)), key, "left")


def join_role(df: DataFrame, dim: DataFrame, dim_key: str, roles: dict[str, dict[str, str]]) -> DataFrame:
    """One dimension under several names: {key column: {column of dim: new name}}."""
    for key, names in roles.items():
        role = dim.select(q(dim_key).alias("_role"), *[q(c).alias(n) for c, n in names.items()])
        df = df.join(role, q(key) == q("_role"), "left").drop("_role")
    return df


def resolve_synonyms(units: DataFrame, links: DataFrame, key: str, accepted_key: str, name: str, into: str = "status") -> DataFrame:
    """Synonyms get the accepted row's name and 'synonym of' it; others are 'valid name' (J10)."""
    accepted = units.select(q(key).alias("_accepted"), q(name).alias("accepted_name"))
    linked = links.select(q(key).alias("_synonym"), q(accepted_key).alias("_to")).join(accepted, q("_to") == q("_accepted"), "left").drop("_accepted")
    joined = units.join(linked, q(key) == q("_synonym"), "left")
    status = F.coalesce(F.concat(F.lit("synonym of "), F.col("accepted_name")), F.lit("valid name"))
    return joined.withColumn(into, status).drop("_synonym", "_to")


def semi_join(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Rows whose key is listed; the planner picks broadcast or shuffle by size."""
    return df.join(ids.select(q(ids_key or key).alias(key)), key, "left_semi")


def fill_from(df: DataFrame, other: DataFrame, key: str, columns: list[str], order: list[str], required: bool = True) -> DataFrame:
    """Columns filled from the first row of other with the key; rows that stay unfilled go if required."""
    first = keep_first(other, [key], order).select(q(key).alias("_key"), *[q(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(first, q(key) == q("_key"), "left")
    out = joined.withColumns({c: F.coalesce(q(c), q(f"_new_{c}")) if c in df.columns else q(f"_new_{c}") for c in columns})
    out = out.drop("_key", *[f"_new_{c}" for c in columns])
    return out.filter(reduce(lambda a, b: a & b, [q(c).isNotNull() for c in columns])) if required else out


def enrich_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: list[str]) -> DataFrame:
    """Columns of a keyed table, blanks as null; one join for all rows."""
    found = dim.select(q(dim_key).alias("_dim"), *[F.when(F.trim(q(c).cast("string")) != "", q(c)).alias(c) for c in columns])
    return df.join(found, q(key) == q("_dim"), "left").drop("_dim")


def map_codes(df: DataFrame, column: str, codes: dict[str, str], into: str | None = None, on_miss: str = "error") -> DataFrame:
    """Codes to values; a missing one is an error or null."""
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    value = table[q(column)]
    if on_miss == "error":
        value = F.when(q(column).isNull() | value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit("no such code: "), q(column).cast("string"))).cast("string"))
    return df.withColumn(into or column, value)


def enrich_by_rank(df: DataFrame, enrichment: DataFrame, key: str, name: str, ranks: list[str], suffix: str = "_{}", order: list[str] | None = None) -> DataFrame:
    """For each rank, join on (key, name) = (key, rank column); added columns get the rank as suffix.

    Of several rows for one key and name the first by order is taken (by the added columns unless given).
    """
    added = [c for c in enrichment.columns if c not in (key, *ranks)]
    for rank in ranks:
        own = keep_first(enrichment.filter(q(rank).isNotNull()), [key, rank], order or added)
        part = own.select(q(key).alias("_key"), q(rank).alias("_name"), *[q(c).alias(c + suffix.format(rank)) for c in added])
        df = df.join(part, (q(key) == q("_key")) & (q(name) == q("_name")), "left").drop("_key", "_name")
    return df
