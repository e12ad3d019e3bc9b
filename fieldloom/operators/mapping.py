"""Mapping tables onto events of a common schema.

A mapping is a table (old, event, new, fallbacks). Every column of an input ends in exactly one event, as a struct column
named after it; columns without a mapping go to ``unmapped``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import cut_brackets, snake
from fieldloom.operators.columns import q

UNMAPPED = "unmapped"
#: Events of the legacy sheets, in the order of the sheets' columns (a T and a digit in front).
LEGACY_EVENTS = (
    "collection",
    "accession",
    "sample prep",
    "extraction",
    "sequencing",
    "assembly",
    "annotation",
    "record level",
)
#: Cells of the sheets that map nothing; a project's own prefix can be given besides.
IGNORED_VALUES = ("0", "1", "nan", "NaN")
IGNORED_PREFIXES = ('"', "/")


class Target(NamedTuple):
    event: str
    new: str
    fallbacks: tuple[str, ...] = ()


Mapping = dict[str, Target]


def collect_mapping(mapping: DataFrame) -> Mapping:
    """A mapping table as a dictionary; its size is that of a schema, not of data."""
    return {r["old"]: Target(r["event"], r["new"], tuple(r["fallbacks"] or ())) for r in mapping.collect()}


def apply_map(df: DataFrame, mapping: Mapping | DataFrame, unmapped_prefix: str | None = None) -> DataFrame:
    """One struct column for each event, in first-seen order.

    Nulls are filled from fallback columns in order. Two old columns with one new name get suffixes _1, _2.
    """
    found = collect_mapping(mapping) if isinstance(mapping, DataFrame) else mapping
    events: dict[str, list[Column]] = {}
    used: dict[tuple[str, str], int] = {}
    for old in df.columns:
        target = found.get(old, Target(UNMAPPED, f"{unmapped_prefix}_{old}" if unmapped_prefix else old))
        n = used[target.event, target.new] = used.get((target.event, target.new), -1) + 1
        name = f"{target.new}_{n}" if n else target.new
        others = [q(f) for f in target.fallbacks if f in df.columns]
        value = F.coalesce(q(old), *others) if others else q(old)
        events.setdefault(target.event, []).append(value.alias(name))
    return df.select(*[F.struct(*columns).alias(event) for event, columns in events.items()])


def check_entity(df: DataFrame, event: str, column: str) -> None:
    """The event and the column of the entity must be there before a job starts."""
    if event not in df.columns:
        raise ValueError(f"no event {event!r}")
    if column not in df.schema[event].dataType.names:
        raise ValueError(f"no column {column!r} in event {event!r}")


def with_entity_id(df: DataFrame, dataset_id: str, event: str = "collection", column: str = "scientific_name") -> DataFrame:
    """dataset_id and entity_id, in event collection; no separator, and null where the entity is null."""
    check_entity(df, event, column)
    entity = F.concat(F.lit(dataset_id), F.col(f"`{event}`.`{column}`").cast("string"))
    if "collection" in df.columns:
        own = F.col("collection").withField("dataset_id", F.lit(dataset_id)).withField("entity_id", entity)
    else:
        own = F.struct(F.lit(dataset_id).alias("dataset_id"), entity.alias("entity_id"))
    return df.withColumn("collection", own)


def conversion_stats(df: DataFrame) -> DataFrame:
    """columns, unmapped (their names), rows: one row about a converted table."""
    names = {event: df.schema[event].dataType.names for event in df.columns}
    return df.agg(
        F.lit(sum(map(len, names.values()))).alias("columns"), F.lit(",".join(names.get(UNMAPPED, []))).alias("unmapped"), F.count(F.lit(1)).alias("rows")
    )


def convert(df: DataFrame, mapping: Mapping | DataFrame, dataset_id: str, event: str = "collection", column: str = "scientific_name", prefix: str | None = None) -> DataFrame:
    """The whole conversion: map, fill, keep the unmapped, add ids."""
    return with_entity_id(apply_map(df, mapping, prefix), dataset_id, event, column)


def flat(df: DataFrame, sep: str = "_") -> DataFrame:
    """Events side by side as event_column."""
    return df.select(*[F.col(f"`{e}`.`{c}`").alias(f"{e}{sep}{c}") for e in df.columns for c in df.schema[e].dataType.names])


def _no_cell(cell: Column, prefixes: tuple[str, ...]) -> Column:
    plain = F.trim(cell)
    out = cell.isNull() | (plain == "") | plain.isin(*IGNORED_VALUES)
    for p in (*IGNORED_PREFIXES, *prefixes):
        out = out | F.startswith(plain, F.lit(p))
    return out


def _to_mapping(rows: DataFrame, keys: Column) -> DataFrame:
    """Rows (row_no, event, new) with an array of old names: the first is the key, a later row wins for equal keys."""
    listed = rows.select("row_no", "event", "new", F.filter(keys, lambda k: k != "").alias("k")).filter(F.size("k") > 0)
    value = F.struct("event", "new", F.slice("k", F.lit(2), F.size("k")).alias("fallbacks"))
    last = listed.groupBy(F.col("k")[0].alias("old")).agg(F.max_by(value, "row_no").alias("v"))
    return last.select("old", "v.event", "v.new", "v.fallbacks")


def compile_sheet(df: DataFrame, row_no: str, field: str = "Field Name", prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Mapping of a legacy sheet: a column for each event, cells 'a, b::x (note), c' (P02).

    The n-th column that starts with a T and a digit belongs to the n-th event, whatever its digit; columns beyond the
    last event are left out. A cell maps one row for each event; of equal keys the later event, then the later row wins.
    """
    columns = [c for c in df.columns if c[:1] == "T" and c[1:2].isdigit()][: len(LEGACY_EVENTS)]
    cells = [F.struct(F.lit(LEGACY_EVENTS[i]).alias("event"), q(c).cast("string").alias("cell"), F.lit(i).cast("long").alias("i")) for i, c in enumerate(columns)]
    rows = df.select(q(row_no).alias("row"), snake(F.replace(F.trim(q(field)), F.lit(" "), F.lit("_"))).alias("new"), F.explode(F.array(*cells)).alias("x"))
    rows = rows.select(F.struct("x.i", "row").alias("row_no"), "new", "x.event", "x.cell").filter(~_no_cell(F.col("cell"), prefixes))
    keys = F.transform(F.split(cut_brackets("cell"), ","), lambda k: F.btrim(F.substring_index(k, "::", 1), F.lit(" :")))
    return _to_mapping(rows, keys)


def compile_modern(df: DataFrame, column: str, row_no: str, label: str = "schema_label") -> DataFrame:
    """Mapping of a modern sheet: event, a label column and one column for each source, cells 'a; b' (P03)."""
    cell, event = q(column).cast("string"), F.trim("event")
    rows = df.select(q(row_no).alias("row_no"), event.alias("event"), F.trim(q(label)).alias("new"), cell.alias("cell"))
    rows = rows.filter(F.col("cell").isNotNull() & (F.trim("cell") != "") & ~F.startswith(F.col("cell"), F.lit('"')) & F.col("event").isNotNull() & (F.col("event") != ""))
    return _to_mapping(rows, F.transform(F.split("cell", ";"), lambda k: F.trim(k)))
