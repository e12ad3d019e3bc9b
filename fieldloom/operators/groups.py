"""Group functions of the user's own, combined on the map side."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fieldloom.operators.columns import q

#: Keys whose states a task holds before it sends them on.
HELD = 50_000
_NAN = float("nan")  # one object, which is the same key as itself


class GroupFunction(NamedTuple):
    """start: a state from some of a group's rows, a list of tuples of the values; merge: one state of two; finish: a state's
    values, in the result's order.

    A task holds a state for each of at most ``HELD`` keys and a batch, never a group's rows. A group's states meet in one task,
    one after the other, one from each task that has rows of it (more where a task had to let go of some), so a state should be small.
    """

    start: Callable[[list[tuple]], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], tuple]


def _keys(batch: pa.RecordBatch, n: int) -> list[tuple]:
    columns = [c.to_pylist() if not pa.types.is_floating(c.type) else [_NAN if k != k else k for k in c.to_pylist()] for c in batch.columns[:n]]
    return list(zip(*columns, strict=True))


def _told(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def group_function(df: DataFrame, keys: list[str], values: list[str], f: GroupFunction, returns: str, held: int = HELD) -> DataFrame:
    """keys and the columns of ``returns`` (DDL): f over the values of each group. Null keys are a group; rows come in no order.

    Python sees whole batches and no group by itself: states lie sorted by key when they are merged.
    """
    kinds, n = dict(df.dtypes), len(keys)
    key_ddl = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    partial_ddl, whole_ddl = f"{key_ddl}, _state binary", f"{key_ddl}, {returns}"
    partial_type, whole_type = (to_arrow_schema(StructType.fromDDL(d)) for d in (partial_ddl, whole_ddl))
    start, merge, finish = f

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        told = lambda: _told([(*k, pickle.dumps(s)) for k, s in states.items()], partial_type)
        for batch in batches:
            groups: dict[tuple, list] = {}
            told_values = zip(*(c.to_pylist() for c in batch.columns[n:]), strict=True) if values else [()] * batch.num_rows
            for key, row in zip(_keys(batch, n), told_values, strict=True):
                groups.setdefault(key, []).append(row)
            for key, rows in groups.items():
                own = start(rows)
                states[key] = merge(states[key], own) if key in states else own
            if len(states) > held:
                yield told()
                states.clear()
        yield told()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for key, piece in zip(_keys(batch, n), batch.columns[n].to_pylist(), strict=True):
                own = pickle.loads(piece)
                if key == now:
                    state = merge(state, own)
                    continue
                if now is not None:
                    out.append((*now, *finish(state)))
                now, state = key, own
            yield _told(out, whole_type)
        if now is not None:
            yield _told([(*now, *finish(state))], whole_type)

    by = [q(k) for k in keys]
    states = df.select(*by, *map(q, values)).mapInArrow(partial, partial_ddl)
    return states.repartition(*by).sortWithinPartitions(*by).mapInArrow(whole, whole_ddl)


def common_prefix(df: DataFrame, keys: list[str], column: str, into: str = "prefix") -> DataFrame:
    """The longest text that all values of a group begin with; nulls are left out."""
    from os.path import commonprefix

    def start(rows: list[tuple]) -> list[str]:
        told = [v for (v,) in rows if v is not None]
        return told if len(told) < 2 else [commonprefix(told)]

    f = GroupFunction(start, lambda a, b: [commonprefix(a + b)] if a + b else [], lambda s: (s[0] if s else None,))
    return group_function(df, keys, [column], f, f"`{into}` string")


def largest_gap(df: DataFrame, keys: list[str], column: str, into: str = "gap") -> DataFrame:
    """The largest difference between neighbouring distinct values of a group; null where there are fewer than two.

    Distinct values are sorted by Spark, so a group may have any number of them.
    """
    by = [q(k) for k in keys]
    gap = q(column) - F.lag(q(column)).over(Window.partitionBy(*by).orderBy(q(column)))
    gaps = df.select(*by, q(column)).distinct().select(*by, gap.alias(into))
    return gaps.groupBy(*by).agg(F.max(q(into)).cast(dict(df.dtypes)[column]).alias(into))
