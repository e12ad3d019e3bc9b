"""Trees and link graphs (J19-J21). Loops run on the driver, each round is a few joins; no table is collected."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.columns import q
from fieldloom.operators.storage import discard, settled, shared_folder


def resolve_inheritance(df: DataFrame, key: str, parent: str, pairs: dict[str, str]) -> DataFrame:
    return resolve_and_report(df, key, parent, pairs)[0]


def resolve_and_report(df: DataFrame, key: str, parent: str, pairs: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """{flag: value}: where the flag is set, the value of the nearest ancestor whose flag is clear.

    Pointer jumping: each round a row whose source is still flagged takes its source's source, so rounds grow with the
    logarithm of the depth. A root that is its own parent, or a parent that isn't there, ends the walk with the value there.
    Flagged rows that lead in a circle have no such ancestor: that is an error. The second table, from the same rounds, has
    a row for each walk that a parent that isn't there has ended: (key, flag, missing).
    """
    sources = {f: f"_at_{f}" for f in pairs}
    cur = df.select(q(key).alias("_key"), *[F.when(F.coalesce(q(f), F.lit(False)), F.coalesce(q(parent), q(key))).otherwise(q(key)).alias(s) for f, s in sources.items()])
    cur = written = settled(cur, "pointers")
    for k in range(65):
        if k == 64:  # more steps than a table can have rows
            raise ValueError("flagged rows lead in a circle")
        out = cur
        for s in sources.values():
            up = cur.select(F.col("_key").alias("_up"), F.col(s).alias("_next"))
            out = out.join(up, F.col(s) == F.col("_up"), "left").withColumn(f"{s}_", F.coalesce("_next", s)).drop("_up", "_next")
        moved = settled(out, "pointers")
        same = not moved.filter(" or ".join(f"not ({s} <=> {s}_)" for s in sources.values())).take(1)
        discard(written)
        written = moved
        cur = moved.select("_key", *[F.col(f"{s}_").alias(s) for s in sources.values()])
        if same:
            break
    for f, s in sources.items():
        ends = df.filter(F.coalesce(q(f), F.lit(False)) & (q(parent) != q(key))).select(q(key).alias("_end"), q(parent).alias("_above"))
        inner = cur.join(ends, F.col(s) == F.col("_end"), "left_semi").join(ends.select("_end", "_above"), F.col(s) == F.col("_end"))
        if inner.join(df.select(q(key).alias("_any")), F.col("_above") == F.col("_any"), "left_semi").take(1):
            raise ValueError("flagged rows lead in a circle")
    walked = cur.select(F.col("_key").alias(key), F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(s).alias("missing")) for f, s in sources.items()])))
    missing = walked.filter(F.col("missing").isNotNull()).join(df.select(q(key).alias("_there")), F.col("missing") == F.col("_there"), "left_anti")
    out = df.join(cur, q(key) == F.col("_key"), "left")
    for f, v in pairs.items():
        at = df.select(q(key).alias("_src"), q(v).alias("_value"))
        out = out.join(at, F.col(sources[f]) == F.col("_src"), "left").withColumn(v, F.coalesce(F.col("_value"), q(v))).drop("_src", "_value")
    return out.drop("_key", *sources.values(), *pairs), missing


def walk_tree(nodes: DataFrame, key: str, parent: str, stop: str, path: str) -> DataFrame:
    """From the roots (null parent) down to the first nodes that have content, with the list of path values.

    It goes on until a level is empty. Only keys that repeat can lead in a circle; a path longer than the table is an error.
    """
    start = nodes.filter(q(parent).isNull() | (q(parent) == q(key)))
    level = settled(start.withColumn("path", F.array(q(path))), "level")
    below = nodes.filter(q(parent).isNotNull() & (q(parent) != q(key)))
    found = f"{shared_folder(nodes.sparkSession)}/walk-{uuid.uuid4().hex}"
    depth, longest = 0, None
    while True:
        level.filter(q(stop)).write.mode("append").parquet(found)
        up = level.filter(~F.coalesce(q(stop), F.lit(False))).select(q(key).alias("_up"), F.col("path").alias("_path"))
        down = below.join(up, q(parent) == F.col("_up"))
        after = settled(down.withColumn("path", F.array_append("_path", q(path))).drop("_up", "_path"), "level")
        discard(level)
        level, depth = after, depth + 1
        if not level.take(1):
            return nodes.sparkSession.read.schema(level.schema).parquet(found)
        if depth % 100 == 0:
            longest = longest or nodes.count()
            if depth > longest:
                raise ValueError("keys lead in a circle")


def crawl_frontier(links: DataFrame, seeds: DataFrame, depth: int, skip: list[str] | None = None) -> DataFrame:
    """(url, depth) of what links (source, target, name) reach from the seeds (url), layer by layer.

    Skipped names aren't followed; with a negative depth it goes on until nothing new is reached. What was seen is not
    visited again.
    """
    followed = links.filter(~F.coalesce(F.col("name").isin(*skip), F.lit(False))) if skip else links
    layer = settled(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "layer")
    found = f"{shared_folder(links.sparkSession)}/crawl-{uuid.uuid4().hex}"
    layer.write.mode("append").parquet(found)
    seen = links.sparkSession.read.schema(layer.schema)
    k = 0
    while k != depth:
        k += 1
        reached = followed.join(layer, F.col("source") == F.col("url")).select(F.col("target").alias("url")).distinct()
        after = settled(reached.join(seen.parquet(found).select("url"), "url", "left_anti").withColumn("depth", F.lit(k)), "layer")
        discard(layer)
        layer = after
        if not layer.take(1):
            break
        layer.write.mode("append").parquet(found)
    return seen.parquet(found)
