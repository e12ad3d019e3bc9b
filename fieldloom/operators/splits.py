"""Lines of text files that many tasks read at once, with what a split must know of those before it in its file.

A task reads its split's lines in order. What earlier splits hand on (lines, quotes, records so far) is summed to one row a
split, run over the splits of a file and joined back, so a file of any size is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.operators.storage import settled


def split_lines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8", line_sep: str | None = None) -> DataFrame:
    """file, start (of the split), place (rises within a split), value."""
    reader = spark.read.option("encoding", encoding)
    reader = reader.option("lineSep", line_sep) if line_sep else reader
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), "value")


def carried(lines: DataFrame, sums: dict[str, Column] | None = None, latest: dict[str, Column] | None = None) -> DataFrame:
    """lines with, by name, the sum over the file's earlier splits, or the last value that isn't null there (null if none).

    One row a split is written first, so that its size is known where it meets the lines: Spark broadcasts it while it is
    small, and lines then stay where they are.
    """
    sums, latest = sums or {}, latest or {}
    own = [F.sum(c.cast("long")).alias(n) for n, c in sums.items()]
    own += [F.max_by(c, F.when(c.isNotNull(), F.col("place"))).alias(n) for n, c in latest.items()]
    splits = lines.groupBy("file", "start").agg(*own)
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)  # one row a split
    runs = [F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums] + [F.last(n, ignorenulls=True).over(before).alias(n) for n in latest]
    base = settled(splits.select(F.col("file").alias("_file"), F.col("start").alias("_start"), *runs), "splits")
    return lines.join(base, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))).drop("_file", "_start")


def in_order(lines: DataFrame) -> DataFrame:
    """Lines of a split together and in their order, whatever join they went through."""
    return lines.sortWithinPartitions("file", "start", "place")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch in pieces of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = batch.column("start").to_numpy(zero_copy_only=False)
        file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero((np.diff(start) != 0) | (np.diff(file) != 0))[0] + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(i, j - i)


FRAGMENTS = "file string, start long, kind int, value string"
#: A record within one split; the lines at a split's start that go on with an earlier record; a record that the split's end cuts.
WHOLE, HEAD, TAIL = 0, 1, 2


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together to records while their quotes are uneven; a split tells by ``quotes`` whether it starts within some."""

    def out(file: str, start: int, kind: int, values: pa.Array) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64()), pa.array([kind] * n, pa.int32()), values], ["file", "start", "kind", "value"])

    now, parity, kept, kind = None, 0, [], WHOLE
    for run in _runs(batches):
        of = run.column("file")[0].as_py(), run.column("start")[0].as_py()
        if of != now:
            if now and kept:
                yield out(*now, kind, pa.array(["\n".join(kept)], pa.string()))
            now, parity, kept = of, run.column("quotes")[0].as_py() % 2, []
            kind = HEAD if parity else WHOLE
        values = run.column("value")
        after = (parity + np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False))) % 2
        before = np.concatenate([[parity], after[:-1]])
        parity = int(after[-1])
        single = (before == 0) & (after == 0)
        if single.any():
            yield out(*now, WHOLE, values.filter(pa.array(single)))
        for k in np.nonzero(~single)[0].tolist():
            if before[k] == 0:
                kept, kind = [], TAIL
            kept.append(values[k].as_py())
            if after[k] == 0:
                yield out(*now, HEAD if kind == HEAD else WHOLE, pa.array(["\n".join(kept)], pa.string()))
                kept, kind = [], WHOLE
    if now and kept:
        yield out(*now, kind, pa.array(["\n".join(kept)], pa.string()))


def quoted_records(lines: DataFrame) -> DataFrame:
    """file, value: records of delimited text, whose quoted fields may hold line breaks, from lines (file, start, place, value).

    Quotes are counted by split; each split then knows whether it starts within a quoted field. Only what a split's border
    cuts is moved: at most two fragments a split.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = settled(in_order(carried(lines, {"quotes": quotes})).select("file", "start", "value", "quotes").mapInArrow(_records, FRAGMENTS), "records")
    whole = found.filter(F.col("kind") == WHOLE).select("file", "value")
    order = W.partitionBy("file").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, 0)  # at most two rows a split
    cut = found.filter(F.col("kind") != WHOLE).withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    stitched = cut.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "value"))).alias("x"))
    return whole.unionByName(stitched.select("file", F.array_join(F.transform("x", lambda v: v["value"]), "\n").alias("value")))


def _numbered(end: str, body: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, record, inside = None, 0, False
    for run in _runs(batches):
        of = run.column("file")[0].as_py(), run.column("start")[0].as_py()
        if of != now:
            now, record, inside = of, run.column("ended")[0].as_py(), run.column("mark")[0].as_py() == "body"
        values = run.column("value")
        ends, opens = (pc.match_substring_regex(values, f"^{x}").to_numpy(zero_copy_only=False) for x in (end, body))
        n = len(values)
        mark = np.maximum.accumulate(np.where(ends | opens, np.arange(n), -1))  # the last end or body line up to each
        within = np.where(mark < 0, inside, opens[np.maximum(mark, 0)])
        before = np.concatenate([[0], np.cumsum(ends)[:-1]]) + record
        keep = ~ends & (~within | opens)
        record, inside = record + int(ends.sum()), bool(within[-1])
        yield pa.RecordBatch.from_arrays([run.column(c).filter(pa.array(keep)) for c in ("file", "start", "place", "value")] + [pa.array(before[keep], pa.int64())], ["file", "start", "place", "value", "record"])


def closed_records(lines: DataFrame, end: str = r"//\s*$", body: str = "ORIGIN") -> DataFrame:
    """file, record (from 0), lines (array): records closed by an end line (patterns of lines' starts); what follows a body line is dropped where it is read.

    Record numbers come from running counts of end lines, whether a split starts within a body from the last mark before it.
    """
    ended, opened = F.col("value").rlike(f"^{end}"), F.col("value").rlike(f"^{body}")
    known = in_order(carried(lines, {"ended": ended}, {"mark": F.when(ended, F.lit("end")).when(opened, F.lit("body"))}))
    kept = known.mapInArrow(lambda batches: _numbered(end, body, batches), "file string, start long, place long, value string, record long")
    kept = kept.filter(F.trim("value") != "")
    return kept.groupBy("file", "record").agg(F.transform(F.array_sort(F.collect_list(F.struct("start", "place", "value"))), lambda v: v["value"]).alias("lines"))
