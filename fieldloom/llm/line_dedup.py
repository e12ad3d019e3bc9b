"""Near-duplicate lines by a deletion-neighbourhood join.

Lines are compared as rows of words (parted by ASCII white space). Equal lines are found first, by a 128-bit hash of the
words; of each, the first (smallest doc_id, then line number) stands for all. The edit bound is one unit put in, left out
or replaced, where a unit is at most an eighth of the longer line: a word if that has at least ``LONG`` words, a character
if both lines have fewer words and the longer one at least ``LONG`` characters. A line's variants within the bound are the
line itself and the line without each one of its units, emitted as hashed keys; two lines are within the bound exactly
when they share a key of one of two kinds: the same variant left by deleting at the same place (a unit was replaced), or
one line being a variant of the other (a unit was put in). Members of a key are tied to its earliest line or to the line
that is the variant itself, never to each other, so work is linear in the variants. Every tie is verified on the lines;
the later line of a verified tie goes. What it names as kept is the line that its ties end at, one that stays.

Only lines that can have a partner emit variants: an edit leaves the front or the back half of a line as it was, so a
line whose halves occur nowhere else has none. That drops nothing and keeps the deletion keys to a few per cent.

Defined results: null text has one line without words; lines without words are kept and never compared; repeated rows of
one doc_id share their verdict; different texts without doc_id or of one doc_id lose their own lines alone; rows without
doc_id come last in the order; an empty table gives an empty result; extra columns, whatever their names, are carried by
``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import all_of, discard, fresh, in_small_batches, is_empty, materialise, row_pieces, with_global_rank

LONG = 8
_LINE = "doc_id long, text_hash long, line_no int, n_words int, h1 long, h2 long, halves array<long>"
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _halves(units: list[bytes] | str, sizes: tuple[int, ...] | None = None) -> list[int]:
    """Hashes of the front and back half, for a partner that is as long and for one that is a unit shorter."""
    out, text = [], isinstance(units, str)
    for size in sizes or (len(units), len(units) - 1):
        front = size // 2
        for side, part in enumerate((units[:front], units[len(units) - (size - front) :])):
            out.append(_signed(xxhash.xxh64_intdigest(part if text else b" ".join(part), 4 * size + 2 * text + side)))
    return out


def _half_keys(words: list[bytes], joined: bytes) -> list[int] | None:
    """Halves of a line in words, in characters, or in both where it may be the shorter line of a pair in words."""
    n = len(words)
    if n >= LONG:
        return _halves(words)
    out = _halves(words, (n,)) if n == LONG - 1 else []
    text = joined.decode()
    if len(text) >= LONG - 1:
        out += _halves(text, None if len(text) >= LONG else (len(text),))
    return out or None


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, n_words, h1, h2, halves: one row per line of docs; halves where it can have a partner."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            rows = []
            for doc_id, text_hash, text in zip(frame["doc_id"], frame["text_hash"], frame["text"].fillna(""), strict=True):
                for no, line in enumerate(text.encode().split(b"\n")):
                    words = line.split()
                    joined = b" ".join(words)
                    h = xxhash.xxh128_intdigest(joined)
                    rows.append((doc_id, text_hash, no, len(words), _signed(h >> 64), _signed(h & (1 << 64) - 1), _half_keys(words, joined)))
            out = pd.DataFrame(rows, columns=["doc_id", "text_hash", "line_no", "n_words", "h1", "h2", "halves"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return in_small_batches(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(run, _LINE)


def variants(units: list[bytes] | str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of a line and hashes of the line without its first, second, ... unit, in one pass over the units."""
    n = len(units)
    if isinstance(units, str):
        hashed = _mixed(np.frombuffer(units.encode("utf-32-le"), "<u4").astype(np.uint64), 0xC4A5)
    else:
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in units], np.uint64)
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * np.cumprod(powers))])
    return sums[-1], sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_BACK)


def _mixed(x: np.ndarray, with_: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.asarray(with_).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def within_one(a: list[bytes] | str, b: list[bytes] | str) -> bool:
    """Whether one unit put in, left out or replaced turns a into b (or nothing at all)."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def near(a: str, b: str) -> bool:
    """Whether two lines, their words joined by blanks, are within the bound."""
    x, y = a.encode().split(), b.encode().split()
    if max(len(x), len(y)) >= LONG:
        return within_one(x, y)
    return max(len(a), len(b)) >= LONG and within_one(a, b)


def _survivors(docs: DataFrame, first: DataFrame) -> DataFrame:
    """h1, h2, doc_id, line_no, line of the distinct lines that share a half with another, and place: their order."""
    long = first.filter(F.col("halves").isNotNull())
    halves = materialise(long.select("h1", "h2", "doc_id", "text_hash", "line_no", F.explode(F.array_distinct("halves")).alias("half")), "halves")
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("half")
    alive = halves.join(shared, "half", "left_semi").select("h1", "h2", "doc_id", "text_hash", "line_no").distinct()
    by_doc = materialise(alive.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("line_no", "h1", "h2")).alias("alive")), "alive").toDF("_id", "_hash", "alive")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            rows = []
            for doc_id, text, alive in zip(frame["doc_id"], frame["text"].fillna(""), frame["alive"], strict=True):
                split = text.encode().split(b"\n")
                for x in alive:
                    if x["line_no"] < len(split):
                        joined = b" ".join(split[x["line_no"]].split())
                        if _signed(xxhash.xxh128_intdigest(joined) >> 64) == x["h1"]:
                            rows.append((x["h1"], x["h2"], doc_id, x["line_no"], joined.decode()))
            out = pd.DataFrame(rows, columns=["h1", "h2", "doc_id", "line_no", "line"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    discard(halves)
    read = docs.select("doc_id", "text").join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))).drop("_id", "_hash")
    found = read.mapInPandas(run, "h1 long, h2 long, doc_id long, line_no int, line string").dropDuplicates(["h1", "h2"])
    return materialise(with_global_rank(found, [F.col("doc_id").asc_nulls_last(), F.col("line_no")], "placed", "place"), "survivors")


def _unit_rows(line: str) -> list[tuple[list[bytes] | str, bool]]:
    """A line as words, as characters, or as both, and whether it can lose one of them."""
    words = line.encode().split()
    if len(words) >= LONG:
        return [(words, True)]
    as_words = [(words, False)] if len(words) == LONG - 1 else []
    return as_words + ([(line, len(line) >= LONG)] if len(line) >= LONG - 1 else [])


def _variant_keys(survivors: DataFrame) -> DataFrame:
    """key, role (0 replaced at a place, 1 the line itself, 2 a unit left out), place."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames, 400_000, "line"):
            keys, roles, at = [], [], []
            for place, line in zip(frame["place"], frame["line"], strict=True):
                for units, within in _unit_rows(line):
                    whole, without = variants(units)
                    n = len(without) if within else 0
                    keys += [_mixed(without[:n], np.arange(1, n + 1)), without[:n], np.array([whole])]
                    roles += [np.zeros(n, np.int8), np.full(n, 2, np.int8), np.ones(1, np.int8)]
                    at.append(np.full(2 * n + 1, place, np.int64))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "role": np.concatenate(roles), "place": np.concatenate(at)})

    return survivors.select("place", "line").mapInPandas(run, "key long, role byte, place long")


def _order():
    return F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("doc_id"), F.col("line_no").alias("line_no"))


def _ends(ties: DataFrame) -> DataFrame:
    """place, other: ties followed to a line without an earlier one. Each round doubles the steps."""
    cur = materialise(ties, "ends")
    while True:
        after = cur.select(F.col("place").alias("at"), F.col("other").alias("then"))
        moved = materialise(cur.join(after, F.col("other") == F.col("at"), "left").select("place", F.coalesce("then", "other").alias("other"), F.col("then").isNotNull().alias("moved")), "ends")
        discard(cur)
        cur = moved
        if is_empty(cur.filter("moved")):
            return cur.select("place", "other")


def near_ties(docs: DataFrame, first: DataFrame) -> DataFrame:
    """h1, h2, near_doc_id, near_line_no: each distinct line with an earlier one within the bound, and the line that stays for it."""
    survivors = _survivors(docs, first)
    keys = materialise(_variant_keys(survivors), "variants")
    replaced = keys.filter("role = 0").select("key", "place")
    firsts = replaced.groupBy("key").agg(F.min("place").alias("other"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "other")
    # Written first: what replaces a word then meets it in a plain join, whose partitions Spark can split where one key is very common.
    firsts = materialise(firsts, "firsts")
    whole = keys.filter("role = 1").select("key", F.col("place").alias("other"))
    ties = replaced.join(firsts, "key").unionByName(keys.filter("role = 2").select("key", "place").join(whole, "key"))
    ties = ties.filter("place <> other").select(F.greatest("place", "other").alias("place"), F.least("place", "other").alias("other")).distinct()
    lines_ = survivors.select("place", F.col("line").alias("line_a"))
    others = survivors.select(F.col("place").alias("other"), F.col("line").alias("line_b"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ok = [near(a, b) for a, b in zip(frame["line_a"], frame["line_b"], strict=True)]
            yield frame.loc[ok, ["place", "other"]]

    sound = ties.join(lines_, "place").join(others, "other").select("place", "other", "line_a", "line_b").mapInPandas(run, "place long, other long")
    ends = _ends(sound.groupBy("place").agg(F.min("other").alias("other")))
    discard(keys, firsts)
    where = survivors.select(F.col("place").alias("other"), F.col("doc_id").alias("near_doc_id"), F.col("line_no").alias("near_line_no"))
    found = ends.join(survivors.select("place", "h1", "h2"), "place").join(where, "other")
    found = materialise(found.select("h1", "h2", "near_doc_id", "near_line_no"), "near")
    discard(survivors)
    return found


def _verdicts(docs: DataFrame) -> DataFrame:
    """The columns of verdicts, and text_hash: doc_id and text_hash tell whose line it is where rows have no doc_id or share one."""
    found = materialise(lines(docs), "lines")
    worded = found.filter("n_words > 0")
    first = worded.groupBy("h1", "h2").agg(F.min(F.struct(_order().alias("o"), "text_hash", "halves")).alias("f"))
    first = materialise(first.select("h1", "h2", F.col("f.o.doc_id").alias("doc_id"), F.col("f.o.line_no").alias("line_no"), F.col("f.text_hash").alias("text_hash"), F.col("f.halves").alias("halves")), "first")
    ties = near_ties(docs, first)
    keep = first.select("h1", "h2", F.col("doc_id").alias("first_doc"), F.col("line_no").alias("first_line")).join(ties, ["h1", "h2"], "left")
    told = materialise(keep, "told")
    discard(first, ties)
    told = told.withColumnRenamed("h1", "k1").withColumnRenamed("h2", "k2")
    at_first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("line_no") == F.col("first_line"))
    near_known = F.col("near_line_no").isNotNull()
    out = found.join(told, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n_words") > 0), "left")
    reason = F.when(F.col("n_words") == 0, None).when(~at_first, F.lit("same")).when(near_known, F.lit("near"))
    out = out.withColumn("reason", reason)
    return out.select(
        "doc_id", "text_hash", "line_no", "n_words", F.col("reason").isNull().alias("kept"), "reason",
        *[F.when(F.col("reason").isNull(), F.col(own)).when(near_known, F.col(end)).otherwise(F.col(head)).alias(f"keep_{own}")
          for own, end, head in (("doc_id", "near_doc_id", "first_doc"), ("line_no", "near_line_no", "first_line"))],
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """Per line: doc_id, line_no, n_words, kept, reason (null, 'same', 'near'), and the line that stays for it: keep_doc_id, keep_line_no."""
    return _verdicts(docs).drop("text_hash")


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with the lines that go cut out of their texts; documents that lose no line are as they were."""
    doc_id, text_hash, lost = (fresh(docs.columns, n) for n in ("gone_id", "gone_hash", "gone_lines"))
    gone = _verdicts(docs).filter("not kept").groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("lost")).toDF(doc_id, text_hash, lost)
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash)), "left")
    rest = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(lost, i))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return joined.select(*[text.alias(n) if n == "text" else c for n, c in zip(docs.columns, all_of(docs), strict=True)])
