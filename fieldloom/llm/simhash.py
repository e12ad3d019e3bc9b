"""SimHash near-duplicates by pivot distance tables.

Fingerprints are made where the texts are. Distinct fingerprints (copies share one) are compared, never documents. Two
fingerprints at most four bits apart agree on all but four of any set of bit blocks, so they meet in a group of one of
the tables of agreeing blocks; the number of blocks follows the number of fingerprints, so groups stay small. Within a
group, Hamming distances to many reference fingerprints are computed once per member, pairs whose distances to any of
them differ by more than the bound are discarded, and the rest are verified. Only the links that hold a group together
leave it. Members of groups of more than ``HOT`` fingerprints go to a finer set of tables; the finest agrees on 48 of 64
bits, so its groups are bounded by 65,536 by construction. Every link is found, whatever the sizes of groups.

Defined results: null text and text without words have fingerprint zero and are linked like any other; rows without
doc_id get the component's smallest doc_id (null if there is none); repeated rows share fingerprint and component; an
empty table gives an empty result; extra columns, whatever their names, are carried by ``deduplicate`` and ignored
elsewhere. ``deduplicate`` leaves one row of each component: the smallest doc_id (nulls last), of several texts with it
the one with the smallest hash, of rows that repeat both the one whose printed columns have the smallest hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import all_of, discard, fresh, in_small_batches, is_empty, materialise, one_of, row_pieces
from fieldloom.llm.components import components

SHINGLE = 4
SEED = 42
BOUND = 4
HOT = 1024
PIVOTS = 24
#: Numbers of blocks, coarse to fine; all but BOUND of them agree.
LADDER = (6, 7, 8, 10, 12, 16)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text as a signed number."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words))).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1 :].tolist(), strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp per row of docs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            fps = [fingerprint(t) for t in frame["text"].fillna("")]
            yield pd.DataFrame({"doc_id": frame["doc_id"].array, "text_hash": frame["text_hash"].array, "fp": np.array(fps, np.int64)})

    return in_small_batches(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(run, "doc_id long, text_hash long, fp long")


def table_masks(blocks: int, bound: int = BOUND) -> list[int]:
    """Bit masks of the tables: every choice of all but bound of the blocks; signed numbers."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    block = [sum(1 << i for i in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(block, blocks - bound)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_for(n: int) -> int:
    """The coarsest tables whose groups hold an eighth of a fingerprint on average."""
    return next((b for b in LADDER if 2 ** (64 * (b - BOUND) / b) >= 8 * n), LADDER[-1])


def pivot_distances(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to the reference fingerprints, one row each."""
    pivots = np.random.default_rng(7).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :])


def _near(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) are linked: the pivot table discards, the distance itself decides."""
    ok = np.arange(len(i))
    for p in range(table.shape[1]):
        d = table[:, p].astype(np.int16)
        ok = ok[np.abs(d[i[ok]] - d[j[ok]]) <= BOUND]
    return ok[np.bitwise_count(fps[i[ok]] ^ fps[j[ok]]) <= BOUND]


def _rooted(label: np.ndarray) -> np.ndarray:
    """Labels that name roots alone."""
    while True:
        up = label[label]
        if (up == label).all():
            return label
        label = up


def group_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the components of one group together: at most one for each member."""
    order = np.argsort(pivot_distances(fps)[:, 0], kind="stable")
    fps = fps[order]
    table = pivot_distances(fps)
    first = table[:, 0].astype(np.int16)
    upto = np.searchsorted(first, first + BOUND, side="right")
    label = np.arange(len(fps))
    start = 0
    while start < len(fps):  # rows in runs of bounded pairs
        spans = np.cumsum(upto[start:] - np.arange(start, len(fps)) - 1)
        stop = start + max(1, int(np.searchsorted(spans, 2_000_000, side="right")))
        counts = upto[start:stop] - np.arange(start, stop) - 1
        i = np.repeat(np.arange(start, stop), counts)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)
        open_ = np.nonzero(label[i] != label[j])[0]
        hit = open_[_near(fps, table, i[open_], j[open_])]
        i, j = i[hit], j[hit]
        while len(i):  # smallest label wins; labels are roots, so no link is overwritten
            a, b = label[i], label[j]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            label = _rooted(label)
            keep = label[i] != label[j]
            i, j = i[keep], j[keep]
        start = stop
    moved = np.nonzero(label != np.arange(len(fps)))[0]
    return fps[moved], fps[label[moved]]


def _links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        groups = [np.asarray(g, np.int64).view(np.uint64) for g in frame["members"]]
        sizes = np.array([len(g) for g in groups])
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        pairs = [groups[k] for k in np.nonzero(sizes == 2)[0]]
        if pairs:
            flat = np.concatenate(pairs)
            i = np.arange(0, len(flat), 2)
            hit = _near(flat, pivot_distances(flat), i, i + 1)
            a.append(flat[i[hit]])
            b.append(flat[i[hit] + 1])
        for k in np.nonzero(sizes > 2)[0]:
            x, y = group_links(groups[k])
            a.append(x)
            b.append(y)
        yield pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})


def _keys(fps: DataFrame, blocks: int) -> DataFrame:
    masks = F.array(*[F.lit(m).cast("long") for m in table_masks(blocks)])
    return fps.select("fp", F.posexplode(masks).alias("t", "mask")).select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def links(fps: DataFrame, blocks: int | None = None, hot: int = HOT) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect all that are at most BOUND bits apart."""
    fps = materialise(fps.select("fp").distinct(), "fps")
    blocks = blocks or blocks_for(fps.count())
    found = []
    while True:
        keys = _keys(fps, blocks)
        last = blocks == LADDER[-1]
        groups = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        crowded = None if last else materialise(groups.filter(F.col("n") > hot).select("t", "key"), "crowded")
        more = crowded is not None and not is_empty(crowded)
        small = keys.join(crowded, ["t", "key"], "left_anti") if more else keys
        lists = small.groupBy("t", "key").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1).select("members")
        found.append(materialise(lists.mapInPandas(_links, "a long, b long").distinct(), "links"))
        if not more:
            discard(fps, *([] if crowded is None else [crowded]))
            break
        finer = materialise(keys.join(crowded, ["t", "key"], "left_semi").select("fp").distinct(), "fps")
        discard(fps, crowded)
        fps = finer
        blocks = LADDER[min(LADDER.index(blocks) + 2, len(LADDER) - 1)] if blocks in LADDER else LADDER[-1]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text_hash, fp, component_id, root (the component's fingerprint of reference) per row of docs."""
    prints = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = materialise(components(links(distinct, **options)), "roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    # Written first: fingerprints then meet it in a plain join, whose partitions Spark can split where a component is giant.
    least = materialise(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    found = materialise(rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id", "root"), "components")
    discard(distinct, roots, least)
    return prints.join(found, F.col("fp") == F.col("_fp")).drop("_fp")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, that with the smallest doc_id; all columns as they were."""
    found = materialise(near_duplicates(docs), "found")
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    first = found.groupBy("root").agg(F.min(row).alias("first")).withColumnRenamed("root", "of")
    own = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.hash"))
    doc_id, text_hash = fresh(docs.columns, "gone_id"), fresh(docs.columns, "gone_hash")
    # Written first: rows then meet it in a plain join, whose partitions Spark can split where one component fills many rows.
    first = materialise(first, "firsts")
    gone = found.join(first, F.col("root") == F.col("of")).filter(~own)
    gone = materialise(gone.select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash)).distinct(), "gone")
    on = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash))
    rest = docs.join(gone, on, "left_anti")
    # Rows that repeat doc_id and text: one of them stays.
    many = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialise(many.select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash)), "again")
    discard(found, first)
    if is_empty(again):
        return rest
    once = one_of(rest.join(again, on, "left_semi"), [F.col("doc_id"), F.sha2("text", 256)])
    return rest.join(again, on, "left_anti").select(*all_of(docs)).unionByName(once)

