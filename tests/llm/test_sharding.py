import zlib
from collections import defaultdict

import pytest

from fieldloom.llm import sharding
from fieldloom.llm.sharding import shard


def check(df, n, spread):
    rows = shard(df, shards=n).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())
    texts = defaultdict(set)
    for r in df.collect():
        texts[r.doc_id].add((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())))
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) in texts[r.doc_id] and r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(sizes.values()) / n, max(r.size for r in rows)
    assert all(abs(sizes[s] - mean) <= spread * mean + largest for s in range(n))
    return rows


def test_bytes_are_near_equal(docs):
    check(docs, 16, 0.02)
    check(docs, 5, 0.02)


def test_equal_texts_stay_together(docs):
    by_text = defaultdict(set)
    for r in shard(docs, shards=16).collect():
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_a_text_that_outweighs_shards_is_cut(spark):
    rows = [(i, "same text here", "en", "s") for i in range(3000)] + [(i, f"text {i}", "en", "s") for i in range(3000, 4000)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 16, 0.1)


def test_equal_texts_are_cut_only_where_balance_asks_for_it(spark):
    """Copies that weigh a fifth of a shard stay whole where other texts can make up for them."""
    rows = [(i, f"copy {i // 30} " + "x" * 100, "en", "s") for i in range(600)] + [(i, f"text {i} " + "y" * (i * 37 % 90), "en", f"s{i % 5}") for i in range(600, 6000)]
    out = check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 4, 0.05)
    by_text = defaultdict(set)
    for r in out:
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_many_shards(spark):
    """Nodes and cuts are tables, so the number of shards changes no plan."""
    rows = [(i, f"text {i} " + "y" * (i * i % 97), f"l{i % 3}", f"s{i % 7}") for i in range(8000)]
    sizes = defaultdict(int)
    for r in shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), shards=2000).collect():
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 2000
    assert len(sizes) == 2000 and max(sizes.values()) <= mean + 4 * 110


def test_odd_cases(odd, none):
    rows = shard(odd, shards=16).collect()
    assert len(rows) == odd.count()
    assert shard(none, shards=16).count() == 0 and shard(none, target_bytes=100).columns[0] == "doc_id"


def test_target_bytes(docs):
    rows = shard(docs, target_bytes=100_000).collect()
    assert max(r.shard for r in rows) == -(-sum(r.size for r in rows) // 100_000) - 1


def plain_tree(rows, leaves, leaf, node=0):
    """{row: shard}: the tree cut by cut. rows: (row, size, keys); a cut goes at the text where half the bytes are met, within it only if it must."""
    if leaves == 1 or not rows:
        return {r: node for r, _, _ in rows}
    half = leaves // 2
    widths = [max(k[d] >> 44 for _, _, k in rows) - min(k[d] >> 44 for _, _, k in rows) for d in range(3)]
    dim = widths.index(max(widths))
    need = sum(s for _, s, _ in rows) * half / leaves

    def met(weights, need):
        upto = 0
        for place in sorted(weights):
            upto += weights[place]
            if upto >= need:
                break
        return place, upto - need, need - (upto - weights[place])

    def summed(shift, only=None):
        out = defaultdict(int)
        for _, s, k in rows:
            if only is None or k[dim] >> 12 == only:
                out[k[dim] >> shift] += s
        return out

    text, over, under = met(summed(12), need)
    if min(abs(over), abs(under)) <= 0.02 * leaf * min(half, leaves - half):
        cut = ((text + 1) << 12) - 1 if abs(over) <= abs(under) else (text << 12) - 1
    else:
        place, over, under = met(summed(0, text), under)
        cut = place if abs(over) <= abs(under) else place - 1
    sides = [r for r in rows if r[2][dim] <= cut], [r for r in rows if r[2][dim] > cut]
    return plain_tree(sides[0], half, leaf, node) | plain_tree(sides[1], leaves - half, leaf, node + half)


@pytest.mark.parametrize("shards", [2, 7, 16])
def test_against_a_plain_tree(spark, docs, shards):
    copies = [(100_000 + i, "copy " * 50, "en", f"s{i % 4}") for i in range(300)]
    df = docs.select("doc_id", "text", "lang", "source").unionByName(spark.createDataFrame(copies, "doc_id long, text string, lang string, source string"))
    keys = {r.doc_id: (r.size, [r[d] for d in sharding.DIMENSIONS]) for r in sharding.metadata(df).collect()}
    leaf = sum(s for s, _ in keys.values()) / shards
    want = plain_tree([(i, s, k) for i, (s, k) in keys.items()], shards, leaf)
    assert {r.doc_id: r.shard for r in shard(df, shards=shards).collect()} == want
