import re
from collections import defaultdict

import pytest

from fieldloom.llm.mixing import mix, plan_mix


def targets(sizes):
    """Water-filling by hand."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(df, near):
    rows = plan_mix(df).collect()
    assert len(rows) == df.count()
    texts = defaultdict(list)
    for r in df.collect():
        texts[r.doc_id, r.source].append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size in texts[r.doc_id, r.source] and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    wanted = targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
    for s, w in wanted.items():
        assert abs(taken[s] - w) <= near * max(w, 1)


def test_plan(docs, odd, none):
    check(docs, 0.35)
    rows = plan_mix(odd).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert plan_mix(none).count() == 0


def test_larger_sources_come_near(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 0.05)


def test_reruns_agree(docs):
    assert sorted(map(tuple, plan_mix(docs).collect())) == sorted(map(tuple, plan_mix(docs.repartition(7)).collect()))


def test_mix_is_the_plan(docs, odd, none):
    out = mix(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in plan_mix(docs).collect() if r.copies}
    assert mix(odd).columns == odd.columns
    assert mix(none).count() == 0
