"""The pipeline against what its stages must do, and the numbered queries' SQL."""

from pathlib import Path

import duckdb
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from fieldloom.llm import mixing, queries, simhash  # noqa: E402

from test_mixing import targets  # noqa: E402


def test_stages(spark, docs, sf_dir):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns, name
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(rows) == kept.count() and {r.doc_id for r in rows} == ids


def test_decisions_take_effect(spark, odd, sf_dir):
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language"](spark, odd, sf_dir)
    assert {r.doc_id for r in known.collect()} & {4, 5, 6, 10} == set()
    exact = stage["exact_dedup"](spark, known, sf_dir)
    assert exact.count() == known.selectExpr(r"regexp_replace(text, '[\\x20\\x09-\\x0D]+', ' ') t").distinct().count()
    near = stage["near_dedup"](spark, exact, sf_dir)
    found = simhash.near_duplicates(exact).filter("doc_id <=> component_id").count()
    assert near.count() == found
    mixed = stage["mixing"](spark, near, sf_dir)
    assert mixed.count() == mixing.plan_mix(near).agg({"copies": "sum"}).first()[0]
    assert stage["sentencepiece"](spark, mixed, sf_dir).count() == mixed.count()


def by_hand(docs, model):
    """The five decisions in plain Python: {doc_id: (copies, n_tokens, ids_sha256, decoded_sha256)} of what stays."""
    import hashlib
    import re
    from collections import defaultdict

    import numpy as np
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file())
    rows = {r.doc_id: r for r in docs if model.predict(r.text or "")[1] >= 0.5 and re.search(r"[^\W\d_]", r.text or "")}
    first = {}
    for i in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i].text or ""), i)
    ids = sorted(first.values())
    fps = np.array([simhash.fingerprint(rows[i].text or "") for i in ids], np.int64).view(np.uint64)
    near, left = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, set(range(len(ids)))
    kept = []
    while left:  # ids are sorted, so the first of a component is its smallest
        seen, todo = set(), {min(left)}
        kept.append(ids[min(left)])
        while todo:
            seen |= todo
            todo = {int(j) for i in todo for j in np.flatnonzero(near[i])} - seen
        left -= seen
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", rows[i].text or "")) for i in kept}
    sizes = defaultdict(int)
    for i in kept:
        sizes[rows[i].source] += words[i]
    wanted = targets(dict(sizes))
    lucky = lambda i, k: int(hashlib.md5(f"{k // 4}:{i}".encode()).hexdigest()[8 * (k % 4) : 8 * (k % 4) + 8], 16) / 2**32
    out = {}
    for source in sizes:
        rate = wanted[source] / sizes[source] if sizes[source] else 0.0
        own = [i for i in kept if rows[i].source == source]
        copies = lambda i, k: int(rate) + (lucky(i, k) < rate - int(rate))  # noqa: B023, E731
        seed = min(range(16), key=lambda k: (abs(sum(words[i] * copies(i, k) for i in own) - wanted[source]), k))  # noqa: B023
        for i in own:
            tokens = library.encode(rows[i].text or "", add_eos=True)
            sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
            out[i] = (copies(i, seed), len(tokens), sha(" ".join(map(str, tokens))), sha(library.decode(tokens)))
    return {i: x for i, x in out.items() if x[0]}


def test_run_by_hand(spark, docs, tmp_path):
    """run()'s whole rows against plain Python, on documents with exact and near copies, rejects and an uneven source."""
    rows = docs.orderBy("doc_id").limit(150).collect()
    long = [r for r in rows if r.text and len(r.text.split()) > 120]
    more = [(1000 + k, "  ".join(r.text.split(" ")), r.lang, r.source, 0) for k, r in enumerate(long[:20])]
    more += [(2000 + k, r.text + " end", r.lang, "src0", 0) for k, r in enumerate(long[5:30])] + [(3000, None, "en", None, 0), (3001, "12 34 !", "en", None, 0), (3002, "いろはにほへと ちりぬるを", "en", None, 0)]
    spark.createDataFrame([tuple(r) for r in rows] + more, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    made = spark.read.parquet(str(tmp_path / "documents.parquet"))
    wanted = by_hand(made.collect(), corpus_pipeline.language_id.fit(made))
    found = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        x = found.setdefault(r.doc_id, [0, r.n_tokens, r.ids_sha256, r.decoded_sha256])
        x[0] += 1
    assert {i: tuple(x) for i, x in found.items()} == wanted


def test_empty(spark, none, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    wanted = con.sql(queries.oracle_sql()[name])
    rows = queries.queries()[name](spark, sf_dir).select(*wanted.columns).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, wanted.fetchall()))


