"""Token alignment against both libraries and sets of ends."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest

from fieldloom.llm import alignment
from fieldloom.llm.queries import op12_alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def both():
    return alignment.Vocabularies(*PATHS)


def groups(both, text):
    """(ids of the first, ids of the second) of each group, of whole texts."""
    if not text:
        return []
    a, b = both.a.encode(f" {text}", add_special_tokens=False).ids, both.b.encode(text)
    whole = f" {text}".encode()
    if b"".join(both.a_bytes[i] for i in a) != whole or b"".join(both.b_bytes[i] for i in b) != whole:
        return []
    ends = [list(accumulate(len(of[i]) for i in ids)) for ids, of in ((a, both.a_bytes), (b, both.b_bytes))]
    shared, out = set(ends[0]) & set(ends[1]), [[], []]
    for ids, at, into in zip((a, b), ends, out, strict=True):
        own = []
        for i, e in zip(ids, at, strict=True):
            own.append(i)
            if e in shared:
                into.append(own)
                own = []
    return list(zip(*out, strict=True))


def plain(both, rows):
    found = [(i, groups(both, t)) for i, t in rows]
    count = Counter((a[-1], b[-1]) for _, g in found for a, b in g)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for i, g in found:
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        links = [count[a[-1], b[-1]] for a, b in g]
        best = sum(count[a[-1], b[-1]] == highest[b[-1]] for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), best, sum(links), hashlib.sha256(written.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


ODD = [
    " ", "  a", "a  b", " a b ", "\n", "a\n b", "a \nb", "tab\tx  y", "▁x", "a ▁ b", "<s> </s> <|endoftext|> x", "it's we'll 'x don 't", "é ́x", "\x00 \x01 a", "１２３ ４",
    "a b 　c", "﻿ a", "​ a ​b", "a \u0085b", "\x1c a \x1db", "日" * 2000 + "本 " * 40, "ab" * 500 + " " + "é" * 400, "x" * 5000, "<0x41> A", "😀 😀😀 x", " ".join(f"w{i}" for i in range(4000)),
]


def test_odd_texts(spark, both):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, None), (3, ""), (0, ODD[0])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, links string").repartition(2)
    assert found(alignment.align(df, *PATHS)) == plain(both, rows)


def test_query(spark, sf_dir, docs, both):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(op12_alignment(spark, sf_dir)) == plain(both, rows)


def test_awkward_tables(spark, odd, none, both):
    assert found(alignment.align(odd, *PATHS)) == plain(both, [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    out = alignment.align(none, *PATHS)
    assert out.columns == COLUMNS and out.count() == 0


def test_forgetting_changes_nothing(both, docs, monkeypatch):
    texts = [r.text for r in docs.select("text").limit(40).collect()]
    want = [[(len(g), "".join(map(str, g))) for g in [groups(both, t)]][0] for t in texts]
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    own = alignment.Vocabularies(*PATHS)
    for at in range(0, len(texts), 3):
        sizes, _, _ = own.aligned(texts[at : at + 3])
        assert [int(x) for x in sizes[:, 2]] == [w[0] for w in want[at : at + 3]]
    assert len(own.known) < 50_000


def test_shared_ends():
    """Divided intervals have the same ends as the sets do: dense, sparse, none, all at one border."""
    r = random.Random(1)
    for case in range(400):
        n = r.randint(1, 200)
        a = sorted({n, *r.sample(range(1, n + 1), r.randint(0, n))})
        b = sorted({n, *(r.sample(range(1, n + 1), r.randint(0, n)) if case % 3 else [x for x in range(1, n) if x not in a or x > n - 4])})
        x, y = alignment.shared_ends(np.array(a), np.array(b), np.array([len(a) - 1]), np.array([len(b) - 1]))
        assert [a[i] for i in x] == [b[j] for j in y] == sorted({*a} & {*b})


def test_long_interval_without_a_shared_end():
    n = 1_000_000
    a, b = np.append(np.arange(1, 2 * n, 2), 2 * n), np.append(np.arange(2, 2 * n - 1, 2), 2 * n)
    x, y = alignment.shared_ends(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert (x.tolist(), y.tolist()) == ([len(a) - 1], [len(b) - 1])


def test_pairs_are_bounded_by_the_vocabularies(both):
    keys = {both.key(a[-1], b[-1]) for t in ODD for a, b in groups(both, t)}
    assert keys <= set(both.pairs.tolist()) and len(both.pairs) < 1_000_000
