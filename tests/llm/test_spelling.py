"""Spelling variants against plain Python and SQL."""

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb

from fieldloom.llm import oracles, spelling
from fieldloom.llm.queries import op11_spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if k >= min_count and len(w) >= min_length}
    links = defaultdict(list)
    for a in n:
        links[a] = [b for b in n if near(a, b)]
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(links[w]), n[form[w]] if form[w] else None) for w in n)


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_against_plain(spark):
    """Dense words over few letters, ties, accents, capitals beyond A-Z, long words."""
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abÀèÿ×") for _ in range(r.randint(4, 7))) for _ in range(160)] + ["a" * 40, "a" * 41, "a" * 39 + "b"]
    rows = [(i if i % 9 else None, " ".join(r.choice(vocabulary).upper() if r.random() < 0.2 else r.choice(vocabulary) for _ in range(80)) + [".", "\n", "9x"][i % 3]) for i in range(60)]
    rows += [(70, "ÿÿÿÿÿ " * 40 + "ÿÿÿÿÿà " * 16 + "ÿÿÿÿÿàè " * 6), (1, None), (2, ""), (3, "... 123 日本"), rows[5], rows[5]]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    want = plain(rows)
    assert found(spelling.variants(df)) == want
    assert any(w[1] for w in want) and any(w[2] != w[1] for w in want if w[1])
    listed = spark.createDataFrame([(w[0], w[3]) for w in want], "word string, n long")
    pairs = spelling.near_pairs(listed, "01").select("a", "b").collect()  # few symbols: many pairs to verify
    assert sorted(tuple(sorted(p)) for p in pairs) == sorted((a[0], b[0]) for a in want for b in want if a[0] < b[0] and near(a[0], b[0]))


def test_each_pair_once(spark):
    words = ["abcde", "abcdf", "abcd", "abcdee", "xbcde", "bacde", "aabcde"]
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).select("a", "b").collect()
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in words for b in words if near(a, b)}


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir) / 'documents.parquet'}'")
    want = sorted(con.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({oracles.op11_spelling})").fetchall())
    assert want and found(op11_spelling(spark, sf_dir)) == want


def test_odd_tables(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(spelling.variants(odd)) == plain(rows)
    assert found(spelling.variants(none)) == []


def test_long_chain_of_forms(spark):
    chain = [("w" * i, f"{'w' * (i + 1)}") for i in range(1, 40)]
    roots = spelling.follow(spark.createDataFrame(chain, "word string, form string"))
    assert {r.word: r.root for r in roots.collect()} == {w: "w" * 40 for w, _ in chain}


def test_no_vocabulary_is_broadcast(spark):
    """The driver would hold a table that grows with the corpus; Spark's limit lets these small ones through."""
    vocabulary = spark.createDataFrame([("apple", 9), ("aple", 3), ("grape", 4)], "word string, n long")
    docs = spark.createDataFrame([(1, "apple " * 9 + "applf " * 3)], "doc_id long, text string")
    for df in (spelling.near_pairs(vocabulary), spelling.variants(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(r.word, r.form) for r in spelling.variants(docs).collect()} == {("apple", None), ("applf", "apple")}
