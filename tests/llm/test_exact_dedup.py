import hashlib
import re

from fieldloom.llm.exact_dedup import CHUNK, deduplicate, verdicts
from pyspark.sql import functions as F


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r.text), []).append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[norm(r.text)]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256(norm(r.text).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_verdicts(docs, odd, none):
    for df in (docs, odd):
        assert found(verdicts(df)) == brute(df.collect())
    assert verdicts(none).count() == 0


def test_clashing_chunk_hashes_change_nothing(docs, odd):
    """With an 8-bit hash nearly every chunk clashes with another one."""
    for df in (docs, odd):
        assert found(verdicts(df, hash_bits=8)) == brute(df.collect())


def test_chunks_are_the_text(odd):
    texts = odd.select(F.coalesce("text", F.lit("")).alias("t")).select("t", F.array_join(F.regexp_extract_all("t", F.lit(CHUNK), F.lit(0)), "").alias("c"))
    assert texts.filter("t <> c").count() == 0


def test_deduplicate(docs, odd, none):
    out = deduplicate(odd)
    assert out.columns == odd.columns
    texts = [norm(r.text) for r in out.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {norm(r.text) for r in odd.collect()}
    kept = sorted(r.doc_id for r in deduplicate(docs).collect())
    assert kept == sorted(x[0] for x in brute(docs.collect()) if x[3])
    assert deduplicate(none).count() == 0
