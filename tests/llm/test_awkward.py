"""Tables whose columns have the names that the operators use for their own, rows without doc_id, repeated rows."""

import pytest
from pyspark.sql import functions as F

from fieldloom.llm import common, exact_dedup, language_id, line_dedup, media, mixing, pii, quality, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")
#: Helper names of the operators, of this version and of earlier ones.
CLASHES = (
    "mix_source", "mix_rate", "mix_copy", "seed", "rate", "gone_id", "gone_hash", "gone_lines", "_gone_id", "_gone_hash", "_dedup_text_hash", "_norm_hash", "lost",
    "PII_text", "pii_email", "pii_m_email", "pii_z_card", "text_hash", "fp", "root", "component_id", "first", "of", "k0", "row", "place", "placed", "n", "media", "media_type_", "node", "_id", "_hash",
)


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.select("doc_id", "text", "lang", "source", "n_chars").withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})


def test_fresh():
    assert common.fresh(["a", "Gone_ID"], "gone_id") == "gone_id_" and common.fresh([], "x") == "x"


@pytest.mark.parametrize("step", [exact_dedup.deduplicate, simhash.deduplicate, line_dedup.deduplicate, mixing.mix, pii.redact, lambda d: quality.select_good(d, None), lambda d: language_id.keep_known(d, language_id.fit(d))])
def test_clashing_names(clashing, odd, step):
    out = step(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, step(odd).select("doc_id", "text").collect()))
    assert all(out.filter(F.col(c) != i).isEmpty() for i, c in list(enumerate(CLASHES))[:3])


def test_stages_on_clashing_names(spark, clashing, sf_dir):
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == clashing.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_media_columns_on_clashing_names(spark):
    df = spark.createDataFrame([(b"x", "t", 1)], "content binary, declared string, media int")
    assert media.columns(df).columns == ["content", "declared", "media", "media_type", "type_corrected", "media_detail", "embedded"]


WORDS = "the old red fox runs over a long green field near some quiet river bank today"


def test_components_without_doc_id(spark):
    """Of rows without doc_id that are linked one stays; of rows that repeat doc_id and text one stays, the same in each run."""
    rows = [(None, WORDS, 1), (None, WORDS, 2), (None, WORDS.upper(), 3), (5, "a b", 1), (5, "a b", 2), (6, "a b", 3), (7, "c", 1), (7, "d", 1), (None, "lone", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    runs = [sorted(map(str, simhash.deduplicate(df.repartition(n)).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]
    out = simhash.deduplicate(df).collect()
    near = [r for r in out if r.doc_id is None and r.text != "lone"]
    assert len(near) == 1 and [r.doc_id for r in out if r.text == "a b"] == [5] and len(out) == 5


def test_exact_copies_that_repeat_doc_id(spark):
    df = spark.createDataFrame([(1, "a  b", 1), (1, "a b", 2), (1, "a b", 3), (2, "a b", 4), (None, "x", 5), (None, "x", 6)], "doc_id long, text string, extra int")
    runs = [sorted(map(str, exact_dedup.deduplicate(df.repartition(n)).collect())) for n in (1, 4)]
    assert runs[0] == runs[1] and len(runs[0]) == 2


def test_texts_without_blanks_are_cut_by_content():
    """A shift in front of a text moves no cut far behind it, in scripts without blanks and in code."""
    import re

    for unit in ("日本語の文章が{1}ここにあります{0}番目の文です。", "if(x{0}){{y={1}f(x,y)}}"):
        text = "".join(unit.format(i, "字" * (i * i * 7919 % 61)) for i in range(3000))
        cut = lambda t: set(re.findall(exact_dedup.CHUNK, t)[5:-1])
        assert len(cut(text) & cut("xyz" + text)) > 0.9 * len(cut(text))


def test_pipeline_resumes(spark, sf_dir, tmp_path, monkeypatch):
    wanted = sorted(map(str, corpus_pipeline.run(spark, sf_dir, str(tmp_path)).collect()))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda *_: 1 / 0) for n, _ in corpus_pipeline.STAGES[:-1]] + corpus_pipeline.STAGES[-1:])
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir, str(tmp_path)).collect())) == wanted


def test_pipeline_starts_again_for_other_documents(spark, sf_dir, tmp_path):
    """A folder's stages count for the documents that they were made of."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, keep in ((1, "doc_id % 2 = 0"), (2, "true")):
        docs.filter(keep).write.mode("overwrite").parquet(f"{tmp_path}/in/documents.parquet")
        ids = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/in", f"{tmp_path}/kept").collect()}
        assert any(i % 2 for i in ids) == (n == 2)
