import os

os.environ.setdefault("OMP_NUM_THREADS", "1")  # as in Spark's Python workers; small products are no faster on more threads

import pytest  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, size string, fp string, rate double, text_hash string, kept string"
#: Long, short, equal, nearly equal, blank and missing texts; columns whose names the operators use themselves.
LONG = " ".join(f"wort{i % 97}{'ä' * (i % 3)} next{i}." for i in range(9000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line of this text has also more than eight words in it.",
    "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line of this text has also more than eight words in it.",
    "The  quick\tbrown fox jumps over the lazy dog near the river bank today.\nSecond line of this text has also more than eight words in it.",
    "The quick brown cat jumps over the lazy dog near the river bank today.\nSecond line of this text has more than eight words in it.",
    "", None, " \n\t ", "a", "a b", "é ﬁ 日本 😀 ​ ▁x <s>", "1234 5678 !!! ...", LONG, LONG + " end", "x" * 30000,
    "mail me: a.b+c@d-e.example.org or +1 (017) 555-7713, card 4111 1111 1111 1111, host 10.0.0.255, iban DE89 3704 0044 0532 0130 00",
]


@pytest.fixture(scope="session")
def odd(spark):
    """A table with every awkward case, in which rows repeat and doc_id may be null."""
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s0"][i % 4], len(t or ""), 1, "x", "y", 0.5, "z", "k") for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[5], (None, TEXTS[0], None, None, None, None, None, None, None, None, None), (None, None, "en", "s1", 0, 1, "x", "y", 0.5, "z", "k")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
