"""Spelling variants of a corpus's words, by a reduced alphabet.

Each letter is hashed to one of a few symbols, so that many words share a reduced word. Two words one edit apart have
reduced words that are equal or one edit apart. Reduced words therefore emit their one-edit neighbourhood as hashed keys,
the reduced vocabulary is joined to those keys, and what meets is verified on the words themselves. Of the neighbourhood's
mirrored halves (insertions and deletions, substitutions up and down) one is emitted: the other word emits the other. The
alphabet's size decides the work only: fewer symbols, fewer keys and more pairs to verify. Every near pair is found.

What is joined are distinct words, never documents, so a common word is one row; a word has at most a bounded number of
near words, since its length and the alphabet bound its neighbourhood. Both sides of every join grow with the corpus, and
their compressed files look small enough to broadcast long after their rows are not: each join is told to merge, so that
the driver gets none of them.

Defined results: null and empty texts have no words; a row without doc_id counts with an empty id in front of the colon;
repeated rows count each time; the ties that remain go to the word that is smallest in code-point order; an empty table
gives an empty result; columns other than doc_id and text are ignored, so names can't clash.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import discard, materialise

#: Letters of a run, once A-Z are lower-cased.
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the reduced alphabet.
SYMBOLS = "01234567"
#: A run whose hash this number divides loses one code point.
MISSPELT = 97
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the corpus's words, with the code point gone that the run's hash names; counted on the map side first."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[a-z{chr(0xC0)}-{chr(0xFF)}]+"), F.lit(0))
    occurred = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    hashed = occurred.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    word = F.when(F.col("h") % MISSPELT == 0, cut).otherwise(F.col("run"))
    found = hashed.select(word.alias("word")).filter(F.char_length("word") >= min_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def merging(df: DataFrame) -> DataFrame:
    """df, whose joins merge sorted rows whatever its files' size says."""
    return df.hint("merge")


def reduced(word: Column, symbols: str = SYMBOLS) -> Column:
    """The word in the reduced alphabet: each letter's hash picks its symbol."""
    return F.translate(word, LETTERS, "".join(symbols[zlib.crc32(c.encode()) % len(symbols)] for c in LETTERS))


def neighbourhood(r: Column, symbols: str = SYMBOLS) -> Column:
    """Distinct strings one deletion or one substitution by a greater symbol away."""
    places = F.sequence(F.lit(1), F.char_length(r))
    before, after = (lambda i: r.substr(F.lit(1), i - 1)), (lambda i: r.substr(i + 1, F.char_length(r)))
    greater = lambda i: F.filter(F.array(*map(F.lit, symbols)), lambda s: s > r.substr(i, F.lit(1)))
    deleted = F.transform(places, lambda i: F.concat(before(i), after(i)))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(greater(i), lambda s: F.concat(before(i), s, after(i)))))
    return F.array_distinct(F.concat(deleted, replaced))


def near_pairs(vocabulary: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """a, n_a, b, n_b: every pair of distinct words (column word, with n) that is one edit apart, in one order of the two."""
    coded = materialise(vocabulary.select("word", "n", reduced(F.col("word"), symbols).alias("r")), "coded")
    forms = merging(coded.select("r").distinct())
    keys = forms.select("r", F.explode(F.transform(neighbourhood(F.col("r"), symbols), lambda v: F.xxhash64(v))).alias("key"))
    met = keys.join(forms.select(F.col("r").alias("s"), F.xxhash64("r").alias("key")), "key").select("r", "s")
    left = merging(coded.select("r", F.col("word").alias("a"), F.col("n").alias("n_a")))
    right = merging(coded.select(F.col("r").alias("s"), F.col("word").alias("b"), F.col("n").alias("n_b")))
    other = met.join(left, "r").join(right, "s")
    same = left.join(right, F.col("r") == F.col("s")).filter("a < b")
    pairs = other.select("a", "n_a", "b", "n_b").unionByName(same.select("a", "n_a", "b", "n_b"))
    return pairs.filter(F.levenshtein("a", "b", 1) == 1)


def follow(forms: DataFrame) -> DataFrame:
    """word, root: where the steps word -> form end; pointers double each round, which is written to the shared folder."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = merging(now.select(F.col("word").alias("root"), F.col("root").alias("further")))
        after = materialise(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(now)
        now = after
        if not now.filter("moved").take(1):
            return now.select("word", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: float = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n per word of the corpus.

    form is the near word of largest n where that is at least ratio times the word's own; root is where forms end.
    """
    vocabulary = materialise(words(docs, min_length, min_count), "words")
    pairs = near_pairs(vocabulary)
    both = F.inline(F.array(F.struct(F.col("a").alias("word"), F.col("n_b").alias("m"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("n_a").alias("m"), F.col("a").alias("near"))))
    best = pairs.select(both).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    known = vocabulary.join(merging(best), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.m")).alias("m"))
    taken = F.col("m") >= ratio * F.col("n")
    known = materialise(known.select("word", "n", "n_near", F.when(taken, F.col("near")).alias("form"), F.when(taken, F.col("m")).alias("form_n")), "forms")
    roots = follow(known.filter("form IS NOT NULL"))
    return known.join(merging(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
