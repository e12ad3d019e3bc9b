"""Exact de-duplication by content-defined chunk recipes, in DataFrame operations only.

A text is cut where its content says so (from 256 characters on: after a mark and a blank, a mark of a script without
blanks, or a closing sign of code), so equal texts are cut alike wherever they stand. Chunks are brought together once, with map-side combining, and compared as text: that is what
verifies an identifier. From then on a document is its ordered list of chunk identifiers, a few per cent of its size,
and two documents are equal exactly when their lists are. Long texts never travel again.

Defined results: null text counts as empty; all empty texts are one group; rows without doc_id join their group, and the
row that stays is the smallest non-null doc_id (null only if the group has no other); an empty table gives an empty
result; other columns, whatever their names, are ignored by ``verdicts`` and carried by ``deduplicate``. Rows that repeat
both doc_id and text share their verdict; ``deduplicate`` leaves one of them, the one whose printed columns have the
smallest hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import SPACE, all_of, discard, fresh, is_empty, materialise, one_of, text_or_empty

#: A cut after a mark and a blank, a full-width mark, or a sign that closes code or markup, 256 to 2,048 characters on;
#: else 2,048 characters or what is left.
CHUNK = r"(?s).{256,2046}?(?:[.,;:!?|] |[\u3001-\u3011\uFF01-\uFF1F;}>\])])|.{1,2048}"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), f"{SPACE}+", " ")


def _id(chunk: Column, hash_bits: int) -> Column:
    full = F.xxhash64(chunk)
    return full if hash_bits == 64 else F.pmod(full, F.lit(1 << hash_bits))


def verdicts(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, and text_hash (of the text as it was).

    hash_bits shortens the chunk hash; small values force collisions in tests and change no result.
    """
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), normalised().alias("norm"))
    chunked = source.withColumn("chunks", F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)))
    recipes = materialise(
        chunked.select("doc_id", "text_hash", F.sha2("norm", 256).alias("text_sha256"), F.transform("chunks", lambda c: _id(c, hash_bits)).alias("recipe")),
        "recipes",
    )
    pieces = chunked.select(F.explode("chunks").alias("chunk")).select(_id(F.col("chunk"), hash_bits).alias("id"), "chunk")
    contents = pieces.groupBy("id", "chunk").agg(F.lit(1).alias("one"))
    clashes = materialise(contents.groupBy("id").agg(F.count("one").alias("n")).filter("n > 1").select("id"), "clashes")
    key = ["recipe"]
    if not is_empty(clashes):
        recipes, key = _told_apart(docs, recipes, clashes, hash_bits), ["recipe", "ordinals"]
    groups = recipes.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    r, g = recipes.alias("r"), groups.alias("g")
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in key]
    return r.join(g, on).select("r.doc_id", "g.keep_id", "g.group_size", F.col("r.doc_id").eqNullSafe(F.col("g.keep_id")).alias("kept"), "r.text_sha256", "r.text_hash")


def _told_apart(docs: DataFrame, recipes: DataFrame, clashes: DataFrame, hash_bits: int) -> DataFrame:
    """Chunks that share a hash without being equal get an ordinal; it goes into the recipes that hold them."""
    chunk = F.posexplode(F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0))).alias("pos", "chunk")
    texts = docs.select(normalised().alias("norm")).select(F.sha2("norm", 256).alias("sha"), "norm")
    pieces = texts.select("sha", chunk).select("sha", "pos", "chunk", _id(F.col("chunk"), hash_bits).alias("id")).join(clashes, "id", "left_semi")
    contents = pieces.select("id", "chunk").distinct()
    # Equal hashes are next to each other after this sort, so a running number tells contents apart without a window per hash.
    numbered = materialise(contents.sort("id", "chunk").withColumn("ordinal", F.monotonically_increasing_id()), "ordinals")
    told = pieces.join(numbered, ["id", "chunk"]).select("sha", "pos", "ordinal").distinct()
    lists = told.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("pos", "ordinal"))).alias("ordinals"))
    return materialise(recipes.join(lists, recipes["text_sha256"] == lists["sha"], "left").drop("sha"), "recipes2")


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs without the rows whose normalised text an earlier doc_id holds; all columns as they were."""
    found = materialise(verdicts(docs), "verdicts")
    doc_id, text_hash = fresh(docs.columns, "gone_id"), fresh(docs.columns, "gone_hash")
    gone = materialise(found.filter("not kept").select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash)).distinct(), "gone")
    same = F.col("doc_id").eqNullSafe(F.col(doc_id))
    rest = docs.join(gone, same & (F.xxhash64("text") == F.col(text_hash)), "left_anti")
    many = found.filter("kept and group_size > 1").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialise(many.select(F.col("doc_id").alias(doc_id)).distinct(), "repeats")
    discard(found)
    if is_empty(again):
        return rest
    once = one_of(rest.join(again, same, "left_semi"), [F.col("doc_id"), F.sha2(normalised(), 256)])
    return rest.join(again, same, "left_anti").select(*all_of(docs)).unionByName(once)
