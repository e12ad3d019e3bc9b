"""The numbered queries: each applies its operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.common import table


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.quality import fit, grade

    docs = table(spark, sf_dir, "documents")
    return grade(docs, fit(docs, table(spark, sf_dir, "labels")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.sentencepiece_codec import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file())


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.language_id import fit, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.media import text_media

    return text_media(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.pii import digest

    return digest(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.mixing import plan_mix

    return plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.line_dedup import verdicts

    return verdicts(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"), shards=16)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.exact_dedup import verdicts

    return verdicts(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from fieldloom.llm.alignment import align

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), tokenizer_file())


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.html_text import extract, fit

    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from fieldloom.llm import oracles

    return {name: sql for name, sql in vars(oracles).items() if name.startswith("op") and name[2].isdigit()}
