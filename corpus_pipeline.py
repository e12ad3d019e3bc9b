"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import hashlib
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import exact_dedup, language_id, mixing, sentencepiece_codec, simhash
from fieldloom.llm.common import table
from fieldloom.llm.queries import tokenizer_file
from fieldloom.operators.storage import exists, read_text, remove, shared_folder, write_text


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without letters go, and those scored below 0.5 for every language learned."""
    return language_id.keep_known(docs, language_id.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the document with the smallest doc_id."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' and decoded texts' digests of each document taken."""
    return sentencepiece_codec.round_trip(docs, tokenizer_file())


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can't express the stages that learn, link or encode.
ORACLE_SQL = None


def made_of(spark: SparkSession, path: str) -> str:
    """A digest of the documents' files and of the code of the stages."""
    code = sorted(Path(language_id.__file__).parent.glob("*.py")) + [Path(__file__)]
    told = hashlib.sha256(b"\0".join(p.read_bytes() for p in code))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    told.update(str(tuple(files.agg(F.count(F.lit(1)), F.sum(one)).first())).encode())
    return told.hexdigest()


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The last stage's rows. Stages are written below folder; one that is finished there is read instead of run again.

    What is in a folder counts only for the same documents (files, sizes, times) and the same code; otherwise every stage
    runs again. Without a folder a new one is taken, and a stage's rows are removed once the next one's are written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    kept = folder or f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    if folder is not None:
        own = made_of(spark, f"{sf_dir}/documents.parquet")
        if not exists(spark, f"{kept}/made_of") or read_text(spark, f"{kept}/made_of") != own:
            remove(spark, kept)
            write_text(spark, f"{kept}/made_of", own)
    for name, stage in STAGES[:-1]:
        at = f"{kept}/{name}"
        if folder is None or not exists(spark, f"{at}/_SUCCESS"):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(at)
        docs = spark.read.parquet(at)
        if folder is None and before:
            remove(spark, before)
        before = at
    return STAGES[-1][1](spark, docs, sf_dir)
