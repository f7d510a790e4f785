"""From raw documents to shards: language, near duplicates, benchmark leaks, source mixture, sharding.

``STAGES`` are applied in order; each gets what the one before kept, written as Parquet and read again, and all but the
last return the columns of ``documents``. All texts stay whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, mixing, sharding, simhash
from tidemark.llm.common import free_name, ship, table
from tidemark.session import shared_dir

#: Normal texts score 0.38 and more; below this a text resembles no known language.
LEAST_LIKE_A_LANGUAGE = 0.2
REPETITION = 2.0
SHARDS = 16


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents with letters whose profile resembles a language of the labelled ones."""
    ship(spark)
    profiles = langid.learn(docs)
    lang, score = free_name(docs, "lang_found"), free_name(docs, "lang_score")
    found = langid.with_language(docs, profiles, lang=lang, score=score)
    keep = (F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_LIKE_A_LANGUAGE)
    return found.where(keep).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    ship(spark)
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents that cover no benchmark item."""
    ship(spark)
    return decontam.without_contaminated(docs, table(spark, folder, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeats documents so that sources approach equal weights; every document stays, none more than twice over."""
    return mixing.mixed(docs, mixing.Goal(max_repetition=REPETITION), places=False)


def sharded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with size, text_crc32, law, shard and slot, which replace columns of these names; rows are known by
    their place in their file."""
    file, row = free_name(docs, "from_file"), free_name(docs, "from_row")
    placed = docs.select(
        "*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    shards = sharding.shard_rows(placed, SHARDS, keep=[file, row])
    new = [c for c in shards.columns if c not in (file, row, "doc_id")]
    stay = [c for c in placed.columns if c.lower() not in new]
    return placed.select(*stay).join(shards.select(file, row, *new), [file, row]).drop(file, row)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("benchmark", without_benchmark),
    ("mixture", mixed_sources),
    ("shards", sharded),
]

#: SQL cannot express rank-order profiles, connected components, string tiling, or label propagation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between two stages is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
