"""The document pipeline: language ID, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir), works on all documents that the
stage before kept, and calls one operator of `daycast.llm`.  `run` writes
every stage's result as Parquet below the shared checkpoint folder and
reads it again as the next one's documents, so an executor lost in a stage
costs no work of the stages before.  All stages but the last return the
columns of `documents`.

No stage's rows can be expressed in SQL as a whole (a trained network
decides in the first), so `ORACLE_SQL` is None.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from daycast.llm.bpe import bpe_round_trip
from daycast.llm.common import checkpoint_dir, documents
from daycast.llm.decontaminate import without_leaks
from daycast.llm.langid import fit_language_model, in_known_language
from daycast.llm.line_dedup import without_repeated_lines
from daycast.llm.minhash import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; the others go."""
    return in_known_language(docs, fit_language_model(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that loses all its words with them goes."""
    return without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the text decoded from them."""
    return bpe_round_trip(docs, with_ids=True)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
