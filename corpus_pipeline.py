"""A training corpus from ``documents``: each stage is an operator of ``tallyfold.llm``.

Stages take and return the columns of ``documents``; the last one adds the n
best segmentations of each text, with scores, the ``ids`` of the best one, and
whether all of them decode to the text. Null texts do not pass the first stage. The
near-duplicate stage gives every row its own key: of each group one row stays,
that of the smallest id (null ids last), so repeated rows count as copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import decontaminate, language, pieces, secrets, simhash
from tallyfold.llm.common import new_folder, table
from tallyfold.llm.queries import TOKENIZER


def in_a_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    return language.spoken(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    return secrets.mask(docs)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The n best segmentations of each text, decoded again."""
    return pieces.n_best(docs, TOKENIZER, room=pieces.BEST_CACHE_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", in_a_known_language),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmarks),
    ("secret_scans", without_secrets),
    ("sentencepiece", in_pieces),
]

# Language models, Hamming links and n-best search cannot be written in SQL.
ORACLE_SQL = None


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus of ``whole`` with the columns of ``documents`` and ``ids``; all stages are done and written."""
    columns = table(spark, sf_dir, "documents").drop("ids").columns
    return whole(spark, sf_dir).select(*columns, "ids")
