"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyfold import session
from tallyfold.session import new_folder, settle  # noqa: F401  (used by the operators)

# Rows of one Arrow batch. Whole texts travel in batches, so a batch must stay
# small even where texts are long.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with the batch limits of this package; what a worker kept for another operator goes first."""
    prepare(df.sparkSession)
    owner = work.__module__

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(owner)
        return work(batches)

    return df.mapInArrow(task, schema)


# What a worker keeps from task to task, by the module that keeps it. Workers
# outlive the stages of a pipeline, so that a stage would hold it for all others.
kept: dict[str, dict] = {}


def let_go(owner: str) -> None:
    """Free what modules other than ``owner`` keep in this process."""
    others = kept.keys() - {owner}
    for module in others:
        kept.pop(module).clear()
    if others:
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def spans_of(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces whose lengths add up to ``ends``."""
    return np.concatenate(([0], ends[:-1])), ends


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number
