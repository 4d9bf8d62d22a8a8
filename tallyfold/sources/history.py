"""Run history as an append-only Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

COLUMNS = ("id", "mode", "total_files", "success_rate", "execution_time_ms", "data", "inserted_at")
REQUIRED = ("mode", "total_files", "success_rate", "execution_time_ms", "data")


def complete_runs(runs: DataFrame) -> DataFrame:
    """Runs that have every required field."""
    test = F.lit(True)
    for name in REQUIRED:
        test = test & F.col(name).isNotNull()
    return runs.where(test)


def append(runs: DataFrame, folder: str) -> None:
    """Append the complete runs; incomplete ones are refused."""
    complete_runs(runs).select(*COLUMNS).write.mode("append").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("inserted_at"), F.desc("id"))


def get_runs(runs: DataFrame, ids: DataFrame) -> DataFrame:
    """The runs with the given ids (a table with a column ``id``)."""
    return runs.join(ids.select("id").distinct(), "id", "left_semi")


def get_run(runs: DataFrame, run_id) -> DataFrame:
    return runs.where(F.col("id") == F.lit(run_id))


def expand(runs: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Read stored JSON back into columns: name to ``path:type``."""
    parsed = runs.select("id", F.try_parse_json("data").alias("doc"))
    columns = []
    for name, spec in fields.items():
        path, kind = spec.rsplit(":", 1)
        columns.append(F.try_variant_get("doc", path, kind).alias(name))
    return parsed.select("id", *columns)
