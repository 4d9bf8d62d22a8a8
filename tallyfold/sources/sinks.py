"""Writing results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def write_rejects(rejects: DataFrame, folder: str, run_id: str) -> None:
    """Append a run's errors, one partition per run."""
    rejects.withColumn("run_ts", F.current_timestamp()).withColumn("run_id", F.lit(run_id)).write.mode(
        "append"
    ).partitionBy("run_id").parquet(folder)


def write_metrics(metrics: DataFrame, folder: str) -> None:
    metrics.write.mode("overwrite").parquet(folder)


def write_metrics_csv(metrics: DataFrame, folder: str) -> None:
    metrics.write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def land_lines(lines: DataFrame, folder: str) -> None:
    """Write ``path, line, value`` as one text file per path, in line order.

    Meant for tables whose paths are bounded files: a path is written by one
    task.
    """
    lines.repartition("path").sortWithinPartitions("path", "line").select(
        F.col("path").alias("file"), "value"
    ).write.mode("overwrite").partitionBy("file").text(folder)


def landed_name(path: Column) -> Column:
    """The file name a landed part file stands for."""
    return F.regexp_extract(path, r"/file=([^/]+)/[^/]*$", 1)


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON text per row; arrays, sets and ranges become JSON lists."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
