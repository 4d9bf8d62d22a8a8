"""File status, run summary and totals over clean files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.operators.sales_metrics import cube_sales
from tallyfold.session import join_small
from tallyfold.operators.verdict import any_fatal, is_reject, is_valid

OK, PARTIAL, FAILED = "ok", "partial", "failed"


def status(n_valid: Column, n_reject: Column, failed: Column) -> Column:
    """Failed as a whole or nothing valid; partial if both kinds; else ok.

    A file without any line to judge is ok.
    """
    return (
        F.when(failed | ((n_valid == 0) & (n_reject > 0)), FAILED)
        .when(n_reject > 0, PARTIAL)
        .otherwise(OK)
    )


def line_counts(checked: DataFrame) -> DataFrame:
    """``path, n_valid, n_reject, failed`` of any checked table."""
    return checked.groupBy("path").agg(
        F.count_if(is_valid()).alias("n_valid"),
        F.count_if(is_reject()).alias("n_reject"),
        any_fatal().alias("failed"),
    )


def file_status(counts: DataFrame, kind: str) -> DataFrame:
    """``path, kind, status`` from a table with line counts."""
    return counts.select(
        "path", F.lit(kind).alias("kind"),
        status(F.col("n_valid"), F.col("n_reject"), F.col("failed")).alias("status"),
    )


def ok_paths(counts: DataFrame) -> DataFrame:
    return counts.where(status(F.col("n_valid"), F.col("n_reject"), F.col("failed")) == OK).select("path")


def run_summary(statuses: DataFrame) -> DataFrame:
    """One row: totals, per-format counts, success rate."""
    total, ok = F.count(F.lit(1)), F.count_if(F.col("status") == OK)
    return statuses.agg(
        total.alias("total"),
        ok.alias("ok"),
        (total - ok).alias("failed"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("csv", "json", "log")],
        F.when(total == 0, F.lit(0.0)).otherwise(ok * 100.0 / total).cast("double").alias("success_rate"),
    )


def sales_totals(cube: DataFrame) -> DataFrame:
    """Over ok files: total sales and distinct products of their union.

    The product sets meet as ``(product)`` groups with a map-side part, after
    the cube has already reduced the lines to ``(path, product, category)``.
    """
    counts = cube.groupBy("path").agg(
        F.sum("n_valid").alias("n_valid"), F.sum("n_reject").alias("n_reject"), any_fatal().alias("failed")
    )
    rows = join_small(cube, ok_paths(counts), "path", "left_semi")
    return rows.agg(
        F.coalesce(cube_sales(), F.lit(0.0)).alias("total_sales"),
        F.count_distinct(F.when(F.col("n_valid") > 0, F.col("product"))).alias("unique_products"),
    )


def user_totals(metrics: DataFrame) -> DataFrame:
    """Over ok documents: summed user counts (not distinct users)."""
    return metrics.where(~F.col("failed")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_users", "active_users", "inactive_users")]
    )


def log_totals(facts: DataFrame) -> DataFrame:
    """Over ok files: entries per level, from the log facts."""
    n = F.col("n")
    counts = facts.groupBy("path").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "level", n)), F.lit(0)).alias("n_valid"),
        F.coalesce(F.sum(F.when((F.col("kind") == "other") & (F.col("key") == "reject"), n)), F.lit(0)).alias(
            "n_reject"
        ),
        F.lit(False).alias("failed"),
    )
    levels = facts.where(F.col("kind") == "level").select("path", F.col("key").alias("level"), "n")
    return join_small(levels, ok_paths(counts), "path", "left_semi").groupBy("level").agg(F.sum("n").alias("n"))
