"""Top-k per group over already reduced counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def top_k(counts: DataFrame, group: str, key: str, n: str, k: int) -> DataFrame:
    """The ``k`` largest counts per group with their ``rank``, key ascending on a tie.

    ``counts`` has one row per ``(group, key)``. The limit sits right above the
    window, so Spark keeps at most ``k`` rows per group and partition before
    the shuffle by group.
    """
    order = Window.partitionBy(group).orderBy(F.desc(n), F.asc(key))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
