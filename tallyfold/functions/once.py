"""Evaluate costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def once(df: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    """``keep`` plus the named SQL expressions, each computed once per row.

    A plain projection would be merged into later filters and projections,
    repeating a regular expression or a JSON parse for every reference. A
    one-element ``inline`` yields the same rows, and later operators read its
    output. Higher-order functions do not take part in generated code and slow
    down the whole operator, so the line checks do without them.
    """
    made = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return df.selectExpr(*keep, f"inline(array(struct({made})))")
