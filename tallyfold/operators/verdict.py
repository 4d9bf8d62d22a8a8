"""What all row checks share.

A checked table has one row per input line (or document part) with

* ``verdict``: ``valid``, ``reject`` or ``skip`` (header and blank lines),
* ``error``: the first failing check of a rejected line,
* ``fatal``: true where the line makes its whole file fail.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

VALID, REJECT, SKIP = "valid", "reject", "skip"


def is_valid() -> Column:
    return F.col("verdict") == VALID


def is_reject() -> Column:
    return F.col("verdict") == REJECT


def any_fatal() -> Column:
    """Aggregate: the file has a fatal line."""
    return F.coalesce(F.bool_or("fatal"), F.lit(False))


def arg_max(value: Column, key: Column) -> Column:
    """Aggregate: ``struct(value, key)`` of the largest value, the smallest key on a tie.

    Rows whose key is NULL do not take part; a NULL value counts as the largest.
    A subtraction is exact for decimals of any width, a change of sign is not.
    """
    return F.min(F.when(key.isNotNull(), F.struct((F.lit(0) - value).alias("neg"), key.alias("key"))))
