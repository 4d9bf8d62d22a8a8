"""Text and path expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters of Unicode White_Space.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_unicode(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def normalize_message(text: Column) -> Column:
    """Digits to ``<num>``, white-space runs to one space, ends trimmed."""
    numbers = F.regexp_replace(text, r"\d+", "<num>")
    return trim_unicode(F.regexp_replace(numbers, r"\s+", " "))


def base_name(path: Column) -> Column:
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def dir_name(path: Column) -> Column:
    clean = F.rtrim(path, F.lit("/"))
    keep = F.length(clean) - F.length(base_name(path)) - 1
    return (
        F.when(keep < 0, F.lit("."))
        .when(keep == 0, F.lit("/"))
        .otherwise(F.substring(clean, F.lit(1), keep))
    )


def extension(path: Column) -> Column:
    """The last dot part of the base name, with its dot; ``''`` for dot files."""
    return F.regexp_extract(base_name(path), r"^.+?(\.[^.]*)$", 1)


def count_text(counts: Column) -> Column:
    """``k=v, k=v`` in key order from an array of ``struct(key, n)``."""
    pairs = F.transform(
        F.array_sort(counts), lambda c: F.concat(c["key"].cast("string"), F.lit("="), c["n"].cast("string"))
    )
    return F.when(F.size(counts) > 0, F.array_join(pairs, ", ")).otherwise(F.lit("N/A"))
