"""Text files as numbered lines and JSON files as whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyfold.session import join_small, prepare


def scan_lines(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """One row per line: ``path, block, seq, value``.

    ``block`` is the start of the input split the line was read from and
    ``seq`` grows within it, so ``(path, block, seq)`` is the file order.
    """
    reader = prepare(spark).read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line``, the 1-based position in the file: ``path, line, value``.

    Lines are never shuffled to be numbered. One small row per input split
    (its first ``seq`` and line count) is summed along the file, and joined
    back on ``(path, block)``; a key is one split, so no key is hot. Should a
    scan ever be cut differently from the one that was counted, the job fails
    instead of losing or misnumbering lines.
    """
    splits = lines.groupBy("path", "block").agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "path", "block", "first_seq", "n", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("lines_before")
    )
    offset = F.col("seq") - F.col("first_seq")
    line = F.when((offset >= 0) & (offset < F.col("n")), F.col("lines_before") + offset + 1).otherwise(
        F.raise_error(F.lit("input splits changed between two scans")).cast("bigint")
    )
    return join_small(lines, splits, ["path", "block"], "left").select("path", line.alias("line"), "value")


def scan_documents(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """One row per file: ``path, content``."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # wholetext must be passed as an argument; as an option it is reset.
    return reader.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )
