"""Which files a request names, and what is wrong with the request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.functions.text import extension
from tallyfold.schemas import DETAILS, SUPPORTED_EXTENSIONS
from tallyfold.session import join_small


def manifest(spark: SparkSession, paths) -> DataFrame:
    """All files below the given paths: ``path, bytes``. Contents are not read.

    A scan leaves out empty files, so those are taken from the scan's own list
    of file names. Spark's driver holds that list for any scan; it goes from
    there to a table without passing through Python.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    sized = listing.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))
    jvm = spark.sparkContext._jvm
    listed = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(listing._jdf.inputFiles())
    listed = spark._jsparkSession.createDataset(listed, jvm.org.apache.spark.sql.Encoders.STRING())
    names = DataFrame(listed.toDF(), spark).toDF("name")
    # A local file is file:///x in this list and file:/x in the metadata column.
    names = names.select(F.regexp_replace("name", "^([a-z0-9+.-]+):///", "$1:/").alias("path"))
    empty = names.join(sized.select("path"), "path", "left_anti").select("path", F.lit(0).cast("bigint").alias("bytes"))
    return sized.unionByName(empty)


def supported(path: Column) -> Column:
    return extension(path).isin(*SUPPORTED_EXTENSIONS)


def keep_supported(files: DataFrame) -> DataFrame:
    return files.where(supported(F.col("path")))


def dedupe(files: DataFrame) -> DataFrame:
    """Repeated or overlapping requests count once."""
    return files.groupBy("path").agg(F.max("bytes").alias("bytes"))


def in_path_order(files: DataFrame) -> DataFrame:
    return files.orderBy("path")


def _ancestors(path: Column) -> Column:
    """The path itself and every folder above it."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")
    )


def discovery_errors(requested: DataFrame, files: DataFrame) -> DataFrame:
    """One row per requested path that yields nothing: ``input, reason, details``.

    ``files`` is the unfiltered listing. Each file is matched to the request
    by equality on itself and on each folder above it, counted before the
    shuffle, so a request for a root folder costs one row per map task.
    ``requested`` may say in a column ``exists`` which inputs are known to
    exist, which tells an empty folder from an absent one.
    """
    if "exists" not in requested.columns:
        requested = requested.withColumn("exists", F.lit(False))
    requested = requested.groupBy("input").agg(F.bool_or("exists").alias("exists"))
    keys = files.select("path", F.explode(_ancestors(F.col("path"))).alias("input"))
    keys = join_small(keys, requested.select("input"), "input", "left_semi")
    found = keys.groupBy("input").agg(
        F.bool_or(F.col("path") == F.col("input")).alias("is_file"),
        F.bool_or(supported(F.col("path"))).alias("any_supported"),
    )
    ext = extension(F.col("input"))
    reason = (
        F.when(F.col("is_file") & ~F.col("any_supported"), "unsupported_format")
        .when(F.col("is_file").isNull() & F.col("exists"), "no_supported_files")
        .when(F.col("is_file").isNull() & (ext == ""), "directory_not_found")
        .when(F.col("is_file").isNull(), "file_not_found")
        .when(~F.col("any_supported"), "no_supported_files")
    )
    before, after = DETAILS["unsupported_format"].split("{ext}")
    details = F.when(
        F.col("reason") == "unsupported_format", F.concat(F.lit(before), ext, F.lit(after))
    )
    for name in ("directory_not_found", "file_not_found", "no_supported_files"):
        details = details.when(F.col("reason") == name, F.lit(DETAILS[name]))
    return (
        requested.join(found, "input", "left")
        .select("input", reason.alias("reason"))
        .where("reason IS NOT NULL")
        .select("input", "reason", details.alias("details"))
    )
