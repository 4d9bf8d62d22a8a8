"""Per-file log metrics over valid entries or over reduced facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold import schemas as S
from tallyfold.functions.text import normalize_message
from tallyfold.operators.log_quality import critical
from tallyfold.operators.ranking import top_k
from tallyfold.operators.verdict import arg_max, is_valid

TOP = 5
# Seconds of one piece of the time line in ``error_gaps``.
PIECE_SECONDS = 86_400


def total_entries(checked: DataFrame) -> DataFrame:
    """Entries of every file of a checked table, 0 where no line is valid."""
    return checked.groupBy("path").agg(F.count_if(is_valid()).alias("total_entries"))


def by_level(entries: DataFrame) -> DataFrame:
    return entries.groupBy("path", "level").agg(F.count(F.lit(1)).alias("n"))


def by_hour(entries: DataFrame) -> DataFrame:
    return entries.groupBy("path", F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def _if_critical(value: str) -> Column:
    """A column of a checked table where the line is a critical entry, else NULL."""
    return F.when(is_valid() & F.col("level").isin(*S.CRITICAL_LEVELS), F.col(value))


def top_component(checked: DataFrame) -> DataFrame:
    """The component of every file with the most critical entries, NULL where there are none."""
    counts = checked.groupBy("path", _if_critical("component").alias("component")).agg(F.count(F.lit(1)).alias("n"))
    return _best_component(counts)


def _best_component(counts: DataFrame) -> DataFrame:
    best = counts.groupBy("path").agg(arg_max(F.col("n"), F.col("component")).alias("best"))
    return best.select(
        "path", F.col("best.key").alias("top_component"), (-F.col("best.neg")).alias("top_component_errors")
    )


def message_counts(entries: DataFrame) -> DataFrame:
    return critical(entries).groupBy("path", "message").agg(F.count(F.lit(1)).alias("n"))


def top_errors(counts: DataFrame) -> DataFrame:
    """The five most frequent critical messages from ``path, message, n``."""
    return top_k(counts, "path", "message", "n", TOP).select("path", "rank", "message", "n")


def patterns(counts: DataFrame) -> DataFrame:
    """Recurring normalised messages from ``path, message, n``.

    Up to five patterns seen at least twice; where there is none, the single
    most frequent pattern. Messages are normalised after they are counted, and
    the top five hold all that can be shown: its first row alone or its rows
    with two or more.
    """
    merged = counts.groupBy("path", normalize_message(F.col("message")).alias("pattern")).agg(F.sum("n").alias("n"))
    best = top_k(merged, "path", "pattern", "n", TOP)
    return best.where((F.col("n") >= 2) | (F.col("rank") == 1)).select("path", "rank", "pattern", "n")


def second_counts(checked: DataFrame) -> DataFrame:
    """Critical entries by second; all other lines of a file are one row without a second."""
    return checked.groupBy("path", _if_critical("ts").alias("ts")).agg(F.count(F.lit(1)).alias("n"))


def error_gaps(seconds: DataFrame) -> DataFrame:
    """Seconds between consecutive critical entries: ``n, avg, min, max`` per file.

    ``seconds`` has one row per distinct ``(path, ts)``; a row without a second
    only names the file, whose row says 0 gaps if it has no other. Entries of
    the same second are gaps of 0; the mean is the whole span over the gap count. The
    smallest and largest steps are looked up within pieces of one day, so no
    task sorts more than 86,400 rows, and then across the piece borders.
    """
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    n = F.when(F.col("ts").isNotNull(), F.col("n"))
    points = seconds.select("path", n.alias("n"), at.alias("at"), F.floor(at / PIECE_SECONDS).alias("piece"))
    inside = Window.partitionBy("path", "piece").orderBy("at")
    steps = points.withColumn("step", F.col("at") - F.lag("at").over(inside))
    pieces = steps.groupBy("path", "piece").agg(
        F.sum("n").alias("n"),
        F.max("n").alias("densest"),
        F.min("at").alias("first"),
        F.max("at").alias("last"),
        F.min("step").alias("min_step"),
        F.max("step").alias("max_step"),
    )
    across = Window.partitionBy("path").orderBy("piece")
    pieces = pieces.withColumn("border", F.col("first") - F.lag("last").over(across))
    files = pieces.groupBy("path").agg(
        F.greatest(F.coalesce(F.sum("n"), F.lit(0)) - 1, F.lit(0)).alias("gap_count"),
        (F.max("last") - F.min("first")).alias("span"),
        F.max("densest").alias("densest"),
        F.min(F.least("min_step", "border")).alias("min_step"),
        F.max(F.greatest("max_step", "border")).alias("max_step"),
    )
    some = F.col("gap_count") > 0
    return files.select(
        "path",
        F.col("gap_count"),
        F.when(some, F.col("span") / F.col("gap_count")).otherwise(F.lit(0.0)).alias("gap_avg"),
        F.when(some, F.when(F.col("densest") > 1, F.lit(0).cast("bigint")).otherwise(F.col("min_step"))).alias("gap_min"),
        F.when(some, F.coalesce("max_step", F.lit(0).cast("bigint"))).alias("gap_max"),
    )


def log_facts(checked: DataFrame) -> DataFrame:
    """The one reduction all log results can be derived from: ``path, kind, key, n``.

    Each line adds one fact per grouping it takes part in; they are counted in
    one pass and one shuffle, with a map-side part.
    """
    fact = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))
    base = [fact("level", F.col("level")), fact("hour", F.hour("ts"))]
    extra = [
        fact("component", F.col("component")), fact("message", F.col("message")), fact("second", F.col("ts")),
    ]
    facts = (
        F.when(~is_valid(), F.array(fact("other", F.col("verdict"))))
        .when(F.col("level").isin(*S.CRITICAL_LEVELS), F.array(*base, *extra))
        .otherwise(F.array(*base))
    )
    return (
        checked.select("path", F.explode(facts).alias("f"))
        .groupBy("path", F.col("f.kind").alias("kind"), F.col("f.key").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _of_kind(facts: DataFrame, kind: str, name: str, value: Column | None = None) -> DataFrame:
    key = F.col("key") if value is None else value
    return facts.where(F.col("kind") == kind).select("path", key.alias(name), "n")


def facts_by_level(facts: DataFrame) -> DataFrame:
    return _of_kind(facts, "level", "level")


def facts_by_hour(facts: DataFrame) -> DataFrame:
    return _of_kind(facts, "hour", "hour", F.col("key").cast("int"))


def facts_messages(facts: DataFrame) -> DataFrame:
    return _of_kind(facts, "message", "message")


def facts_seconds(facts: DataFrame) -> DataFrame:
    return _of_kind(facts, "second", "ts", F.col("key").cast("timestamp_ntz"))


def log_metrics(facts: DataFrame) -> DataFrame:
    """The single-valued log metrics and line counts, one row per file."""
    counts = facts.groupBy("path").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "level", F.col("n"))), F.lit(0)).alias("n_valid"),
        F.coalesce(F.sum(F.when(F.col("key").isin("reject") & (F.col("kind") == "other"), F.col("n"))), F.lit(0)).alias(
            "n_reject"
        ),
    )
    component = _best_component(_of_kind(facts, "component", "component"))
    gaps = error_gaps(facts_seconds(facts))
    return (
        counts.join(component, "path", "left")
        .join(gaps, "path", "left")
        .select(
            "path", F.lit(False).alias("failed"), "n_valid", "n_reject",
            F.col("n_valid").alias("total_entries"), "top_component", "top_component_errors",
            F.coalesce("gap_count", F.lit(0)).alias("gap_count"),
            F.coalesce("gap_avg", F.lit(0.0)).alias("gap_avg"), "gap_min", "gap_max",
        )
    )
