"""Report-shaped results: shown metrics, omitted files, errors, full text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions.text import base_name, count_text
from tallyfold.operators.rollup import FAILED, OK, PARTIAL, status
from tallyfold.session import join_small

SECTIONS = {"csv": "CSV", "json": "JSON", "log": "LOG"}

# Labels of the shown metrics, by section and position.
LABELS = {
    "csv": (
        "Total sales", "Unique products", "Best-selling product", "Highest-revenue category",
        "Average discount applied", "Period",
    ),
    "json": (
        "Registered users", "Active users", "Inactive users", "Average session duration",
        "Total pages visited", "Top actions", "Peak activity hour",
    ),
    "log": (
        "Total entries", "Level distribution", "Components with most errors", "Time distribution (by hour)",
        "Most frequent errors", "Time between critical errors (sec)", "Recurring error patterns",
    ),
}
NOT_AVAILABLE = "N/A"
NO_ACTIONS = "(no actions)"
NO_ERRORS = "(no critical errors)"
RULE = "-" * 80
DOUBLE_RULE = "=" * 80


def number_text(value: Column, digits: int) -> Column:
    """A rounded number without needless zeros but with one decimal: ``12.0``."""
    fixed = F.round(value, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def _text(*parts) -> Column:
    made = [p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.coalesce(F.concat(*made), F.lit(NOT_AVAILABLE))


def _shown(df: DataFrame, section: str, rank: Column, values: dict[str, Column]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(LABELS[section].index(label)).alias("pos"), F.lit(label).alias("metric"),
                rank.cast("int").alias("rank"), value.cast("string").alias("value"),
            )
            for label, value in values.items()
        ]
    )
    return df.select(F.lit(section).alias("section"), "path", F.inline(rows))


def clean(metrics: DataFrame) -> DataFrame:
    return metrics.where(status(F.col("n_valid"), F.col("n_reject"), F.col("failed")) == OK)


def distribution(counts: DataFrame, key: str) -> DataFrame:
    """``path, text``: ``k=v`` of every key in key order.

    The counts are one row per ``(path, key)``, so a list holds distinct keys,
    not lines.
    """
    pairs = F.collect_list(F.struct(F.col(key).alias("key"), "n"))
    return counts.groupBy("path").agg(count_text(pairs).alias("text"))


def csv_shown(metrics: DataFrame) -> DataFrame:
    c = F.col
    return _shown(clean(metrics), "csv", F.lit(0), {
        "Total sales": _text("$", number_text(c("total_sales"), 2)),
        "Unique products": c("unique_products"),
        "Best-selling product": _text(c("top_product"), " (", c("top_product_units"), " units)"),
        "Highest-revenue category": _text(c("top_category"), " ($", number_text(c("top_category_revenue"), 2), ")"),
        "Average discount applied": _text(number_text(c("avg_discount_pct"), 2), "%"),
        "Period": _text(c("date_from"), " to ", c("date_to")),
    })


def _whole(value: Column) -> Column:
    """A sum of counts without a decimal point where it is whole."""
    return F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))


def json_shown(metrics: DataFrame, top_actions: DataFrame) -> DataFrame:
    c = F.col
    ok = clean(metrics)
    single = _shown(ok, "json", F.lit(0), {
        "Registered users": c("total_users"),
        "Active users": c("active_users"),
        "Inactive users": c("inactive_users"),
        "Average session duration": _text(number_text(c("avg_session_seconds") / 60, 2), " minutes"),
        "Total pages visited": _whole(c("total_pages")),
        "Peak activity hour": _text(c("peak_hour"), ":00 (", c("peak_sessions"), " sessions)"),
    })
    ranked = _ranked(ok, top_actions, "json", "Top actions", _text(c("action"), " (", c("n"), " times)"), NO_ACTIONS)
    return single.unionByName(ranked)


def _ranked(ok: DataFrame, top: DataFrame, section: str, label: str, value: Column, none: str) -> DataFrame:
    """Ranked rows of ok files; one row saying so for a file without any."""
    rows = ok.select("path").join(top, "path", "left")
    shown = F.when(F.col("rank").isNull(), F.lit(none)).otherwise(value)
    return _shown(rows, section, F.coalesce("rank", F.lit(0)), {label: shown})


def log_shown(metrics: DataFrame, levels: DataFrame, hours: DataFrame, top_errors: DataFrame, patterns: DataFrame):
    c = F.col
    ok = clean(metrics)
    named = (
        ok.join(distribution(levels, "level").withColumnRenamed("text", "levels"), "path", "left")
        .join(distribution(hours, "hour").withColumnRenamed("text", "hours"), "path", "left")
    )
    gaps = _text(
        "avg=", number_text(c("gap_avg"), 2), ", min=", c("gap_min"), ", max=", c("gap_max"), ", n=", c("gap_count")
    )
    single = _shown(named, "log", F.lit(0), {
        "Total entries": c("total_entries"),
        "Level distribution": _text(c("levels")),
        "Components with most errors": _text(c("top_component"), " (", c("top_component_errors"), " errors)"),
        "Time distribution (by hour)": _text(c("hours")),
        "Time between critical errors (sec)": F.when(c("gap_count") > 0, gaps).otherwise(F.lit(NOT_AVAILABLE)),
    })
    errors = _ranked(ok, top_errors, "log", "Most frequent errors", _text(c("message"), " (", c("n"), ")"), NO_ERRORS)
    recurring = _ranked(
        ok, patterns, "log", "Recurring error patterns", _text(c("pattern"), " (", c("n"), ")"), NO_ERRORS
    )
    return single.unionByName(errors).unionByName(recurring)


def omitted_files(statuses: DataFrame, line_errors: DataFrame) -> DataFrame:
    """``path, kind, status, message`` of files that are not ok.

    ``line_errors`` (``path, line, error``) is reduced to the first error of
    each file before the join. Errors without a line are not listed here.
    """
    first = line_errors.where("line IS NOT NULL").groupBy("path").agg(
        F.min(F.struct("line", "error")).alias("first")
    )
    message = F.concat(F.lit("line "), F.col("first.line").cast("string"), F.lit(": "), F.col("first.error"))
    return (
        statuses.where(F.col("status") != OK)
        .join(first, "path", "left")
        .select(
            "path", "kind", "status",
            F.coalesce(message, F.lit("See the errors section for more details")).alias("message"),
        )
    )


def error_list(statuses: DataFrame, line_errors: DataFrame, file_errors: DataFrame, discovery: DataFrame | None = None):
    """``path, reason, details, error``: discovery, whole-file and partial-line errors.

    error is the text of a report. Lines are listed for partial files only; the
    paths of those are one row per file.
    """
    partial = statuses.where(F.col("status") == PARTIAL).select("path")
    line = F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(": "), F.col("error"))
    lines = join_small(line_errors.where("line IS NOT NULL"), partial, "path", "left_semi").select(
        "path", F.lit(PARTIAL).alias("reason"), line.alias("details"), F.concat(F.lit(f"{PARTIAL}: "), line).alias("error")
    )
    whole = file_errors.select("path", F.lit(FAILED).alias("reason"), F.col("error").alias("details"), "error")
    rows = whole.unionByName(lines)
    if discovery is not None:
        rows = discovery_rows(discovery).unionByName(rows)
    return rows


def discovery_rows(discovery: DataFrame) -> DataFrame:
    """Discovery errors as rows of the error list."""
    return discovery.select(
        F.col("input").alias("path"), "reason", "details",
        F.concat("reason", F.lit(': "'), "details", F.lit('"')).alias("error"),
    )


# --- full text ----------------------------------------------------------------

def _lines(df: DataFrame, section: int, path: Column, part: int, texts: list[Column]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), t.alias("text")) for i, t in enumerate(texts)])
    return df.select(
        F.lit(section).alias("section"), F.lit(part).alias("part"), path.alias("path"), F.lit(0).alias("rank"),
        F.inline(rows),
    )


def _title(title: str) -> list[Column]:
    return [F.lit(RULE), F.lit(title), F.lit(RULE)]


def report_lines(
    summary: DataFrame, shown: DataFrame, statuses: DataFrame, omitted: DataFrame, totals: dict[str, DataFrame],
    errors: DataFrame, elapsed: float, mode: str, directory: str | None,
) -> DataFrame:
    """The text report as rows ``section, part, path, pos, rank, text``; sort by all but the text.

    Sections are 0 head, 1 summary, 2 to 4 the formats, 5 errors, 6 end.
    ``totals`` maps a format to rows ``pos, text`` of its consolidated totals.
    """
    none = F.lit("")
    c = lambda name: F.col(name).cast("string")
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    # The texts of the report.
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    out = _lines(summary, 0, none, 0, [
        F.lit(DOUBLE_RULE), F.lit(" " * 20 + "FILE PROCESSING REPORT"), F.lit(DOUBLE_RULE),
        cat("Generation date: ", now), F.lit(f"Single directory: {directory or NOT_AVAILABLE}"),
        F.lit(f"Processing mode: {mode}"), none,
    ])
    out = out.unionByName(_lines(summary, 1, none, 0, [
        *_title("EXECUTIVE SUMMARY"), cat("Total files processed: ", c("total")), cat("  - CSV files: ", c("csv")),
        cat("  - JSON files: ", c("json")), cat("  - LOG files: ", c("log")), none,
        cat(f"Total processing time: {round(elapsed, 4)} seconds"), cat("Files with errors: ", c("failed")),
        cat("Success rate: ", number_text(F.col("success_rate"), 1), "%"), none,
    ]))
    for number, kind in enumerate(SECTIONS, start=2):
        name = SECTIONS[kind]
        counts = statuses.where(F.col("kind") == kind).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == OK).alias("ok")
        )
        out = out.unionByName(_lines(counts.where("n > 0"), number, none, 0, _title(f"{name} FILE METRICS")))
        nothing = counts.where("n > 0 AND ok = 0")
        out = out.unionByName(
            _lines(nothing, number, none, 1, [F.lit(f"No {name} metrics were generated (no files with :ok status).")])
        ).unionByName(
            _lines(nothing, number, none, 5, [F.lit(f"Consolidated {name} totals: N/A (no {name} files with :ok status)")])
        )
        mine = shown.where(F.col("section") == kind)
        heads = mine.where("pos = 0").select("path")
        out = out.unionByName(
            heads.select(
                F.lit(number).alias("section"), F.lit(2).alias("part"), "path", F.lit(0).alias("rank"),
                F.lit(-1).alias("pos"), cat("[File: ", base_name(F.col("path")), "]").alias("text"),
            )
        )
        ranked_labels = ("Top actions", "Most frequent errors", "Recurring error patterns")
        is_list = F.col("metric").isin(*ranked_labels)
        item = F.when(F.col("rank") > 0, cat("    ", c("rank"), ". ", F.col("value"))).otherwise(cat("    ", F.col("value")))
        lead = cat("  * ", F.col("metric"), ":")
        texts = F.when(
            is_list & (F.col("rank") <= 1),
            F.array(F.struct(F.lit(-1).alias("rank"), lead.alias("text")), F.struct("rank", item.alias("text"))),
        ).when(is_list, F.array(F.struct("rank", item.alias("text")))).otherwise(
            F.array(F.struct("rank", cat(lead, " ", F.col("value")).alias("text")))
        )
        out = out.unionByName(
            mine.select("path", "pos", F.inline(texts)).select(
                F.lit(number).alias("section"), F.lit(2).alias("part"), "path", "rank", "pos", "text"
            )
        )
        gone = omitted.where(F.col("kind") == kind)
        lead = gone.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        out = out.unionByName(_lines(lead, number, none, 3, [none, F.lit("Omitted files (errors were found):")]))
        out = out.unionByName(_lines(gone, number, F.col("path"), 4, [
            cat("  - ", base_name(F.col("path")), " (", F.col("status"), "): ", F.col("message"))
        ]))
        out = out.unionByName(
            totals[kind].select(
                F.lit(number).alias("section"), F.lit(6).alias("part"), none.alias("path"), F.lit(0).alias("rank"),
                F.col("pos").cast("int").alias("pos"), "text",
            )
        )
    out = out.unionByName(_lines(summary, 5, none, 0, [none, *_title("ERRORS AND WARNINGS")]))
    any_error = errors.agg(F.count(F.lit(1)).alias("n"))
    out = out.unionByName(_lines(any_error.where("n = 0"), 5, none, 1, [F.lit("No global errors.")]))
    line = F.regexp_extract("error", r"^partial: line (\d+): ", 1).try_cast("bigint")
    out = out.unionByName(
        errors.select(
            F.lit(5).alias("section"), F.lit(2).alias("part"), "path", F.coalesce(line, F.lit(0)).alias("rank"),
            F.lit(0).alias("pos"), cat("✗ ", F.col("path"), ": ", F.col("error")).alias("text"),
        )
    )
    return out.unionByName(_lines(summary, 6, none, 0, [
        none, F.lit(DOUBLE_RULE), F.lit(" " * 27 + "END OF REPORT"), F.lit(DOUBLE_RULE),
    ]))


def in_report_order(lines: DataFrame) -> DataFrame:
    return lines.orderBy("section", "part", "path", "pos", "rank", "text")


# The patterns of the numbers in a stored report text.
TEXT_NUMBERS = {
    "processed_files": (r"Total files processed:\s*(\d+)", "bigint"),
    "csv_files": (r"CSV files:\s*(\d+)", "bigint"),
    "json_files": (r"JSON files:\s*(\d+)", "bigint"),
    "log_files": (r"LOG files:\s*(\d+)", "bigint"),
    "processing_time": (r"Total processing time:\s*([\d.]+)\s*seconds", "double"),
    "success_rate": (r"Success rate:\s*([\d.]+)%", "double"),
}


def text_metrics(texts: DataFrame) -> DataFrame:
    """``id`` and the numbers found in a report text, 0 where one is missing."""
    columns = [
        F.coalesce(F.regexp_extract("content", pattern, 1).try_cast(kind), F.lit(0).cast(kind)).alias(name)
        for name, (pattern, kind) in TEXT_NUMBERS.items()
    ]
    return texts.select("id", *columns)
