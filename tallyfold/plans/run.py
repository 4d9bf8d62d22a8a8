"""A whole run: find files, check them, compute every metric, write the results."""

from __future__ import annotations

import json
import re
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.operators import (
    json_metrics as JM, json_quality as JQ, log_metrics as LM, log_quality as LQ, rollup as R, sales_metrics as SM,
    sales_quality as SQ,
)
from tallyfold.plans import report as P
from tallyfold.schemas import DETAILS, ERR_JSON, ERR_UNREADABLE
from tallyfold.session import prepare, settle
from tallyfold.sources import history as H, lines as L, manifest as M, sinks as K, tolerant as T

MODES = ("parallel", "sequential")
_PROBLEM = "input string, reason string, details string"
# The tables a run stores.
STORED = (
    "file_status", "csv_metrics", "json_metrics", "log_metrics", "report_metrics", "omitted_files", "csv_totals", "json_totals",
    "log_totals", "top_actions", "top_errors", "patterns", "errors",
)


@dataclass
class RunResult:
    """``errors`` is set when no report was written; ``tables`` are lazy."""

    ok: bool
    errors: list[dict] = field(default_factory=list)
    summary: dict = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    out_dir: str | None = None


def _error(path: str, reason: str, **values) -> dict:
    return {"path": path, "reason": reason, "details": DETAILS[reason].format(**values)}


def _qualified(spark: SparkSession, path: str) -> tuple[str, bool]:
    """A requested path in full, by its own file system, and whether it is there.

    Relative paths are resolved by that file system, not by the driver's folder.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = system.makeQualified(hadoop)
    return full.toString(), system.exists(full)


def _literal(path: str) -> str:
    """A path with the signs of patterns taken literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _plain(path: str) -> str:
    """A full path without scheme and host."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)", "", path)


def _plain_column(path: Column) -> Column:
    bare = F.regexp_replace(path, r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)", "")
    return F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))


def _covering(paths: list[str]) -> list[str]:
    """Requested paths without those that repeat or lie below another one."""
    kept: dict[str, str] = {}
    for path in sorted(set(paths), key=lambda p: len(_plain(p))):
        parts = _plain(path).rstrip("/").split("/")
        above = ("/".join(parts[:i]) or "/" for i in range(1, len(parts) + 1))
        if not any(a in kept for a in above):
            kept["/".join(parts) or "/"] = path
    return list(kept.values())


def discover(spark: SparkSession, inputs: list[str]) -> tuple[list[str], DataFrame, DataFrame]:
    """Paths to read, the supported files below them, and the discovery errors."""
    full = {p: _qualified(spark, p) for p in dict.fromkeys(inputs) if p}
    full |= {p: ("/", False) for p in inputs if not p}
    asked = [(p, _plain(q).rstrip("/") or "/", there) for p, (q, there) in full.items()]
    asked = spark.createDataFrame(asked, "asked string, input string, exists boolean")
    roots = [_literal(p) for p in _covering([q for q, there in full.values() if there])]
    if roots:
        # Names beginning with _ or . are listed too; Spark's own listing leaves them out.
        literal = _covering([q for q, there in full.values() if there])
        files = spark.createDataFrame(T.list_files(spark, literal), "path string, bytes long")
    else:
        files = spark.createDataFrame([], "path string, bytes long")
    listing = files.select(_plain_column(F.col("path")).alias("path"), "bytes")
    errors = M.discovery_errors(asked, listing).join(asked.select("asked", "input"), "input")
    return roots, M.keep_supported(files), errors.select(F.col("asked").alias("input"), "reason", "details")


def _with_empty(counts: DataFrame, files: DataFrame, kind: str, rejects: int) -> DataFrame:
    """Line counts of every file of the format, also of those without a line."""
    mine = files.where(F.col("path").endswith(f".{kind}")).select("path")
    zero = F.lit(0).cast("bigint")
    return mine.join(counts, "path", "left").select(
        "path",
        F.coalesce("n_valid", zero).alias("n_valid"),
        F.coalesce("n_reject", F.lit(rejects).cast("bigint")).alias("n_reject"),
        F.coalesce("failed", F.lit(False)).alias("failed"),
    )


def _with_empty_logs(metrics: DataFrame, files: DataFrame) -> DataFrame:
    """Log metrics with a row for each file without a line; such a file is ok."""
    zeros = {"n_valid": 0, "n_reject": 0, "total_entries": 0, "gap_count": 0, "gap_avg": 0.0, "failed": False}
    mine = files.where("endswith(path, '.log')").select("path")
    return mine.join(metrics, "path", "left").fillna(zeros)


def analyze(spark: SparkSession, roots: list[str], files: DataFrame) -> dict[str, DataFrame]:
    """Every result table of a run.

    Each format is scanned once into a small table of facts in the shared
    folder, which all metrics read; a second scan, with line numbers, yields
    the rejected lines.
    """
    listed = [(r["path"], r["bytes"]) for r in files.select("path", "bytes").collect()]
    scans = {kind: T.checked_lines(spark, [f for f in listed if f[0].endswith(f".{kind}")]) for kind in ("csv", "log", "json")}
    sales = L.number_lines(scans["csv"][0])
    raw_log = scans["log"][0]
    docs = T.documents(scans["json"][0])
    unreadable = settle(
        scans["csv"][1].unionByName(scans["log"][1]).unionByName(scans["json"][1])
        .select("path", F.concat(F.lit(ERR_UNREADABLE + ": "), "details").alias("error"))
    )

    cube = settle(SM.sales_cube(SQ.check_sales(sales)))
    # Counting entries needs no line numbers.
    facts = settle(LM.log_facts(LQ.check_log(raw_log.select("path", F.lit(0).alias("line"), "value"))))
    judged = JQ.check_documents(docs)
    documents = settle(JM.json_facts(judged))

    csv, json = settle(SM.sales_metrics(cube)), settle(JM.json_metrics(documents))
    log = settle(_with_empty_logs(LM.log_metrics(facts), files))
    judged_files = (
        R.file_status(_with_empty(csv, files, "csv", 1), "csv")
        .unionByName(R.file_status(_with_empty(json, files, "json", 1), "json"))
        .unionByName(R.file_status(log, "log"))
    )
    # A file that could not be read whole is failed, whatever its readable part says.
    statuses = settle(
        judged_files.join(unreadable.select("path", F.lit(True).alias("unreadable")), "path", "left").select(
            "path", "kind", F.when(F.col("unreadable"), F.lit(R.FAILED)).otherwise(F.col("status")).alias("status")
        )
    )
    log_rejects = LQ.log_rejects(LQ.check_log(L.number_lines(raw_log)))
    line_errors = settle(
        SQ.sales_rejects(sales).unionByName(SQ.empty_files(files)).unionByName(log_rejects)
    )
    no_document = files.where("bytes = 0 AND endswith(path, '.json')").select("path", F.lit(ERR_JSON).alias("error"))
    whole = (
        line_errors.where("line IS NULL").select("path", "error")
        .unionByName(JQ.json_errors(judged))
        .unionByName(no_document)
        .unionByName(unreadable)
    )

    messages = LM.facts_messages(facts)
    top_actions = JM.top_actions(JM.facts_actions(documents))
    top_errors, patterns = LM.top_errors(messages), LM.patterns(messages)
    shown = (
        P.csv_shown(csv)
        .unionByName(P.json_shown(json, top_actions))
        .unionByName(P.log_shown(log, LM.facts_by_level(facts), LM.facts_by_hour(facts), top_errors, patterns))
    )
    return {
        "file_status": statuses,
        "csv_metrics": csv, "json_metrics": json, "log_metrics": log,
        "top_actions": top_actions, "top_errors": top_errors, "patterns": patterns,
        "levels": LM.facts_by_level(facts), "hours": LM.facts_by_hour(facts),
        "csv_totals": R.sales_totals(cube), "json_totals": R.user_totals(json), "log_totals": R.log_totals(facts),
        "line_errors": line_errors, "file_errors": whole, "report_metrics": shown,
        "omitted_files": P.omitted_files(statuses, line_errors),
    }


def _totals_text(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Consolidated totals as ``pos, text``, per format with an ok file."""
    kinds = tables["file_status"].where("status = 'ok'").select("kind").distinct()

    def rows(df: DataFrame, kind: str, texts: list[Column]) -> DataFrame:
        lines = F.array(*[F.struct(F.lit(i).alias("pos"), t.alias("text")) for i, t in enumerate(texts)])
        return df.withColumn("kind", F.lit(kind)).join(kinds, "kind", "left_semi").select(F.inline(lines))

    c = lambda name: F.col(name).cast("string")
    level_text = P.distribution(tables["log_totals"].withColumn("path", F.lit("")), "level")
    entries = tables["log_totals"].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.lit("").alias("path"))
    log = entries.join(level_text, "path", "left").withColumn("text", F.coalesce("text", F.lit(P.NOT_AVAILABLE)))
    # The texts of the totals.
    return {
        "csv": rows(tables["csv_totals"], "csv", [
            F.lit("Consolidated CSV totals:"),
            F.concat(F.lit("  - Total sales: $"), P.number_text(F.col("total_sales"), 2)),
            F.concat(F.lit("  - Total unique products: "), c("unique_products")),
        ]),
        "json": rows(tables["json_totals"], "json", [
            F.lit("Consolidated JSON totals:"),
            F.concat(F.lit("  - Total users (sum): "), c("total_users")),
            F.concat(F.lit("  - Active (sum): "), c("active_users")),
            F.concat(F.lit("  - Inactive (sum): "), c("inactive_users")),
        ]),
        "log": rows(log, "log", [
            F.lit("Consolidated LOG totals:"),
            F.concat(F.lit("  - Total entries: "), c("n")),
            F.concat(F.lit("  - Level distribution: "), F.col("text")),
        ]),
    }


def _plain_error(problem: dict) -> dict:
    return {"path": problem["input"], "reason": problem["reason"], "details": problem["details"]}


def _stored(summary: dict, tables: dict[str, DataFrame], mode: str, elapsed: float, run_dir: str) -> dict:
    """What the history keeps of a run: counts and totals, which are bounded, and where its tables are.

    Metrics of single files grow with the input and so stay in the tables.
    """
    entries = tables["log_totals"].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {
        "counts": summary, "csv_totals": tables["csv_totals"].first().asDict(),
        "json_totals": tables["json_totals"].first().asDict(), "log_totals": {"entries": entries},
        "mode": mode, "elapsed_seconds": elapsed, "report": f"{run_dir}/report", "tables": run_dir,
    }


def stored_run(spark: SparkSession, history_dir: str, run_id: int) -> tuple[dict, dict[str, DataFrame]]:
    """Counts and totals of a stored run, and its tables."""
    row = H.get_run(H.read(spark, history_dir), run_id).select("data").first()
    if row is None:
        raise ValueError(f"no run {run_id}")
    data = json.loads(row["data"])
    return data, {name: spark.read.parquet(f"{data['tables']}/{name}") for name in STORED}


def run(
    spark: SparkSession, inputs: str | list[str], out_dir: str, mode: str = "parallel", history_dir: str | None = None,
) -> RunResult:
    """Process files and folders and write the result tables below ``out_dir``.

    Both modes run the same distributed plan; the name is recorded in the
    report and the history. When no file is ok, only the errors are written.
    """
    started = time.time()
    many = isinstance(inputs, (list, tuple)) and all(isinstance(p, str) for p in inputs)
    if not (isinstance(inputs, str) or many) or not isinstance(out_dir, str):
        return RunResult(False, [_error("", "argument_malformed")])
    if mode not in MODES:
        return RunResult(False, [_error("mode", "invalid_mode", mode=f'"{mode}"')])
    asked = [inputs] if isinstance(inputs, str) else list(inputs)
    prepare(spark)
    roots, files, discovery = discover(spark, asked)
    run_id = time.time_ns() // 1000
    errors_dir = f"{out_dir}/errors"
    # At most one row per requested path.
    problems = [
        {"input": r["input"], "reason": r["reason"], "details": r["details"]} for r in discovery.collect()
    ]
    if not roots or files.limit(1).count() == 0:
        K.write_rejects(P.discovery_rows(spark.createDataFrame(problems, _PROBLEM)), errors_dir, str(run_id))
        return RunResult(False, [_plain_error(p) for p in problems])

    tables = analyze(spark, roots, files)
    statuses = tables["file_status"]
    summary = R.run_summary(statuses).first().asDict()
    elapsed = time.time() - started
    listed = spark.createDataFrame(problems, _PROBLEM)
    tables["errors"] = settle(P.error_list(statuses, tables["line_errors"], tables["file_errors"], listed))
    K.write_rejects(tables["errors"], errors_dir, str(run_id))
    if summary["ok"] == 0:
        error = _error("run", "no_successful_files", total=summary["total"], ok=0)
        return RunResult(False, [error], summary, tables)

    one_row = spark.createDataFrame([summary], R.run_summary(statuses).schema)
    single = asked[0] if len(asked) == 1 and isinstance(inputs, str) else None
    # Tables of a run have a folder of their own, so a later run keeps them.
    run_dir = f"{out_dir}/runs/{run_id}"
    for name in STORED:
        K.write_metrics(tables[name], f"{run_dir}/{name}")
        tables[name] = spark.read.schema(tables[name].schema).parquet(f"{run_dir}/{name}")
    text = P.report_lines(
        one_row, tables["report_metrics"], statuses, tables["omitted_files"], _totals_text(tables),
        tables["errors"].select("path", "error"), elapsed, mode, single,
    )
    report = P.in_report_order(text).select("text")
    report.write.text(f"{run_dir}/report")
    report.write.mode("overwrite").text(f"{out_dir}/report")
    if history_dir:
        data = json.dumps(_stored(summary, tables, mode, elapsed, run_dir))
        H.append(one_row.select(
            F.lit(run_id).alias("id"), F.lit(mode).alias("mode"), F.col("total").cast("int").alias("total_files"),
            "success_rate", F.lit(elapsed * 1000).alias("execution_time_ms"), F.lit(data).alias("data"),
            F.current_timestamp().cast("timestamp_ntz").alias("inserted_at"),
        ), history_dir)
    return RunResult(True, [_plain_error(p) for p in problems], summary, tables, run_dir)
