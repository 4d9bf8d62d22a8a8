"""Registered queries: each operator over the driver's tables, with its SQL check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.functions import strict, text
from tallyfold.operators import (
    json_metrics as JM, json_quality as JQ, log_metrics as LM, log_quality as LQ, rollup as R, sales_metrics as SM,
    sales_quality as SQ,
)
from tallyfold.plans import bindings as B, oracles as O, report as P
from tallyfold.session import new_folder, settle
from tallyfold.sources import history as H, lines as L, manifest as M, sinks as K

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    return SQ.check_sales(B.sales_lines(spark, sf))


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return LQ.check_log(B.log_lines(spark, sf))


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return LQ.valid_entries(_log(spark, sf))


def _json(spark: SparkSession, sf: str) -> DataFrame:
    return JQ.check_documents(B.json_documents(spark, sf))


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    return JQ.sessions(_json(spark, sf))


def _round(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _whole(df: DataFrame, *names: str) -> DataFrame:
    """Exact wide numbers as bigint; the given tables hold no wider ones."""
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def _landed(lines: DataFrame, label: str) -> str:
    folder = new_folder(lines.sparkSession, label)
    K.land_lines(lines, folder)
    return folder


# --- scans -------------------------------------------------------------------

@register("manifest", O.with_ctes(
    "SELECT path, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes FROM l_text GROUP BY path", O.LOG))
def q_manifest(spark, sf):
    files = M.manifest(spark, _landed(B.log_lines(spark, sf), "logs"))
    return files.select(K.landed_name(F.col("path")).alias("path"), "bytes")


@register("manifest_ext_filter", O.with_ctes(
    "SELECT path, bytes FROM f_paths, range(CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END) WHERE supported", O.FILES))
def q_ext(spark, sf):
    return M.keep_supported(B.file_listing(spark, sf))


@register("manifest_dedupe", O.with_ctes("SELECT path, bytes FROM f_paths", O.FILES))
def q_dedupe(spark, sf):
    return M.dedupe(B.file_listing(spark, sf))


@register("manifest_sorted", O.with_ctes("SELECT path, bytes FROM f_paths WHERE supported ORDER BY path", O.FILES))
def q_sorted(spark, sf):
    return M.in_path_order(M.keep_supported(M.dedupe(B.file_listing(spark, sf))))


@register("discovery_errors", O.with_ctes("""
, f_req AS (
  SELECT DISTINCT CASE WHEN quality = 1 THEN path ELSE folder END AS input
  FROM labels JOIN f_paths USING (doc_id)
  UNION SELECT CASE WHEN page_id % 2 = 0 THEN '/lost/' || page_id || '.csv' ELSE '/lost/' || page_id END FROM pages),
f_hit AS (
  SELECT path AS input, true AS is_file, supported FROM f_paths
  UNION ALL SELECT folder, false, supported FROM f_paths),
f_found AS (SELECT input, bool_or(is_file) AS is_file, bool_or(supported) AS any_supported FROM f_hit GROUP BY input),
f_err AS (
  SELECT input, CASE WHEN is_file AND NOT any_supported THEN 'unsupported_format'
      WHEN is_file IS NULL AND input LIKE '%.%' THEN 'file_not_found'
      WHEN is_file IS NULL THEN 'directory_not_found'
      WHEN NOT any_supported THEN 'no_supported_files' END AS reason
  FROM f_req LEFT JOIN f_found USING (input))
SELECT input, reason, CASE reason
  WHEN 'unsupported_format' THEN 'The ' || CASE WHEN input LIKE '%.CSV' THEN '.CSV' ELSE '' END || ' extension is not supported.'
  WHEN 'file_not_found' THEN 'The given path is not a file or does not exist.'
  WHEN 'directory_not_found' THEN 'The given path is not a directory or does not exist.'
  ELSE 'Directory contains no supported files.' END AS details
FROM f_err WHERE reason IS NOT NULL""", O.FILES))
def q_discovery(spark, sf):
    return M.discovery_errors(B.requested_paths(spark, sf), B.file_listing(spark, sf))


@register("scan_csv_lines", O.with_ctes("SELECT path, line = 1 AS is_header, value FROM s_text", O.SALES))
def q_scan_csv(spark, sf):
    lines = L.number_lines(L.scan_lines(spark, _landed(B.sales_lines(spark, sf), "sales")))
    return lines.select(
        K.landed_name(F.col("path")).alias("path"), (F.col("line") == 1).alias("is_header"), "value"
    )


@register("scan_log_lines", O.with_ctes("SELECT path, value FROM l_text", O.LOG))
def q_scan_log(spark, sf):
    lines = L.scan_lines(spark, _landed(B.log_lines(spark, sf), "logs"))
    return lines.select(K.landed_name(F.col("path")).alias("path"), "value")


@register("scan_json_docs", O.with_ctes("SELECT path, content FROM t_text", O.JSON, O.JSON_TEXT))
def q_scan_json(spark, sf):
    docs = B.json_documents(spark, sf).select("path", F.lit(1).alias("line"), F.col("content").alias("value"))
    landed = L.scan_documents(spark, _landed(docs, "documents"))
    return landed.select(
        K.landed_name(F.col("path")).alias("path"), F.regexp_replace("content", r"\n\z", "").alias("content")
    )


@register("line_numbers", O.with_ctes("SELECT path, line, value FROM l_text", O.LOG))
def q_line_numbers(spark, sf):
    lines = L.number_lines(L.scan_lines(spark, _landed(B.log_lines(spark, sf), "logs")))
    return lines.select(K.landed_name(F.col("path")).alias("path"), "line", "value")


# --- sales row quality ---------------------------------------------------------

@register("csv_header_check", O.with_ctes("SELECT path, NOT bad_header AS header_ok FROM s_file", O.SALES))
def q_header(spark, sf):
    content = SQ.split_fields(B.sales_lines(spark, sf).where("line = 1"))
    return content.selectExpr("path", f"{SQ.header_ok('value')} AS header_ok")


@register("csv_empty_check", O.with_ctes(
    "SELECT 'empty_' || s_suppkey || '.csv' AS path, CAST(1 AS BIGINT) AS line, 'Empty CSV' AS error FROM supplier", O.SALES))
def q_empty(spark, sf):
    size = F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes")
    files = B.sales_lines(spark, sf).groupBy("path").agg(size)
    empty = B.table(spark, sf, "supplier").selectExpr("concat('empty_', s_suppkey, '.csv') AS path", "0L AS bytes")
    return SQ.empty_files(files.unionByName(empty))


@register("csv_quote_repair", O.with_ctes(
    "SELECT path, CAST(line AS BIGINT) AS line, product FROM s_err WHERE fault NOT IN (3, 9, 13)", O.SALES))
def q_repair(spark, sf):
    raw = SQ.raw_fields(B.sales_lines(spark, sf)).where("line > 1 AND six")
    return raw.select("path", "line", F.col("raw_product").alias("product"))


@register("csv_arity_check", O.with_ctes(
    "SELECT path, CAST(line AS BIGINT) AS line FROM s_err WHERE fault IN (3, 9, 13)", O.SALES))
def q_arity(spark, sf):
    return SQ.raw_fields(B.sales_lines(spark, sf)).where("line > 1 AND NOT six").select("path", "line")


def _field_check(field: str, reading):
    def query(spark, sf):
        raw = SQ.raw_fields(B.sales_lines(spark, sf)).where("line > 1 AND six")
        return raw.select("path", "line", F.col(field).alias("raw"), F.expr(reading(field)).alias("value"))

    return query


def _check_sql(raw: str, value: str, bad: str) -> str:
    return O.with_ctes(
        f"SELECT path, CAST(line AS BIGINT) AS line, {raw} AS raw, CASE WHEN {bad} THEN NULL ELSE {value} END AS value"
        " FROM s_fields WHERE fault NOT IN (3, 9, 13)", O.SALES)


register("csv_date_check", _check_sql("f_date", "dt", "fault IN (2, 11, 15)"))(
    _field_check("raw_date", strict.to_date))
register("csv_float_check", _check_sql(
    "f_price", "CASE WHEN fault = 1 THEN -1 ELSE 1 END * CAST(price AS DOUBLE)", "fault IN (6, 10)"))(
    _field_check("raw_unit_price", strict.to_double))
register("csv_int_check", _check_sql("f_qty", "CASE WHEN fault = 7 THEN 0 ELSE qty END", "fault IN (0, 12, 15)"))(
    lambda spark, sf: _whole(_field_check("raw_quantity", strict.to_integer)(spark, sf), "value"))


@register("csv_positive_check", O.with_ctes("""
SELECT path, CAST(line AS BIGINT) AS line,
  CASE WHEN fault IN (6, 10) THEN NULL ELSE fault <> 1 END AS price_positive,
  CASE WHEN fault IN (0, 12, 15) THEN NULL ELSE fault <> 7 END AS quantity_positive
FROM s_err WHERE fault NOT IN (3, 9, 13)""", O.SALES))
def q_positive(spark, sf):
    raw = SQ.raw_fields(B.sales_lines(spark, sf)).where("line > 1 AND six")
    return raw.select(
        "path", "line",
        (F.expr(strict.to_double("raw_unit_price")) > 0).alias("price_positive"),
        (F.expr(strict.to_integer("raw_quantity")) > 0).alias("quantity_positive"),
    )


@register("csv_discount_check", O.with_ctes("""
SELECT path, CAST(line AS BIGINT) AS line, CASE WHEN fault = 8 THEN NULL ELSE fault <> 4 END AS in_range
FROM s_err WHERE fault NOT IN (3, 9, 13)""", O.SALES))
def q_discount(spark, sf):
    raw = SQ.raw_fields(B.sales_lines(spark, sf)).where("line > 1 AND six")
    return raw.select("path", "line", F.expr(strict.to_double("raw_discount")).between(0, 100).alias("in_range"))


@register("csv_valid_rows", O.with_ctes("""
SELECT path, CAST(line AS BIGINT) AS line, dt AS date, product, category, CAST(price AS DOUBLE) AS unit_price,
  qty AS quantity, CAST(disc AS DOUBLE) AS discount_pct FROM s_valid""", O.SALES))
def q_valid(spark, sf):
    rows = SQ.valid_sales(B.sales_lines(spark, sf)).drop("gross", "net")
    return _whole(rows, "quantity")


@register("csv_rejects", O.with_ctes("SELECT path, line, error FROM s_reject", O.SALES))
def q_rejects(spark, sf):
    return SQ.sales_rejects(B.sales_lines(spark, sf))


@register("csv_net", O.with_ctes("""
SELECT path, CAST(line AS BIGINT) AS line, round(CAST(price AS DOUBLE) * qty, 2) AS gross, round(net, 4) AS net
FROM s_valid""", O.SALES))
def q_net(spark, sf):
    rows = SQ.valid_sales(B.sales_lines(spark, sf)).select("path", "line", "gross", "net")
    return _round(_round(rows, 2, "gross"), 4, "net")


# --- log row quality -----------------------------------------------------------

@register("log_blank_filter", O.with_ctes("SELECT path, line, value FROM l_text WHERE value <> '   '", O.LOG))
def q_blank(spark, sf):
    return LQ.drop_blank(B.log_lines(spark, sf))


@register("log_extract", O.with_ctes("""
SELECT path, line, strftime(ts, '%Y-%m-%d') AS day,
  CASE WHEN fault = 1 THEN '25' || substr(strftime(ts, '%H:%M:%S'), 3) ELSE strftime(ts, '%H:%M:%S') END AS time,
  level, component, message FROM l_err WHERE fault NOT IN (0, 2, 3, 4)""", O.LOG))
def q_extract(spark, sf):
    return LQ.extract(B.log_lines(spark, sf)).where("day IS NOT NULL")


@register("log_timestamp_check", O.with_ctes("""
SELECT path, line, CASE WHEN fault = 1 THEN NULL ELSE ts END AS ts FROM l_err WHERE fault NOT IN (0, 2, 3, 4)""", O.LOG))
def q_timestamp(spark, sf):
    rows = LQ.extract(B.log_lines(spark, sf)).where("day IS NOT NULL")
    return rows.select("path", "line", F.expr(strict.to_timestamp_ntz("concat(day, ' ', time)")).alias("ts"))


@register("log_valid_rows", O.with_ctes("SELECT path, line, ts, level, component, message FROM l_valid", O.LOG))
def q_log_valid(spark, sf):
    return _entries(spark, sf)


@register("log_rejects", O.with_ctes("SELECT path, line, error FROM l_reject", O.LOG))
def q_log_rejects(spark, sf):
    return LQ.log_rejects(_log(spark, sf))


@register("log_critical", O.with_ctes("SELECT path, line, ts, level, component, message FROM l_crit", O.LOG))
def q_critical(spark, sf):
    return LQ.critical(_entries(spark, sf))


# --- documents -------------------------------------------------------------------

@register("json_validity", O.with_ctes("""
SELECT path, CASE WHEN error LIKE 'type%' THEN NULL ELSE error END AS error FROM j_docs""", O.JSON))
def q_json_validity(spark, sf):
    return JQ.parse_documents(B.json_documents(spark, sf)).select("path", "error")


@register("json_type_violations", O.with_ctes("""
SELECT path, CASE WHEN error LIKE 'type%' THEN 'activo' END AS violation FROM j_docs
WHERE error IS NULL OR error LIKE 'type%'""", O.JSON))
def q_json_violations(spark, sf):
    parsed = JQ.parse_documents(B.json_documents(spark, sf)).where("error IS NULL")
    return JQ.find_violations(parsed).select("path", "violation")


@register("json_users", O.with_ctes("SELECT path, id AS user_id, name, active FROM j_u", O.JSON))
def q_json_users(spark, sf):
    return JQ.users(_json(spark, sf)).select("path", "user_id", "name", "active")


@register("json_sessions", O.with_ctes("SELECT path, user_id, start, seconds, pages FROM j_s", O.JSON))
def q_json_sessions(spark, sf):
    return _sessions(spark, sf).drop("actions")


@register("json_actions", O.with_ctes("SELECT path, action FROM j_a", O.JSON))
def q_json_actions(spark, sf):
    return JQ.actions(_sessions(spark, sf))


@register("json_session_hours", O.with_ctes("SELECT path, hour FROM j_s WHERE hour IS NOT NULL", O.JSON))
def q_json_hours(spark, sf):
    return JQ.session_hours(_sessions(spark, sf))


# --- sales metrics -----------------------------------------------------------------

@register("csv_total_sales", O.with_ctes("""
SELECT path, round(coalesce(total_sales, 0.0), 2) AS total_sales FROM s_file LEFT JOIN m_sum USING (path)""",
    O.SALES, O.SALES_METRICS))
def q_total(spark, sf):
    return _round(SM.total_sales(_sales(spark, sf)), 2, "total_sales")


@register("csv_unique_products", O.with_ctes("""
SELECT path, coalesce(unique_products, 0) AS unique_products FROM s_file LEFT JOIN m_sum USING (path)""",
    O.SALES, O.SALES_METRICS))
def q_unique(spark, sf):
    return SM.unique_products(_sales(spark, sf))


@register("csv_top_product", O.with_ctes("""
SELECT path, product AS top_product, v AS top_product_units FROM s_file LEFT JOIN m_prod USING (path)""",
    O.SALES, O.SALES_METRICS))
def q_top_product(spark, sf):
    return _whole(SM.top_product(_sales(spark, sf)), "top_product_units")


@register("csv_top_category", O.with_ctes("""
SELECT path, category AS top_category, round(v, 2) AS top_category_revenue FROM s_file LEFT JOIN m_cat USING (path)""",
    O.SALES, O.SALES_METRICS))
def q_top_category(spark, sf):
    return _round(SM.top_category(_sales(spark, sf)), 2, "top_category_revenue")


@register("csv_avg_discount", O.with_ctes("""
SELECT path, round(coalesce(disc, 0.0), 6) AS avg_discount_pct FROM s_file LEFT JOIN m_sum USING (path)""",
    O.SALES, O.SALES_METRICS))
def q_avg_discount(spark, sf):
    return _round(SM.average_discount(_sales(spark, sf)), 6, "avg_discount_pct")


@register("csv_date_range", O.with_ctes(
    "SELECT path, date_from, date_to FROM s_file LEFT JOIN m_sum USING (path)", O.SALES, O.SALES_METRICS))
def q_date_range(spark, sf):
    return SM.date_range(_sales(spark, sf))


@register("csv_metrics", O.with_ctes("""
SELECT path, failed, CASE WHEN failed THEN 0 ELSE n_valid END AS n_valid,
  round(coalesce(total_sales, 0.0), 2) AS total_sales, coalesce(unique_products, 0) AS unique_products,
  m_prod.product AS top_product, m_prod.v AS top_product_units, m_cat.category AS top_category,
  round(m_cat.v, 2) AS top_category_revenue, round(coalesce(disc, 0.0), 6) AS avg_discount_pct, date_from, date_to
FROM s_file LEFT JOIN m_sum USING (path) LEFT JOIN m_prod USING (path) LEFT JOIN m_cat USING (path)""",
    O.SALES, O.SALES_METRICS))
def q_csv_metrics(spark, sf):
    metrics = SM.sales_metrics(settle(SM.sales_cube(_sales(spark, sf)))).drop("n_reject")
    metrics = _whole(metrics, "top_product_units")
    return _round(_round(metrics, 2, "total_sales", "top_category_revenue"), 6, "avg_discount_pct")


# --- document metrics ----------------------------------------------------------------

@register("json_user_counts", O.with_ctes("SELECT path, coalesce(total_users, 0) AS total_users, coalesce(active_users, 0) AS active_users,"
    " coalesce(inactive_users, 0) AS inactive_users FROM j_docs LEFT JOIN j_uc USING (path) WHERE error IS NULL", O.JSON))
def q_user_counts(spark, sf):
    return JM.user_counts(_json(spark, sf))


@register("json_avg_session", O.with_ctes(
    "SELECT path, round(coalesce(avg_session_seconds, 0.0), 6) AS avg_session_seconds"
    " FROM j_docs LEFT JOIN j_sc USING (path) WHERE error IS NULL", O.JSON))
def q_avg_session(spark, sf):
    return _round(JM.session_totals(_json(spark, sf)).drop("total_pages"), 6, "avg_session_seconds")


@register("json_total_pages", O.with_ctes("SELECT path, coalesce(total_pages, 0.0) AS total_pages FROM j_docs LEFT JOIN j_sc USING (path) WHERE error IS NULL", O.JSON))
def q_total_pages(spark, sf):
    return JM.session_totals(_json(spark, sf)).drop("avg_session_seconds")


@register("json_peak_hour", O.with_ctes("SELECT path, peak_hour, peak_sessions FROM j_docs LEFT JOIN j_peak USING (path) WHERE error IS NULL", O.JSON))
def q_peak_hour(spark, sf):
    return JM.peak_hour(_json(spark, sf))


@register("json_top_actions", O.with_ctes("SELECT path, rank, action, n FROM j_top", O.JSON))
def q_top_actions(spark, sf):
    return JM.top_actions(JM.action_counts(JQ.actions(_sessions(spark, sf))))


@register("json_metrics", O.with_ctes("""
SELECT path, error IS NOT NULL AS failed, coalesce(total_users, 0) AS total_users,
  coalesce(active_users, 0) AS active_users, coalesce(inactive_users, 0) AS inactive_users,
  round(coalesce(avg_session_seconds, 0.0), 6) AS avg_session_seconds, coalesce(total_pages, 0.0) AS total_pages,
  peak_hour, peak_sessions
FROM j_docs LEFT JOIN j_uc USING (path) LEFT JOIN j_sc USING (path) LEFT JOIN j_peak USING (path)""", O.JSON))
def q_json_metrics(spark, sf):
    facts = settle(JM.json_facts(_json(spark, sf)))
    return _round(JM.json_metrics(facts).drop("n_valid", "n_reject"), 6, "avg_session_seconds")


# --- log metrics ----------------------------------------------------------------------

@register("log_total_entries", O.with_ctes("SELECT path, n_valid AS total_entries FROM l_file", O.LOG))
def q_total_entries(spark, sf):
    return LM.total_entries(_log(spark, sf))


@register("log_by_level", O.with_ctes("SELECT * FROM l_level", O.LOG))
def q_by_level(spark, sf):
    return LM.by_level(_entries(spark, sf))


@register("log_by_hour", O.with_ctes("SELECT * FROM l_hour", O.LOG))
def q_by_hour(spark, sf):
    return LM.by_hour(_entries(spark, sf))


@register("log_top_component", O.with_ctes(
    "SELECT path, component AS top_component, n AS top_component_errors FROM l_file LEFT JOIN l_comp USING (path)", O.LOG))
def q_top_component(spark, sf):
    return LM.top_component(_log(spark, sf))


@register("log_top_errors", O.with_ctes("SELECT path, rank, message, n FROM l_top", O.LOG))
def q_top_errors(spark, sf):
    return LM.top_errors(LM.message_counts(_entries(spark, sf)))


@register("log_error_gaps", O.with_ctes(
    "SELECT path, coalesce(gap_count, 0) AS gap_count, round(coalesce(gap_avg, 0.0), 6) AS gap_avg, gap_min, gap_max"
    " FROM l_file LEFT JOIN l_gap USING (path)", O.LOG))
def q_gaps(spark, sf):
    return _round(LM.error_gaps(LM.second_counts(_log(spark, sf))), 6, "gap_avg")


@register("log_patterns", O.with_ctes("SELECT path, rank, pattern, n FROM l_pat", O.LOG))
def q_patterns(spark, sf):
    return LM.patterns(LM.message_counts(_entries(spark, sf)))


@register("log_metrics", O.with_ctes("""
SELECT path, n_valid AS total_entries, n_reject, component AS top_component, n AS top_component_errors,
  coalesce(gap_count, 0) AS gap_count, round(coalesce(gap_avg, 0.0), 6) AS gap_avg, gap_min, gap_max
FROM l_file LEFT JOIN l_comp USING (path) LEFT JOIN l_gap USING (path)""", O.LOG))
def q_log_metrics(spark, sf):
    metrics = LM.log_metrics(settle(LM.log_facts(_log(spark, sf)))).drop("failed", "n_valid")
    return _round(metrics, 6, "gap_avg")


# --- roll-up -----------------------------------------------------------------------------

_STATUS = "SELECT * FROM s_status UNION ALL SELECT * FROM j_status UNION ALL SELECT * FROM l_status"


def _statuses(spark: SparkSession, sf: str) -> DataFrame:
    csv = R.file_status(R.line_counts(_sales(spark, sf)), "csv")
    json = R.file_status(R.line_counts(_json(spark, sf)), "json")
    return csv.unionByName(json).unionByName(R.file_status(R.line_counts(_log(spark, sf)), "log"))


@register("file_status", O.with_ctes(_STATUS, O.SALES, O.JSON, O.LOG))
def q_status(spark, sf):
    return _statuses(spark, sf)


@register("run_summary", O.with_ctes(f"""
SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status <> 'ok') AS failed,
  count(*) FILTER (kind = 'csv') AS csv, count(*) FILTER (kind = 'json') AS json,
  count(*) FILTER (kind = 'log') AS log,
  round(CAST(count(*) FILTER (status = 'ok') AS DOUBLE) * 100 / count(*), 6) AS success_rate
FROM ({_STATUS})""", O.SALES, O.JSON, O.LOG))
def q_summary(spark, sf):
    return _round(R.run_summary(_statuses(spark, sf)), 6, "success_rate")


@register("csv_consolidated", O.with_ctes("""
SELECT round(coalesce(sum(net), 0.0), 2) AS total_sales, count(DISTINCT product) AS unique_products
FROM s_valid WHERE path IN (SELECT path FROM s_status WHERE status = 'ok')""", O.SALES))
def q_csv_consolidated(spark, sf):
    return _round(R.sales_totals(settle(SM.sales_cube(_sales(spark, sf)))), 2, "total_sales")


@register("json_consolidated", O.with_ctes("""
SELECT count(*) AS total_users, count(*) FILTER (active) AS active_users,
  count(*) FILTER (NOT active) AS inactive_users FROM j_u""", O.JSON))
def q_json_consolidated(spark, sf):
    return R.user_totals(JM.json_metrics(JM.json_facts(_json(spark, sf))))


@register("log_consolidated", O.with_ctes("""
SELECT level, CAST(sum(n) AS BIGINT) AS n FROM l_level
WHERE path IN (SELECT path FROM l_status WHERE status = 'ok') GROUP BY level""", O.LOG))
def q_log_consolidated(spark, sf):
    return R.log_totals(settle(LM.log_facts(_log(spark, sf))))


# --- report ------------------------------------------------------------------------------

def _money(value: str) -> str:
    return "'$' || " + O.number_text(value, 2)


_OK = {k: f"path IN (SELECT path FROM {k[0]}_status WHERE status = 'ok')" for k in ("csv", "json", "log")}
_OK["csv"] = "path IN (SELECT path FROM s_status WHERE status = 'ok')"
_LEVELS = "(SELECT path, string_agg(level || '=' || n, ', ' ORDER BY level) AS text FROM l_level GROUP BY path)"
_HOURS = "(SELECT path, string_agg(hour || '=' || n, ', ' ORDER BY hour) AS text FROM l_hour GROUP BY path)"


def _rows(section: str, source: str, values: list[tuple[str, str]], rank: str = "0") -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, path, CAST({P.LABELS[section].index(label)} AS INT) AS pos, '{label}' AS metric,"
        f" CAST({rank} AS INT) AS rank, CAST({value} AS VARCHAR) AS value FROM {source} WHERE {_OK[section]}"
        for label, value in values
    )


_REPORT = " UNION ALL ".join([
    _rows("csv", "s_file LEFT JOIN m_sum USING (path) LEFT JOIN m_prod USING (path)", [
        ("Total sales", _money("coalesce(total_sales, 0)")),
        ("Unique products", "coalesce(unique_products, 0)"),
        ("Best-selling product", "product || ' (' || v || ' units)'"),
        ("Average discount applied", O.number_text("disc", 2) + " || '%'"),
        ("Period", "date_from || ' to ' || date_to"),
    ]),
    _rows("csv", "m_cat", [("Highest-revenue category", "category || ' (' || " + _money("v") + " || ')'")]),
    _rows("json", "j_docs LEFT JOIN j_uc USING (path) LEFT JOIN j_sc USING (path) LEFT JOIN j_peak USING (path)", [
        ("Registered users", "coalesce(total_users, 0)"),
        ("Active users", "coalesce(active_users, 0)"),
        ("Inactive users", "coalesce(inactive_users, 0)"),
        ("Average session duration", O.number_text("coalesce(avg_session_seconds, 0) / 60", 2) + " || ' minutes'"),
        ("Total pages visited", "coalesce(CAST(total_pages AS BIGINT), 0)"),
        ("Peak activity hour", "coalesce(peak_hour || ':00 (' || peak_sessions || ' sessions)', 'N/A')"),
    ]),
    _rows("json", "j_docs LEFT JOIN j_top USING (path)", [
        ("Top actions", "coalesce(action || ' (' || n || ' times)', '(no actions)')")], "coalesce(rank, 0)"),
    _rows("log", f"l_file LEFT JOIN {_LEVELS} USING (path)", [
        ("Total entries", "n_valid"), ("Level distribution", "text")]),
    _rows("log", _HOURS, [("Time distribution (by hour)", "text")]),
    _rows("log", "l_file LEFT JOIN l_comp USING (path)", [
        ("Components with most errors", "coalesce(component || ' (' || n || ' errors)', 'N/A')")]),
    _rows("log", "l_file LEFT JOIN l_gap USING (path)", [(
        "Time between critical errors (sec)",
        "CASE WHEN coalesce(gap_count, 0) = 0 THEN 'N/A' ELSE 'avg=' || " + O.number_text("gap_avg", 2)
        + " || ', min=' || gap_min || ', max=' || gap_max || ', n=' || gap_count END",
    )]),
    _rows("log", "l_file LEFT JOIN l_top USING (path)", [
        ("Most frequent errors", "coalesce(message || ' (' || n || ')', '(no critical errors)')")], "coalesce(rank, 0)"),
    _rows("log", "l_file LEFT JOIN l_pat USING (path)", [
        ("Recurring error patterns", "coalesce(pattern || ' (' || n || ')', '(no critical errors)')")], "coalesce(rank, 0)"),
])


def _report(spark: SparkSession, sf: str) -> DataFrame:
    cube = settle(SM.sales_cube(_sales(spark, sf)))
    documents = settle(JM.json_facts(_json(spark, sf)))
    facts = settle(LM.log_facts(_log(spark, sf)))
    messages = LM.facts_messages(facts)
    actions = JM.top_actions(JM.facts_actions(documents))
    csv, json, log = settle(SM.sales_metrics(cube)), settle(JM.json_metrics(documents)), settle(LM.log_metrics(facts))
    levels, hours = LM.facts_by_level(facts), LM.facts_by_hour(facts)
    return (
        P.csv_shown(csv)
        .unionByName(P.json_shown(json, actions))
        .unionByName(P.log_shown(log, levels, hours, LM.top_errors(messages), LM.patterns(messages)))
    )


@register("report_metrics", O.with_ctes(_REPORT, O.SALES, O.SALES_METRICS, O.JSON, O.LOG))
def q_report(spark, sf):
    return _report(spark, sf)


def _line_errors(spark: SparkSession, sf: str) -> DataFrame:
    return SQ.sales_rejects(B.sales_lines(spark, sf)).unionByName(LQ.log_rejects(_log(spark, sf)))


@register("omitted_files", O.with_ctes(f"""
SELECT path, kind, status, coalesce('line ' || line || ': ' || error, 'See the errors section for more details') AS message
FROM ({_STATUS}) LEFT JOIN (
  SELECT path, line, error FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY line) AS rn
    FROM (SELECT * FROM s_reject UNION ALL SELECT * FROM l_reject) WHERE line IS NOT NULL) WHERE rn = 1) USING (path)
WHERE status <> 'ok'""", O.SALES, O.JSON, O.LOG))
def q_omitted(spark, sf):
    return P.omitted_files(_statuses(spark, sf), _line_errors(spark, sf))


@register("error_list", O.with_ctes("""
SELECT path, error FROM s_reject WHERE line IS NULL
UNION ALL SELECT path, error FROM j_docs WHERE error IS NOT NULL
UNION ALL SELECT path, 'partial: line ' || line || ': ' || error FROM s_reject JOIN s_status USING (path)
  WHERE status = 'partial'
UNION ALL SELECT path, 'partial: line ' || line || ': ' || error FROM l_reject JOIN l_status USING (path)
  WHERE status = 'partial'""", O.SALES, O.JSON, O.LOG))
def q_errors(spark, sf):
    sales = SQ.sales_rejects(B.sales_lines(spark, sf))
    whole = sales.where("line IS NULL").select("path", "error").unionByName(JQ.json_errors(_json(spark, sf)))
    listed = P.error_list(_statuses(spark, sf), sales.unionByName(LQ.log_rejects(_log(spark, sf))), whole)
    return listed.select("path", "error")


@register("level_distribution_text", O.with_ctes(f"SELECT path, text FROM {_LEVELS}", O.LOG))
def q_level_text(spark, sf):
    return P.distribution(LM.by_level(_entries(spark, sf)), "level")


# --- scalar functions ------------------------------------------------------------------------

_NORMAL = r"trim(regexp_replace(regexp_replace({0}, '\d+', '<num>', 'g'), '[\t\n\x0B\f\r ]+', ' ', 'g'))"


@register("normalize_message", f"""
SELECT doc_id AS id, {_NORMAL.format('text')} AS pattern FROM documents
UNION ALL SELECT page_id, {_NORMAL.format('html')} FROM pages""")
def q_normalize(spark, sf):
    docs = B.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    pages = B.table(spark, sf, "pages").select("page_id", "html")
    return docs.union(pages).select("id", text.normalize_message(F.col("text")).alias("pattern"))


@register("path_parts", r"""
SELECT page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') AS base,
  regexp_replace(rtrim(url, '/'), '/[^/]*$', '') AS dir,
  regexp_extract(regexp_extract(rtrim(url, '/'), '[^/]*$'), '^.+?(\.[^.]*)$', 1) AS ext FROM pages""")
def q_path_parts(spark, sf):
    url = F.col("url")
    return B.table(spark, sf, "pages").select(
        "page_id", text.base_name(url).alias("base"), text.dir_name(url).alias("dir"), text.extension(url).alias("ext")
    )


@register("report_text_metrics", """
SELECT o_orderkey AS id,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey END AS BIGINT) AS processed_files,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey % 7 END AS BIGINT) AS csv_files,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey % 5 END AS BIGINT) AS json_files,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey % 3 END AS BIGINT) AS log_files,
  CASE WHEN o_orderkey % 9 = 0 THEN 0.0 ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS processing_time,
  CASE WHEN o_orderkey % 9 = 0 THEN 0.0 ELSE o_custkey % 100 + 0.5::DOUBLE END AS success_rate
FROM orders""")
def q_report_text(spark, sf):
    return P.text_metrics(B.report_texts(spark, sf))


# --- sinks and history ---------------------------------------------------------------------------

@register("sink_rejects", O.with_ctes("""
SELECT 'csv' AS run_id, path, line, error FROM s_reject UNION ALL SELECT 'log', path, line, error FROM l_reject""",
    O.SALES, O.LOG))
def q_sink_rejects(spark, sf):
    folder = new_folder(spark, "rejects")
    K.write_rejects(SQ.sales_rejects(B.sales_lines(spark, sf)), folder, "csv")
    K.write_rejects(LQ.log_rejects(_log(spark, sf)), folder, "log")
    return spark.read.parquet(folder).select("run_id", "path", "line", "error")


@register("sink_metrics", O.with_ctes(_REPORT, O.SALES, O.SALES_METRICS, O.JSON, O.LOG))
def q_sink_metrics(spark, sf):
    folder = new_folder(spark, "metrics")
    K.write_metrics(_report(spark, sf), folder)
    return spark.read.parquet(folder)


_COMPLETE = "mode IS NOT NULL AND success_rate IS NOT NULL AND has_data"
_RUN = "id, mode, total_files, success_rate, execution_time_ms, inserted_at"


def _history(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "history")
    H.append(B.history_rows(spark, sf), folder)
    return H.read(spark, folder)


@register("history_append", O.with_ctes(f"SELECT {_RUN} FROM h_runs WHERE {_COMPLETE}", O.HISTORY))
def q_append(spark, sf):
    return _history(spark, sf).drop("data")


@register("history_list", O.with_ctes(
    f"SELECT {_RUN} FROM h_runs WHERE {_COMPLETE} ORDER BY inserted_at DESC, id DESC", O.HISTORY))
def q_list(spark, sf):
    return H.newest_first(_history(spark, sf)).drop("data")


@register("history_get", O.with_ctes(
    f"SELECT {_RUN} FROM h_runs WHERE {_COMPLETE} AND id IN (SELECT doc_id FROM labels)", O.HISTORY))
def q_get(spark, sf):
    ids = B.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return H.get_runs(_history(spark, sf), ids).drop("data")


@register("history_expand", O.with_ctes(
    f"SELECT id, directory, total, status FROM h_runs WHERE {_COMPLETE}", O.HISTORY))
def q_expand(spark, sf):
    return H.expand(_history(spark, sf), {
        "directory": "$.directory:string", "total": "$.counts.total:bigint", "status": "$.counts.status:string"})


@register("result_to_json", O.with_ctes("""
SELECT CAST(to_json(struct_pack(path := path, actions := actions, hours := hours)) AS VARCHAR) AS json FROM (
  SELECT path, list_sort(list(DISTINCT action)) AS actions FROM j_a GROUP BY path) JOIN (
  SELECT path, [min(hour), max(hour)] AS hours FROM j_s WHERE hour IS NOT NULL GROUP BY path) USING (path)""", O.JSON))
def q_to_json(spark, sf):
    facts = JM.json_facts(_json(spark, sf)).where("kind IN ('action', 'hour') AND key IS NOT NULL")
    # A set and a range per document, from facts that are already distinct.
    hour = F.when(F.col("kind") == "hour", F.col("key").cast("int"))
    results = facts.groupBy("path").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "action", F.col("key")))).alias("actions"),
        F.array(F.min(hour), F.max(hour)).alias("hours"),
    )
    return K.to_json_rows(results.where("hours[0] IS NOT NULL"))
