"""The driver's tables rendered as the file contents the operators read.

Files are cut by row number, so each has a bounded number of lines and their
count grows with the tables: nothing here collects an unbounded group, and
line numbers come from the row number without a window. A fixed part of the
files carries faults, spread over the lines by row number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.schemas import SALES_HEADER
from tallyfold.session import prepare

LINES_PER_CSV = 2000
LINES_PER_LOG = 500
EVENTS_PER_DOC = 500
USERS_PER_DOC = 75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for a table with fewer splits than cores, by a unique key.

    A table that large scans cut into enough splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


# --- sales ------------------------------------------------------------------

# Fault of a data line by number; expressions over the clean text fields.
_SALES_FAULTS = {
    "date": {2: "'2024-13-01'", 11: "'2024-2-03'", 15: "'yesterday'"},
    "product": {5: "concat(product, '\"')", 14: "concat('\"', product, '\"')"},
    "price": {1: "concat('-', price)", 6: "'ERROR'", 10: "concat(' ', price)"},
    "quantity": {0: "'abc'", 7: "'0'", 12: "'3.5'", 15: "'many'"},
    "discount": {4: "'150.00'", 8: "'x'"},
}


def _faulty(name: str) -> str:
    cases = " ".join(f"WHEN fault = {n} THEN {text}" for n, text in _SALES_FAULTS[name].items())
    return f"CASE {cases} ELSE {name} END AS {name}"


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sale with its file and line, still without faults."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate",
        F.col("_metadata.row_index").alias("ri"),
        # A table of several files numbers rows in each of them.
        F.replace(F.col("_metadata.file_name"), F.lit("lineitem.parquet"), F.lit("")).alias("source"),
    )
    items = spread(items, "ri")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    n = LINES_PER_CSV
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        f"concat('sales_', source, ri div {n}, '.csv') AS path",
        f"ri div {n} AS k",
        f"ri % {n} + 2 AS line",
        "ri",
        "cast(cast(l_shipdate AS date) AS string) AS date",
        "p_name AS product",
        "p_type AS category",
        "cast(cast(l_extendedprice AS decimal(12,2)) AS string) AS price",
        "cast(cast(l_quantity AS bigint) AS string) AS quantity",
        "cast(cast(cast(l_discount AS decimal(4,2)) * 100 AS decimal(6,2)) AS string) AS discount",
    )


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, line, value`` with header lines and faults."""
    quoted = ",".join(f'"{c}"' for c in SALES_HEADER.split(","))
    rows = sales_rows(spark, sf_dir).selectExpr(
        "*",
        "CASE WHEN k % 10 = 5 AND line = 77 THEN -2 WHEN ri % 19 IN (5, 14) OR k % 3 = 2 THEN ri % 19 ELSE -1 END"
        " AS fault",
    )
    fields = rows.selectExpr(
        "path", "k", "line", "fault", *[_faulty(c) for c in ("date", "product", "price", "quantity", "discount")],
        "CASE WHEN fault = -2 THEN concat(category, '\"') ELSE category END AS category",
    )
    text = fields.selectExpr(
        "path", "k", "line",
        """CASE fault
             WHEN 3 THEN concat_ws(',', date, product, category, price, quantity)
             WHEN 9 THEN ''
             WHEN 13 THEN concat_ws(',', date, product, category, price, quantity, discount, 'extra')
             ELSE concat_ws(',', date, product, category, price, quantity, discount)
           END AS value""",
    )
    ended = text.selectExpr("path", "k", "line", "concat(value, CASE WHEN k % 10 = 1 THEN '\r' ELSE '' END) AS value")
    header = f"""CASE k % 10 WHEN 7 THEN 'fecha;producto' WHEN 3 THEN '{quoted}'
                 WHEN 1 THEN '{SALES_HEADER}\r' ELSE '{SALES_HEADER}' END"""
    return ended.selectExpr(
        "path",
        f"""inline(CASE WHEN line = 2
              THEN array(named_struct('line', 1L, 'value', {header}), named_struct('line', line, 'value', value))
              ELSE array(named_struct('line', line, 'value', value)) END)""",
    )


# --- logs -------------------------------------------------------------------

def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, line, value``; event ids are dense, so they number the lines."""
    n = LINES_PER_LOG
    rows = spread(table(spark, sf_dir, "events"), "event_id").selectExpr(
        f"concat('app_', event_id div {n}, '.log') AS path",
        f"event_id % {n} + 1 AS line",
        f"CASE WHEN (event_id div {n}) % 9 = 7 THEN 0 WHEN (event_id div {n}) % 4 = 3 THEN event_id % 17 ELSE -1 END AS fault",
        "CASE WHEN event_id % 29 = 0 THEN '  ' ELSE ' ' END AS gap",
        "date_format(ts, 'yyyy-MM-dd') AS day",
        "date_format(ts, 'HH:mm:ss') AS time",
        # Some files have no critical entry, some no entry at all.
        f"""CASE WHEN (event_id div {n}) % 6 = 4 THEN 'INFO' ELSE CASE event_type WHEN 'view' THEN 'INFO'
             WHEN 'click' THEN 'DEBUG' WHEN 'signup' THEN 'WARN' WHEN 'error' THEN 'ERROR' ELSE 'FATAL' END END AS level""",
        "concat('c', user_id % 7) AS component",
        """CASE event_type
             WHEN 'error' THEN concat('timeout', CASE WHEN event_id % 3 = 0 THEN '  ' ELSE ' ' END,
                                      'after ', user_id % 5, ' s')
             WHEN 'purchase' THEN concat('order ', event_id, ' charged ', cast(value AS decimal(10,2)))
             ELSE concat('value ', cast(value AS decimal(10,2)), ' ', props) END AS message""",
    )
    return rows.selectExpr(
        "path", "line",
        """CASE fault
             WHEN 0 THEN concat(day, gap, time, ' [', lower(level), '] [', component, '] ', message)
             WHEN 1 THEN concat(day, gap, '25', substring(time, 3), ' [', level, '] [', component, '] ', message)
             WHEN 2 THEN '   '
             WHEN 3 THEN concat(day, gap, time, ' [', level, '] [] ', message)
             WHEN 4 THEN concat(day, gap, time, ' [', level, '] [', component, ']')
             ELSE concat(day, gap, time, ' [', level, '] [', component, '] ', message) END AS value""",
    )


# --- documents --------------------------------------------------------------

def json_sessions_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and stretch of events, at most ``EVENTS_PER_DOC`` events each."""
    n = EVENTS_PER_DOC
    rows = table(spark, sf_dir, "events").selectExpr(
        f"event_id div {n} AS k", "user_id", "event_id", "event_type",
        "unix_seconds(cast(ts AS timestamp)) AS at",
    )
    return rows.groupBy("k", "user_id").agg(
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda e: e["event_type"]
        ).alias("acciones"),
    )


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, content``: a bounded stretch of users and sessions per document."""
    sessions = json_sessions_source(spark, sf_dir).selectExpr(
        "k",
        """named_struct(
             'usuario_id', user_id,
             'inicio', CASE user_id % 11
                WHEN 0 THEN date_format(timestamp_seconds(first_at), "yyyy-MM-dd'T'HH:mm:ss")
                WHEN 1 THEN date_format(timestamp_seconds(first_at + 7200), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
                ELSE date_format(timestamp_seconds(first_at), "yyyy-MM-dd'T'HH:mm:ss'Z'") END,
             'duracion_segundos', CASE user_id % 7 WHEN 0 THEN NULL WHEN 1 THEN first_at - last_at
                ELSE last_at - first_at END,
             'paginas_visitadas', CASE WHEN user_id % 5 = 0 THEN NULL ELSE views END,
             'acciones', acciones) AS s""",
    ).groupBy("k").agg(F.array_sort(F.collect_list("s")).alias("sesiones"))
    users = table(spark, sf_dir, "customer").selectExpr(
        f"c_custkey div {USERS_PER_DOC} AS k",
        """named_struct('id', c_custkey, 'nombre', c_name,
             'activo', CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal > 0 END) AS u""",
    ).groupBy("k").agg(F.array_sort(F.collect_list("u")).alias("usuarios"))
    text = users.join(sessions, "k", "full").selectExpr(
        "k",
        # Some documents lack a list, some have an empty one.
        """to_json(named_struct('timestamp', '2024-02-29T12:00:00Z',
             'usuarios', CASE k % 15 WHEN 2 THEN NULL WHEN 6 THEN slice(usuarios, 1, 0) ELSE usuarios END,
             'sesiones', CASE k % 15 WHEN 3 THEN NULL WHEN 7 THEN slice(sesiones, 1, 0) ELSE sesiones END)) AS doc""",
    )
    return text.selectExpr(
        "concat('users_', k, '.json') AS path",
        """CASE k % 15
             WHEN 4 THEN left(doc, length(doc) - 1)
             WHEN 9 THEN concat('[', doc, ']')
             WHEN 11 THEN concat(doc, '\n // end')
             WHEN 14 THEN replace(doc, '"activo":true', '"activo":"si"')
             ELSE doc END AS content""",
    )


# --- run history and requests -------------------------------------------------

def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order; every 23rd misses a required field."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderkey % 23 = 1 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'parallel' ELSE 'sequential' END AS mode",
        "cast(o_custkey % 40 + 1 AS int) AS total_files",
        "CASE WHEN o_orderkey % 23 = 2 THEN NULL ELSE 100.0D * (o_custkey % 5) / 4 END AS success_rate",
        "o_totalprice AS execution_time_ms",
        """CASE WHEN o_orderkey % 23 = 3 THEN NULL ELSE to_json(named_struct(
             'directory', o_orderpriority, 'counts', named_struct('total', o_custkey % 40 + 1, 'status', o_orderstatus)))
           END AS data""",
        "cast(o_orderdate AS timestamp_ntz) AS inserted_at",
    )


def report_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary text per order; some without its numbers."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        """CASE WHEN o_orderkey % 9 = 0 THEN o_orderpriority ELSE concat(
             'EXECUTIVE SUMMARY\nTotal files processed: ', o_custkey,
             '\n  - CSV files: ', o_custkey % 7, '\n  - JSON files: ', o_custkey % 5,
             '\n  - LOG files: ', o_custkey % 3, '\n\nTotal processing time: ',
             cast(o_totalprice AS decimal(12,2)), ' seconds\nSuccess rate: ', o_custkey % 100, '.5%\n') END AS content""",
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of one file per document, some listed twice: ``path, bytes``."""
    rows = table(spark, sf_dir, "documents").selectExpr(
        """concat('/lake/', lang, '/', source, '/', doc_id, CASE doc_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.json'
             WHEN 2 THEN '.log' WHEN 3 THEN '.CSV' WHEN 4 THEN '.tar.log' ELSE '' END) AS path""",
        "n_chars AS bytes",
        "doc_id",
    )
    return rows.selectExpr("explode(array_repeat(path, CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END)) AS path", "bytes")


def requested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for every labelled document's file or folder, and for pages that are no files."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    files = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS d",
        """concat('/lake/', lang, '/', source, '/', doc_id, CASE doc_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.json'
             WHEN 2 THEN '.log' WHEN 3 THEN '.CSV' WHEN 4 THEN '.tar.log' ELSE '' END) AS path""",
        "concat('/lake/', lang, '/', source) AS folder",
    )
    joined = labels.join(files, F.col("doc_id") == F.col("d")).selectExpr(
        "CASE WHEN quality = 1 THEN path ELSE folder END AS input"
    )
    pages = table(spark, sf_dir, "pages").selectExpr(
        "CASE WHEN page_id % 2 = 0 THEN concat('/lost/', page_id, '.csv') ELSE concat('/lost/', page_id) END AS input"
    )
    return joined.unionByName(pages)
