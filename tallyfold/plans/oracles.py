"""The bindings in DuckDB SQL: typed rows with the verdict each one must get.

The SQL never parses a rendered line; it starts from the typed tables and the
fault a line was given, so equal results prove the reading of the lines.
"""

from __future__ import annotations

SALES = """
s_src AS (SELECT *, row_number() OVER () - 1 AS ri FROM lineitem),
s_base AS (
  SELECT ri, ri // 2000 AS k, ri % 2000 + 2 AS line, 'sales_' || (ri // 2000) || '.csv' AS path,
         CAST(l_shipdate AS DATE) AS dt, p_name AS product, p_type AS category,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS BIGINT) AS qty,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(6,2)) AS disc,
         CASE WHEN (ri // 2000) % 10 = 5 AND ri % 2000 + 2 = 77 THEN -2
              WHEN ri % 19 IN (5, 14) OR (ri // 2000) % 3 = 2 THEN ri % 19 ELSE -1 END AS fault
  FROM s_src JOIN part ON l_partkey = p_partkey),
s_err AS (
  SELECT *, CAST(price AS DOUBLE) * qty * (1 - CAST(disc AS DOUBLE) / 100) AS net,
    CASE WHEN fault IN (3, 9, 13) THEN 'Row must have 6 columns'
         WHEN fault IN (2, 11, 15) THEN 'Invalid date format (expected YYYY-MM-DD)'
         WHEN fault IN (6, 10) THEN 'Invalid unit price'
         WHEN fault IN (0, 12) THEN 'Invalid quantity'
         WHEN fault = 8 THEN 'Invalid discount'
         WHEN fault = 1 THEN 'Unit price must be positive'
         WHEN fault = 7 THEN 'Quantity must be positive'
         WHEN fault = 4 THEN 'Discount must be between 0 and 100'
         WHEN fault = -2 THEN 'CSV parse error: unexpected quote character' END AS error
  FROM s_base),
s_file AS (
  SELECT path, k % 10 = 7 AS bad_header, bool_or(fault = -2) AS bad_quote,
         k % 10 = 7 OR bool_or(fault = -2) AS failed,
         count(*) FILTER (error IS NULL) AS n_valid, count(*) FILTER (error IS NOT NULL) AS n_reject
  FROM s_err GROUP BY path, k),
s_status AS (
  SELECT path, 'csv' AS kind, CASE WHEN failed OR (n_valid = 0 AND n_reject > 0) THEN 'failed'
         WHEN n_reject > 0 THEN 'partial' ELSE 'ok' END AS status FROM s_file),
s_valid AS (SELECT e.* FROM s_err e JOIN s_file f USING (path) WHERE e.error IS NULL AND NOT f.failed),
s_reject AS (
  SELECT e.path, CAST(e.line AS BIGINT) AS line, e.error FROM s_err e JOIN s_file f USING (path)
  WHERE e.error IS NOT NULL AND NOT f.failed
  UNION ALL SELECT path, CASE WHEN bad_quote THEN NULL ELSE CAST(1 AS BIGINT) END,
         CASE WHEN bad_quote THEN 'CSV parse error: unexpected quote character' ELSE 'Invalid CSV header' END
  FROM s_file WHERE failed),
s_fields AS (
  SELECT *, CASE fault WHEN 2 THEN '2024-13-01' WHEN 11 THEN '2024-2-03' WHEN 15 THEN 'yesterday'
                ELSE CAST(dt AS VARCHAR) END AS f_date,
         CASE fault WHEN 5 THEN product || '"' WHEN 14 THEN '"' || product || '"' ELSE product END AS f_product,
         CASE fault WHEN -2 THEN category || '"' ELSE category END AS f_category,
         CASE fault WHEN 1 THEN '-' || price WHEN 6 THEN 'ERROR' WHEN 10 THEN ' ' || price
                ELSE CAST(price AS VARCHAR) END AS f_price,
         CASE fault WHEN 0 THEN 'abc' WHEN 7 THEN '0' WHEN 12 THEN '3.5' WHEN 15 THEN 'many'
                ELSE CAST(qty AS VARCHAR) END AS f_qty,
         CASE fault WHEN 4 THEN '150.00' WHEN 8 THEN 'x' ELSE CAST(disc AS VARCHAR) END AS f_disc
  FROM s_err),
s_text AS (
  SELECT path, CAST(line AS BIGINT) AS line,
    CASE fault WHEN 9 THEN ''
      WHEN 3 THEN concat_ws(',', f_date, f_product, f_category, f_price, f_qty)
      WHEN 13 THEN concat_ws(',', f_date, f_product, f_category, f_price, f_qty, f_disc, 'extra')
      ELSE concat_ws(',', f_date, f_product, f_category, f_price, f_qty, f_disc) END
    || CASE WHEN k % 10 = 1 THEN chr(13) ELSE '' END AS value
  FROM s_fields
  UNION ALL
  SELECT DISTINCT path, CAST(1 AS BIGINT), CASE k % 10 WHEN 7 THEN 'fecha;producto'
    WHEN 3 THEN '"fecha","producto","categoria","precio_unitario","cantidad","descuento"'
    WHEN 1 THEN 'fecha,producto,categoria,precio_unitario,cantidad,descuento' || chr(13)
    ELSE 'fecha,producto,categoria,precio_unitario,cantidad,descuento' END
  FROM s_err)
"""

LOG = """
l_base AS (
  SELECT 'app_' || (event_id // 500) || '.log' AS path, CAST(event_id % 500 + 1 AS BIGINT) AS line,
         CASE WHEN (event_id // 500) % 9 = 7 THEN 0 WHEN (event_id // 500) % 4 = 3 THEN event_id % 17 ELSE -1 END AS fault,
         CASE WHEN event_id % 29 = 0 THEN '  ' ELSE ' ' END AS gap,
         date_trunc('second', ts) AS ts,
         CASE WHEN (event_id // 500) % 6 = 4 THEN 'INFO' WHEN event_type = 'view' THEN 'INFO'
              WHEN event_type = 'click' THEN 'DEBUG' WHEN event_type = 'signup' THEN 'WARN'
              WHEN event_type = 'error' THEN 'ERROR' ELSE 'FATAL' END AS level,
         'c' || (user_id % 7) AS component,
         CASE event_type
           WHEN 'error' THEN 'timeout' || CASE WHEN event_id % 3 = 0 THEN '  ' ELSE ' ' END || 'after ' || (user_id % 5) || ' s'
           WHEN 'purchase' THEN 'order ' || event_id || ' charged ' || CAST(value AS DECIMAL(10,2))
           ELSE 'value ' || CAST(value AS DECIMAL(10,2)) || ' ' || props END AS message,
         CASE event_type
           WHEN 'error' THEN 'timeout after <num> s' ELSE 'order <num> charged <num>.<num>' END AS pattern
  FROM events),
l_err AS (
  SELECT *, CASE WHEN fault IN (0, 3, 4) THEN 'Invalid log format' WHEN fault = 1 THEN 'Invalid timestamp' END AS error,
         fault = 2 AS blank FROM l_base),
l_valid AS (SELECT * FROM l_err WHERE error IS NULL AND NOT blank),
l_crit AS (SELECT * FROM l_valid WHERE level IN ('FATAL', 'ERROR')),
l_reject AS (SELECT path, line, error FROM l_err WHERE error IS NOT NULL),
l_file AS (
  SELECT path, count(*) FILTER (error IS NULL AND NOT blank) AS n_valid, count(*) FILTER (error IS NOT NULL) AS n_reject
  FROM l_err GROUP BY path),
l_status AS (
  SELECT path, 'log' AS kind, CASE WHEN n_valid = 0 AND n_reject > 0 THEN 'failed'
         WHEN n_reject > 0 THEN 'partial' ELSE 'ok' END AS status FROM l_file),
l_text AS (
  SELECT path, line, CASE WHEN blank THEN '   ' ELSE
      strftime(ts, '%Y-%m-%d') || gap || CASE WHEN fault = 1 THEN '25' || substr(strftime(ts, '%H:%M:%S'), 3)
        ELSE strftime(ts, '%H:%M:%S') END
      || ' [' || CASE WHEN fault = 0 THEN lower(level) ELSE level END || '] ['
      || CASE WHEN fault = 3 THEN '' ELSE component END || ']'
      || CASE WHEN fault = 4 THEN '' ELSE ' ' || message END END AS value
  FROM l_err),
l_level AS (SELECT path, level, count(*) AS n FROM l_valid GROUP BY ALL),
l_hour AS (SELECT path, CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM l_valid GROUP BY ALL),
l_comp AS (
  SELECT path, component, n FROM (SELECT path, component, count(*) AS n,
    row_number() OVER (PARTITION BY path ORDER BY count(*) DESC, component) AS rn FROM l_crit GROUP BY path, component)
  WHERE rn = 1),
l_top AS (
  SELECT * FROM (SELECT path, message, count(*) AS n,
    CAST(row_number() OVER (PARTITION BY path ORDER BY count(*) DESC, message) AS INT) AS rank
    FROM l_crit GROUP BY path, message) WHERE rank <= 5),
l_pat AS (
  SELECT path, pattern, n, rank FROM (SELECT path, pattern, count(*) AS n, max(count(*)) OVER (PARTITION BY path) AS m,
    CAST(row_number() OVER (PARTITION BY path ORDER BY count(*) DESC, pattern) AS INT) AS rank
    FROM l_crit GROUP BY path, pattern)
  WHERE (m >= 2 AND n >= 2 AND rank <= 5) OR (m < 2 AND rank = 1)),
l_step AS (
  SELECT path, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY path ORDER BY ts)) AS step FROM l_crit),
l_gap AS (
  SELECT path, CAST(count(step) AS BIGINT) AS gap_count, coalesce(sum(step) / count(step), 0.0) AS gap_avg,
         CAST(min(step) AS BIGINT) AS gap_min, CAST(max(step) AS BIGINT) AS gap_max
  FROM l_step GROUP BY path)
"""

JSON_TEXT = """
t_user AS (
  SELECT k, string_agg('{"id":' || id || ',"nombre":"' || name || '"'
    || CASE WHEN active IS NULL THEN '' WHEN active THEN ',"activo":true' ELSE ',"activo":false' END || '}',
    ',' ORDER BY id) AS users FROM j_users GROUP BY k),
t_act AS (
  SELECT k, user_id, '[' || string_agg('"' || event_type || '"', ',' ORDER BY event_id) || ']' AS actions
  FROM j_events GROUP BY k, user_id),
t_sess AS (
  SELECT k, string_agg('{"usuario_id":' || user_id || ',"inicio":"' || start || '"'
    || CASE user_id % 7 WHEN 0 THEN '' WHEN 1 THEN ',"duracion_segundos":' || (first_at - last_at)
         ELSE ',"duracion_segundos":' || (last_at - first_at) END
    || CASE WHEN user_id % 5 = 0 THEN '' ELSE ',"paginas_visitadas":' || views END
    || ',"acciones":' || actions || '}', ',' ORDER BY user_id) AS sessions
  FROM (SELECT *, CASE user_id % 11 WHEN 0 THEN strftime(make_timestamp(first_at * 1000000), '%Y-%m-%dT%H:%M:%S')
      WHEN 1 THEN strftime(make_timestamp((first_at + 7200) * 1000000), '%Y-%m-%dT%H:%M:%S+02:00')
      ELSE strftime(make_timestamp(first_at * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS start FROM j_sess)
  JOIN t_act USING (k, user_id) GROUP BY k),
t_doc AS (
  SELECT k, '{"timestamp":"2024-02-29T12:00:00Z"' || coalesce(',"usuarios":[' || users || ']', '')
    || coalesce(',"sesiones":[' || sessions || ']', '') || '}' AS doc
  FROM (SELECT k, CASE k % 15 WHEN 2 THEN NULL WHEN 6 THEN left(users, 0) ELSE users END AS users,
          CASE k % 15 WHEN 3 THEN NULL WHEN 7 THEN left(sessions, 0) ELSE sessions END AS sessions
        FROM t_user FULL JOIN t_sess USING (k))),
t_text AS (
  SELECT 'users_' || k || '.json' AS path, CASE k % 15 WHEN 4 THEN left(doc, length(doc) - 1)
    WHEN 9 THEN '[' || doc || ']' WHEN 11 THEN doc || chr(10) || ' // end'
    WHEN 14 THEN replace(doc, '"activo":true', '"activo":"si"') ELSE doc END AS content
  FROM t_doc)
"""

JSON = """
j_users AS (
  SELECT c_custkey // 75 AS k, c_custkey AS id, c_name AS name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal > 0 END AS active FROM customer),
j_events AS (
  SELECT event_id // 500 AS k, user_id, event_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
j_sess AS (
  SELECT k, user_id, min(sec) AS first_at, max(sec) AS last_at, count(*) FILTER (event_type = 'view') AS views
  FROM j_events GROUP BY k, user_id),
j_docs AS (
  SELECT k, 'users_' || k || '.json' AS path,
    CASE WHEN k % 15 IN (4, 11) THEN 'JSON decode error: malformed document'
         WHEN k % 15 = 9 THEN 'JSON root must be an object'
         WHEN k % 15 = 14 AND k IN (SELECT k FROM j_users WHERE active) THEN 'type violation: activo' END AS error
  FROM (SELECT k FROM j_users UNION SELECT k FROM j_sess)),
j_status AS (SELECT path, 'json' AS kind, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status FROM j_docs),
j_u AS (
  SELECT path, id, name, coalesce(active, false) AS active FROM j_users JOIN j_docs USING (k)
  WHERE error IS NULL AND k % 15 NOT IN (2, 6)),
j_s AS (
  SELECT path, k, user_id,
    CASE WHEN user_id % 7 IN (0, 1) THEN 0.0 ELSE CAST(last_at - first_at AS DOUBLE) END AS seconds,
    CASE WHEN user_id % 5 = 0 THEN 0.0 ELSE CAST(views AS DOUBLE) END AS pages,
    CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST((first_at // 3600) % 24 AS INT) END AS hour,
    CASE user_id % 11 WHEN 0 THEN strftime(make_timestamp(first_at * 1000000), '%Y-%m-%dT%H:%M:%S')
      WHEN 1 THEN strftime(make_timestamp((first_at + 7200) * 1000000), '%Y-%m-%dT%H:%M:%S+02:00')
      ELSE strftime(make_timestamp(first_at * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS start
  FROM j_sess JOIN j_docs USING (k) WHERE error IS NULL AND k % 15 NOT IN (3, 7)),
j_a AS (
  SELECT path, event_type AS action FROM j_events JOIN j_docs USING (k) WHERE error IS NULL AND k % 15 NOT IN (3, 7)),
j_uc AS (
  SELECT path, count(*) AS total_users, count(*) FILTER (active) AS active_users,
         count(*) FILTER (NOT active) AS inactive_users FROM j_u GROUP BY path),
j_sc AS (SELECT path, avg(seconds) AS avg_session_seconds, sum(pages) AS total_pages FROM j_s GROUP BY path),
j_top AS (
  SELECT * FROM (SELECT path, action, count(*) AS n,
    CAST(row_number() OVER (PARTITION BY path ORDER BY count(*) DESC, action) AS INT) AS rank
    FROM j_a GROUP BY path, action) WHERE rank <= 5),
j_peak AS (
  SELECT path, hour AS peak_hour, n AS peak_sessions FROM (SELECT path, hour, count(*) AS n,
    row_number() OVER (PARTITION BY path ORDER BY count(*) DESC, hour) AS rn
    FROM j_s WHERE hour IS NOT NULL GROUP BY path, hour) WHERE rn = 1)
"""

SALES_METRICS = """
m_sum AS (
  SELECT path, sum(net) AS total_sales, count(DISTINCT product) AS unique_products, avg(CAST(disc AS DOUBLE)) AS disc,
         min(dt) AS date_from, max(dt) AS date_to FROM s_valid GROUP BY path),
m_prod AS (
  SELECT path, product, v FROM (SELECT path, product, CAST(sum(qty) AS BIGINT) AS v,
    row_number() OVER (PARTITION BY path ORDER BY sum(qty) DESC, product) AS rn FROM s_valid GROUP BY path, product)
  WHERE rn = 1),
m_cat AS (
  SELECT path, category, v FROM (SELECT path, category, sum(net) AS v,
    row_number() OVER (PARTITION BY path ORDER BY sum(net) DESC, category) AS rn FROM s_valid GROUP BY path, category)
  WHERE rn = 1)
"""

HISTORY = """
h_runs AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 23 = 1 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'parallel' ELSE 'sequential' END AS mode,
    CAST(o_custkey % 40 + 1 AS INT) AS total_files,
    CASE WHEN o_orderkey % 23 = 2 THEN NULL ELSE 100.0::DOUBLE * (o_custkey % 5) / 4 END AS success_rate,
    o_totalprice AS execution_time_ms, o_orderkey % 23 <> 3 AS has_data,
    o_orderpriority AS directory, CAST(o_custkey % 40 + 1 AS BIGINT) AS total, o_orderstatus AS status,
    o_orderdate AS inserted_at FROM orders)
"""

FILES = """
f_paths AS (
  SELECT doc_id, '/lake/' || lang || '/' || source AS folder,
    '/lake/' || lang || '/' || source || '/' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.json'
      WHEN 2 THEN '.log' WHEN 3 THEN '.CSV' WHEN 4 THEN '.tar.log' ELSE '' END AS path,
    doc_id % 6 IN (0, 1, 2, 4) AS supported, n_chars AS bytes FROM documents)
"""


def with_ctes(query: str, *families: str) -> str:
    """``query`` may add its own CTEs when it starts with a comma."""
    return f"WITH {', '.join(f.strip() for f in families)} {query.strip()}"


def number_text(value: str, digits: int) -> str:
    """SQL of a rounded number without needless zeros but one decimal."""
    fixed = f"CAST(CAST(round({value}, {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"
    return f"regexp_replace({fixed}, '(\\.\\d+?)0+$', '\\1')"
