"""Independent SQL for each registered query, runnable by DuckDB on the
shared parquet tables (views ``events``, ``nation``, ``orders`` ...).

These are written from the query's meaning, straight over the raw rows, and
share no code with the Spark operators: no cells, no two-level sums.
"""

from __future__ import annotations

SILVER = """
silver AS (
  SELECT event_id,
         CAST(ts AS DATE) AS date,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(user_id % 30 AS INTEGER) AS PULocationID,
         CAST(value AS DECIMAL(18,2)) AS total_amount
  FROM events
  WHERE ts IS NOT NULL
)"""

ZONES = """
zones AS (SELECT n_nationkey AS LocationID, n_name AS zone FROM nation)"""

DENORM = """
denorm AS (
  SELECT z.zone, s.date, s.hour, s.total_amount
  FROM silver s JOIN zones z ON s.PULocationID = z.LocationID
)"""

LANDING = """
landing AS (SELECT DISTINCT CONCAT(CAST(date AS VARCHAR), '.parquet') AS file_path FROM silver),
in_ledger AS (
  SELECT DISTINCT CONCAT(CAST(date AS VARCHAR), '.parquet') AS file_path FROM silver
  WHERE date < DATE '2024-01-21'
)"""

LEDGER = """
ledger AS (
  SELECT CONCAT(CAST(user_id AS VARCHAR), '.parquet') AS file_path, event_type AS status, ts
  FROM events
),
last_event AS (
  SELECT file_path, status, ts FROM ledger
  QUALIFY ROW_NUMBER() OVER (
    PARTITION BY file_path
    ORDER BY ts DESC, list_position(['signup', 'view', 'click', 'error', 'purchase'], status) DESC) = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


HOUR_DENORM_SQL = _with(SILVER, ZONES, DENORM) + """
SELECT zone, date, hour, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total_amount
FROM denorm GROUP BY zone, date, hour"""

HOURLY_SQL = _with(SILVER) + """
SELECT hour, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS revenue FROM silver GROUP BY hour"""

# what is stored plus what a batch brings is what all rows give, in whatever order they came
MERGE_SQL = _with(SILVER) + """
SELECT hour, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS revenue
FROM (SELECT hour, total_amount FROM silver WHERE date < DATE '2024-01-16'
      UNION ALL SELECT hour, total_amount FROM silver WHERE date >= DATE '2024-01-16')
GROUP BY hour"""

ROWS_PER_DAY_SQL = """
SELECT CAST(ts AS DATE) AS date, COUNT(*) AS n FROM events WHERE ts IS NOT NULL
GROUP BY CAST(ts AS DATE)"""

SILVER_COLUMNS_SQL = _with(SILVER) + """
SELECT date, hour, PULocationID, total_amount FROM silver"""

SERVING_DENSE_SQL = _with(SILVER) + """
SELECT CAST(h.range AS INTEGER) AS hour, CAST(COALESCE(SUM(total_amount), 0) AS DOUBLE) AS revenue
FROM range(24) h LEFT JOIN silver s ON h.range = s.hour GROUP BY h.range"""

SQL: dict[str, str] = {
    "silver_clean": _with(SILVER) + "SELECT * FROM silver",
    "quarantine_rows": """
SELECT event_id, 'null_pickup' AS reason FROM events
WHERE ts IS NULL OR event_id % 97 = 0""",
    "rows_per_day": ROWS_PER_DAY_SQL,
    "revenue_by_day_hour": _with(SILVER) + """
SELECT date, hour, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS revenue FROM silver GROUP BY date, hour""",
    "hourly_revenue": HOURLY_SQL,
    "hourly_revenue_merge": MERGE_SQL,
    "additive_merge": MERGE_SQL,
    "hour_denorm": HOUR_DENORM_SQL,
    "hour_denorm_export": _with(SILVER, ZONES, DENORM) + """
SELECT zone, strftime(date, '%Y-%m-%d') AS date, hour,
       CAST(CAST(SUM(total_amount) AS DECIMAL(18,2)) AS DOUBLE) AS total_amount
FROM denorm GROUP BY zone, date, hour""",
    "unmatched_zone_revenue": _with(SILVER, ZONES) + """
SELECT PULocationID, COUNT(*) AS n, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total_amount
FROM silver s
WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.LocationID = s.PULocationID)
GROUP BY PULocationID""",
    "total_revenue": _with(SILVER, ZONES, DENORM) + """
SELECT DATE '2024-01-10' AS date, 5 AS hour,
       CAST(COALESCE(SUM(total_amount), 0) AS DOUBLE) AS total_revenue
FROM denorm WHERE date = DATE '2024-01-10' AND hour = 5""",
    "total_revenue_missing": _with(SILVER, ZONES, DENORM) + """
SELECT DATE '2023-12-31' AS date, 5 AS hour,
       CAST(COALESCE(SUM(total_amount), 0) AS DOUBLE) AS total_revenue
FROM denorm WHERE date = DATE '2023-12-31' AND hour = 5""",
    "total_revenue_zone": _with(SILVER, ZONES, DENORM) + """
SELECT zone, CAST(COALESCE(SUM(total_amount), 0) AS DOUBLE) AS total_revenue
FROM denorm WHERE date = DATE '2024-01-10' AND hour = 5 GROUP BY zone""",
    "serving_hourly_dense": SERVING_DENSE_SQL,
    "serving_lookup": _with(SILVER) + """,
per_hour AS (
  SELECT hour, SUM(total_amount) AS rev_sum, COUNT(DISTINCT date) AS n_days
  FROM silver GROUP BY hour
)
SELECT CAST(h.range AS INTEGER) AS hour,
       CAST(COALESCE(p.rev_sum, 0) AS DOUBLE) AS revenue,
       COALESCE(CAST(p.rev_sum AS DOUBLE) / p.n_days, 0.0) AS avg_revenue,
       COALESCE(p.n_days, 0) AS n_days
FROM range(24) h LEFT JOIN per_hour p ON h.range = p.hour
WHERE h.range = 5""",
    "avg_revenue": _with(SILVER) + """
SELECT hour, CAST(SUM(total_amount) AS DOUBLE) / COUNT(DISTINCT date) AS avg_revenue
FROM silver GROUP BY hour""",
    "avg_revenue_running": _with(SILVER) + """,
per_day AS (SELECT date, hour, SUM(total_amount) AS rev, 1 AS one FROM silver GROUP BY date, hour)
SELECT hour, CAST(SUM(rev) AS DOUBLE) / SUM(one) AS avg_revenue FROM per_day GROUP BY hour""",
    "new_files": _with(SILVER, LANDING) + """
SELECT file_path FROM landing l
WHERE NOT EXISTS (SELECT 1 FROM in_ledger k WHERE k.file_path = l.file_path)""",
    "known_files": _with(SILVER, LANDING) + """
SELECT file_path FROM landing l
WHERE EXISTS (SELECT 1 FROM in_ledger k WHERE k.file_path = l.file_path)""",
    "ledger_latest_status": _with(LEDGER) + """
SELECT file_path, status, ts AS last_ts FROM last_event""",
    "ledger_stage_times": _with(LEDGER) + """
SELECT l.file_path, l.status, l.ts AS last_ts, COUNT(*) FILTER (e.status = 'signup') AS attempts,
       MAX(e.ts) FILTER (e.status = 'signup') AS status_signup_ts,
       MAX(e.ts) FILTER (e.status = 'view') AS status_view_ts,
       MAX(e.ts) FILTER (e.status = 'click') AS status_click_ts,
       MAX(e.ts) FILTER (e.status = 'error') AS status_error_ts,
       MAX(e.ts) FILTER (e.status = 'purchase') AS status_purchase_ts
FROM last_event l JOIN ledger e ON e.file_path = l.file_path
GROUP BY l.file_path, l.status, l.ts""",
    "ledger_backlog": _with(LEDGER) + """
SELECT status, COUNT(*) AS n_files FROM last_event WHERE status <> 'purchase' GROUP BY status""",
    "stuck_files": _with(LEDGER) + """,
per_file AS (
  SELECT l.file_path, l.status, l.ts AS last_ts,
         (SELECT COUNT(*) FROM ledger e WHERE e.file_path = l.file_path AND e.status = 'signup') AS attempts
  FROM last_event l
)
SELECT file_path, status, last_ts, attempts FROM per_file
WHERE status <> 'purchase' AND last_ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 60 MINUTE""",
    "month_filter": """
SELECT CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
FROM orders
WHERE o_orderdate IS NOT NULL AND strftime(o_orderdate, '%Y-%m') = '1996-03'
GROUP BY CAST(o_orderdate AS DATE)""",
    "first_n_files": _with(SILVER, LANDING) + """
SELECT file_path FROM landing ORDER BY file_path LIMIT 10""",
    "top_rows": ROWS_PER_DAY_SQL + " ORDER BY date LIMIT 20",
    "grain_cardinality": _with(SILVER) + """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT date) AS n_days, COUNT(DISTINCT hour) AS n_hours,
       COUNT(DISTINCT PULocationID) AS n_zones,
       COUNT(DISTINCT (date, hour, PULocationID)) AS n_cells
FROM silver""",
    "reconcile": _with(SILVER, ZONES) + """,
a AS (SELECT CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(18,2)) AS total_all FROM silver),
m AS (
  SELECT CAST(COALESCE(SUM(s.total_amount), 0) AS DECIMAL(18,2)) AS total_matched
  FROM silver s JOIN zones z ON s.PULocationID = z.LocationID
),
u AS (
  SELECT CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(18,2)) AS total_unmatched FROM silver s
  WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.LocationID = s.PULocationID)
)
SELECT total_all, total_matched, total_unmatched,
       total_all = total_matched + total_unmatched AS balanced
FROM a, m, u""",
    "file_name_parse": _with(SILVER, LANDING) + """
SELECT file_path, CAST(regexp_extract(file_path, '(\\d{4}-\\d{2}-\\d{2})', 1) AS DATE) AS date,
       regexp_extract(file_path, '(\\d{4}-\\d{2})-\\d{2}', 1) AS month
FROM landing""",
}
