"""Registered queries: incremental windows, freshness, run ledger, registry."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import increments, ledger, registry
from martloom.plans.inputs import REGISTRY, RUNS_SQL, ctes, runs
from martloom.plans.suite import Tables, query

NOW = datetime(2024, 1, 31)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
TODAY = date(2001, 12, 10)
ORDERS_NOW = datetime(2001, 8, 2)

_CURRENT = f"""SELECT DISTINCT ON (client_id, data_type, source_id) * FROM ({REGISTRY.sql})
ORDER BY client_id, data_type, source_id, processed_at DESC, run_id DESC"""


def _loaded(t: Tables, until: str) -> DataFrame:
    seen = REGISTRY.spark(t).where(f"processed_at < TIMESTAMP '{until}'")
    return registry.current_entries(seen).withColumn("is_current", F.lit(True))


@query("hwm_window", ctes(cur=_CURRENT) + f"""
SELECT MAX(source_updated_at) AS window_start,
  CASE WHEN date_diff('second', MAX(source_updated_at), {NOW_SQL}) < 300 THEN MAX(source_updated_at) ELSE {NOW_SQL} END AS window_end,
  CASE WHEN date_diff('second', MAX(source_updated_at), {NOW_SQL}) < 300 THEN 'up to date' ELSE 'update' END AS state
FROM cur""")
def hwm_window(t: Tables) -> DataFrame:
    current = _loaded(t, "2024-01-31 00:00:00")
    return increments.hwm_window(current, NOW, datetime(2024, 1, 1), datetime(2024, 12, 31))


@query("incremental_slice", ctes(
    seen=f"SELECT * FROM ({REGISTRY.sql}) WHERE processed_at < TIMESTAMP '2024-01-15'",
    cur=_CURRENT.replace(f"({REGISTRY.sql})", "seen"),
) + f"""
SELECT event_id, ts, event_type FROM events
WHERE ts > (SELECT MAX(source_updated_at) FROM cur) AND ts <= {NOW_SQL}""")
def incremental_slice(t: Tables) -> DataFrame:
    current = _loaded(t, "2024-01-15 00:00:00")
    window = increments.hwm_window(current, NOW, datetime(2024, 1, 1), datetime(2024, 12, 31))
    return increments.incremental_slice(t.events, "ts", window).select("event_id", "ts", "event_type")


@query("missing_days", """
SELECT CAST(unnest(generate_series(CAST(MAX(l_shipdate) AS DATE) + 1, DATE '2001-12-08', INTERVAL 1 DAY)) AS DATE) AS day
FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def missing_days(t: Tables) -> DataFrame:
    """The newest date over two channels, then day by day up to two days ago."""
    channels = [t.lineitem.where(F.col("l_returnflag") == c) for c in ("A", "R")]
    first, second = [increments.last_loaded(c, "l_shipdate") for c in channels]
    return increments.missing_days(first.unionByName(second), TODAY)


@query("last_loaded_date", """
SELECT CAST(MAX(l_shipdate) AS DATE) AS last_date FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
WHERE p_size = 10""")
def last_loaded_date(t: Tables) -> DataFrame:
    return increments.last_loaded(
        t.lineitem, "l_shipdate", ("p_size", 10), t.part, ("l_partkey", "p_partkey")
    )


@query("backfill_windows", """
WITH b AS (SELECT MIN(o_orderdate) AS start_at, MAX(o_orderdate) AS end_at FROM orders)
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end FROM (
  SELECT unnest(generate_series(start_at, end_at - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS w FROM b)""")
def backfill_windows(t: Tables) -> DataFrame:
    bounds = t.orders.agg(F.min("o_orderdate").alias("start_at"), F.max("o_orderdate").alias("end_at"))
    return increments.backfill_windows(bounds, "1 day")


@query("window_list_slice", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, m AS window_start
FROM lineitem JOIN (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders)
  ON l_shipdate >= m AND l_shipdate < m + INTERVAL 10 DAY""")
def window_list_slice(t: Tables) -> DataFrame:
    """Shipments in the first ten days of every month that has orders."""
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    windows = t.orders.select(month.alias("window_start")).distinct().withColumn(
        "window_end", F.col("window_start") + F.expr("interval 10 days")
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return increments.in_windows(lines, "l_shipdate", windows).drop("window_end")


@query("freshness_check", """
SELECT CAST(MAX(l_shipdate) AS DATE) AS newest, DATE '2001-12-08' AS expected,
       COALESCE(CAST(MAX(l_shipdate) AS DATE) >= DATE '2001-12-08', false) AS is_fresh
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O'""")
def freshness_check(t: Tables) -> DataFrame:
    on = F.col("o_orderkey") == F.col("l_orderkey")
    return increments.freshness(
        t.lineitem, "l_shipdate", "t-2", TODAY,
        where=F.col("o_orderstatus") == "O", joins=[(t.orders, on, "left")],
    )


@query("hour_bucket", """
SELECT date_trunc('hour', ts + INTERVAL 330 MINUTE)::TIMESTAMP AS hour, COUNT(*) AS n FROM events GROUP BY ALL""")
def hour_bucket(t: Tables) -> DataFrame:
    hour = increments.hour_bucket(F.col("ts")).alias("hour")
    return t.events.groupBy(hour).agg(F.count(F.lit(1)).alias("n"))


@query("trailing_months", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-05-02' AND o_orderdate <= TIMESTAMP '2001-08-02'""")
def trailing_months(t: Tables) -> DataFrame:
    return increments.trailing_months(t.orders, "o_orderdate", ORDERS_NOW).select(
        "o_orderkey", "o_orderdate"
    )


# --- run ledger ------------------------------------------------------------------------------------

_SECONDS = "CAST(date_diff('microsecond', start_time, end_time) AS DOUBLE) / 1e6"


@query("runs_recent", ctes(runs=RUNS_SQL) + f"""
SELECT run_id, pipeline_name, client_id, data_type, start_time, end_time, status, record_count,
       {_SECONDS} AS duration_seconds
FROM runs WHERE start_time > {NOW_SQL} - INTERVAL 7 DAY AND status = 'success' AND client_id = 1
ORDER BY start_time DESC, run_id LIMIT 100""")
def runs_recent(t: Tables) -> DataFrame:
    return ledger.runs_recent(runs(t), NOW, days=7, client_id=1, status="success", limit=100)


@query("run_metrics", ctes(runs=RUNS_SQL, stats=f"""
SELECT pipeline_name, client_id, data_type, COUNT(*) AS run_count,
  COUNT(*) FILTER (status = 'success') AS success_count, COUNT(*) FILTER (status = 'failed') AS failure_count,
  CAST(SUM(date_diff('microsecond', start_time, end_time)) AS DOUBLE) / COUNT(*) / 1e6 AS avg_duration_seconds,
  MAX({_SECONDS}) AS max_duration_seconds, MIN({_SECONDS}) AS min_duration_seconds,
  CAST(SUM(record_count) AS BIGINT) AS total_records, AVG(record_count) AS avg_records
FROM runs WHERE start_time > {NOW_SQL} - INTERVAL 30 DAY AND end_time IS NOT NULL GROUP BY ALL""") + """
SELECT *, CAST(success_count AS DOUBLE) / run_count * 100 AS success_rate,
       CAST(total_records AS DOUBLE) / NULLIF(avg_duration_seconds, 0) AS avg_records_per_second FROM stats""")
def run_metrics(t: Tables) -> DataFrame:
    return ledger.run_metrics(runs(t), NOW, days=30)


_STEPS = """SELECT user_id AS run_id, event_id AS step_id, event_type AS step_name, ts AS start_time,
CASE WHEN value < 10 THEN 'failed' ELSE 'success' END AS status FROM events"""


def _steps(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("step_id"),
        F.col("event_type").alias("step_name"), F.col("ts").alias("start_time"),
        F.when(F.col("value") < 10, "failed").otherwise("success").alias("status"),
    )


@query("latest_step", ctes(steps=_STEPS) + """
SELECT DISTINCT ON (run_id) * FROM steps WHERE status = 'success' AND step_name = 'purchase'
ORDER BY run_id, start_time DESC, step_id DESC""")
def latest_step(t: Tables) -> DataFrame:
    return ledger.latest_step(_steps(t), "success", "purchase")


@query("run_steps", ctes(steps=_STEPS) + """
SELECT * FROM steps WHERE run_id = 7 AND status = 'success' ORDER BY start_time, step_id""")
def run_steps(t: Tables) -> DataFrame:
    return ledger.run_steps(_steps(t), 7, status="success")


@query("run_state", ctes(runs=RUNS_SQL) + """
SELECT run_id, start_time, end_time, status, CASE WHEN status <> 'running' THEN record_count END AS record_count,
       CASE WHEN status = 'failed' THEN 'error in ' || pipeline_name END AS error FROM runs""")
def run_state(t: Tables) -> DataFrame:
    """Start and completion entries of every run, folded to its state."""
    opened = runs(t).withColumns({"event_time": F.col("start_time"), "event_seq": F.lit(1)})
    closed = opened.where(F.col("end_time").isNotNull()).withColumns(
        {
            "event_time": F.col("end_time"),
            "event_seq": F.lit(2),
            "error": F.concat(F.lit("error in "), F.col("pipeline_name")),
        }
    )
    entries = ledger.event(opened, "running", [])
    for status, columns in {"success": ["record_count"], "failed": ["record_count", "error"]}.items():
        done = closed.where(F.col("status") == status)
        entries = entries.unionByName(ledger.event(done, status, columns))
    return ledger.run_state(entries)


# --- registry --------------------------------------------------------------------------------------


@query("registry_current", _CURRENT)
def registry_current(t: Tables) -> DataFrame:
    return registry.current_entries(REGISTRY.spark(t))


@query("registry_history", f"""
SELECT * FROM (
  SELECT *, lead(run_id) OVER (PARTITION BY client_id, data_type, source_id ORDER BY processed_at, run_id) AS archived_by_run_id
  FROM ({REGISTRY.sql})) WHERE archived_by_run_id IS NOT NULL""")
def registry_history(t: Tables) -> DataFrame:
    return registry.archived_entries(REGISTRY.spark(t), grain="day")


def _patches(t: Tables) -> DataFrame:
    rows = REGISTRY.spark(t).where("data_type = 'purchase'").withColumn("is_current", F.lit(True))
    first = rows.withColumns(
        {
            "processed_at": F.expr("processed_at + interval 1 hour"),
            "source_updated_at": F.expr("source_updated_at + interval 1 hour"),
            "output_location": F.lit("patched/1"),
        }
    )
    second = rows.where("metadata IS NULL").withColumns(
        {
            "processed_at": F.expr("processed_at + interval 2 hours"),
            "source_updated_at": F.lit(None).cast("timestamp_ntz"),
            "output_location": F.lit("patched/2"),
        }
    )
    new = rows.withColumn("run_id", -1 - F.col("run_id"))
    return first.unionByName(second).unionByName(new)


@query("registry_patch", ctes(base=REGISTRY.sql) + """
SELECT * REPLACE (
    CASE WHEN data_type <> 'purchase' THEN processed_at WHEN metadata IS NULL THEN processed_at + INTERVAL 2 HOUR
         ELSE processed_at + INTERVAL 1 HOUR END AS processed_at,
    CASE WHEN data_type <> 'purchase' THEN output_location WHEN metadata IS NULL THEN 'patched/2' ELSE 'patched/1' END AS output_location,
    CASE WHEN data_type = 'purchase' THEN source_updated_at + INTERVAL 1 HOUR ELSE source_updated_at END AS source_updated_at),
  data_type = 'purchase' AS is_current FROM base
UNION ALL SELECT * REPLACE (-1 - run_id AS run_id), true FROM base WHERE data_type = 'purchase'""")
def registry_patch(t: Tables) -> DataFrame:
    """Patches that overwrite, patches that leave the optional fields, and unknown runs."""
    base = REGISTRY.spark(t).withColumn("is_current", F.lit(False))
    return registry.patch_entries(base, _patches(t))


@query("registry_bulk", ctes(base=REGISTRY.sql) + """
SELECT client_id, data_type, source_id, run_id, output_location,
       COALESCE(source_updated_at, TIMESTAMP '2024-01-31 00:00:00') AS processed_at,
       '{"source":"' || data_type || '","run":' || CAST(run_id AS VARCHAR) || '}' AS metadata, true AS is_current
FROM base""")
def registry_bulk(t: Tables) -> DataFrame:
    """Records with some processing times missing and structured metadata."""
    records = REGISTRY.spark(t).select(
        "client_id", "data_type", "source_id", "run_id", "output_location",
        F.col("source_updated_at").alias("processed_at"),
        F.struct(F.col("data_type").alias("source"), F.col("run_id").alias("run")).alias("metadata"),
    )
    return registry.bulk_rows(records, ["client_id", "data_type", "source_id", "run_id"], NOW)


@query("registry_query", ctes(base=REGISTRY.sql) + """
SELECT * EXCLUDE (metadata), CAST(json_extract_string(metadata, '$.k') AS INTEGER) AS k FROM (
  SELECT * FROM base WHERE data_type = 'click' AND client_id = 2
  ORDER BY processed_at DESC, run_id LIMIT 50 OFFSET 20)""")
def registry_query(t: Tables) -> DataFrame:
    filters = {"data_type": "click", "client_id": 2, "source_id": None, "run_id": None}
    found = registry.query_registry(
        REGISTRY.spark(t), filters, "processed_at", limit=50, offset=20, metadata_schema="k int"
    )
    return found.withColumn("k", F.col("metadata.k")).drop("metadata")
