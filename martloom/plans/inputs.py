"""Inputs the registered queries derive from the driver's tables.

Each is a list of SQL expressions that mean the same in Spark and in the checking engine, so both
sides start from equal rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.plans.suite import Tables


@dataclass(frozen=True)
class Derived:
    table: str
    columns: tuple[str, ...]
    where: str | None = None

    def spark(self, t: Tables) -> DataFrame:
        df = getattr(t, self.table)
        return (df.where(self.where) if self.where else df).selectExpr(*self.columns)

    @property
    def sql(self) -> str:
        tail = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {', '.join(self.columns)} FROM {self.table}{tail}"


def ctes(**parts: object) -> str:
    """``WITH name AS (...), ...`` from derived inputs or SQL texts."""
    texts = {n: (p.sql if isinstance(p, Derived) else p) for n, p in parts.items()}
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in texts.items()) + "\n"


# --- target and staging ----------------------------------------------------------------------

# Orders of the latest load window come again repriced; the same orders also come under new keys.
WINDOW = "o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'"
ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)
NULLED_KEY = (
    "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_orderkey END"
    " AS o_orderkey"
)

TARGET = Derived("orders", ORDER_COLUMNS)
TARGET_NULLS = Derived("orders", (NULLED_KEY, *ORDER_COLUMNS[1:]))
CHANGED = Derived(
    "orders",
    ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice + 1 AS o_totalprice",
     "o_orderdate", "o_orderpriority"),
    WINDOW,
)
CHANGED_NULLS = Derived("orders", (NULLED_KEY, *CHANGED.columns[1:]), WINDOW)
NEW = Derived("orders", ("-1 - o_orderkey AS o_orderkey", *ORDER_COLUMNS[1:]), WINDOW)


def staging(t: Tables) -> DataFrame:
    return CHANGED.spark(t).unionByName(NEW.spark(t))


STAGING_SQL = f"{CHANGED.sql} UNION ALL {NEW.sql}"

# --- line items with an explicit sequence ------------------------------------------------------

LINES = Derived(
    "lineitem",
    ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
     "l_quantity", "l_extendedprice", "l_shipdate"),
)
LINE_SEQ = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]

# --- cost snapshots ----------------------------------------------------------------------------


def snapshots(t: Tables) -> DataFrame:
    """Six dated costs per part at half-year steps, starting in a month that depends on the part;
    brand 7 has none, some costs are unset, promo parts have a second update on each day."""
    parts = t.part.where("p_brand <> 'Brand#7'").select(
        "p_partkey", "p_type", "p_retailprice", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")
    )
    day = F.add_months(F.lit("1996-01-01").cast("date"), F.col("p_partkey") % 24 + 6 * F.col("i"))
    cost = (F.col("p_retailprice") + F.col("i")).cast("decimal(18,2)")
    first = parts.select(
        "p_partkey",
        day.alias("valuationdate"),
        F.when(~((F.col("p_type") == "ECONOMY") & (F.col("i") == 2)), cost).alias("cost"),
        F.col("i").alias("updated"),
    )
    again = parts.where("p_type = 'PROMO'").select(
        "p_partkey",
        day.alias("valuationdate"),
        (cost + F.lit("0.50").cast("decimal(18,2)")).cast("decimal(18,2)").alias("cost"),
        F.when(F.col("i") != 3, F.col("i") + 10).alias("updated"),
    )
    return first.unionByName(again)


_SNAP_DAY = (
    "CAST(DATE '1996-01-01' + to_months(CAST(p_partkey % 24 + 6 * i AS INTEGER)) AS DATE)"
)
SNAPSHOTS_SQL = f"""
SELECT p_partkey, {_SNAP_DAY} AS valuationdate,
       CASE WHEN p_type = 'ECONOMY' AND i = 2 THEN NULL
            ELSE CAST(p_retailprice + i AS DECIMAL(18,2)) END AS cost,
       i AS updated
FROM part, range(6) r(i) WHERE p_brand <> 'Brand#7'
UNION ALL
SELECT p_partkey, {_SNAP_DAY}, CAST(CAST(p_retailprice + i AS DECIMAL(18,2)) + 0.50 AS DECIMAL(18,2)),
       CASE WHEN i <> 3 THEN i + 10 END
FROM part, range(6) r(i) WHERE p_brand <> 'Brand#7' AND p_type = 'PROMO'
"""


def nearest_sql(probe: str, snaps: str, key: str, date: str, values: Sequence[str]) -> str:
    """The nearest-date lookup as two as-of joins: backward, and forward where that finds nothing."""
    packed = ", ".join(f"'{v}': CAST({v} AS DOUBLE)" for v in values)
    chosen = ", ".join(
        f"CASE WHEN b.valuationdate IS NOT NULL THEN b.picked.{v} ELSE f.picked.{v} END AS {v}"
        for v in values
    )
    newest = f"""(SELECT {key}, valuationdate, arg_max({{{packed}}}, COALESCE(updated, 2147483647)) AS picked
  FROM {snaps} GROUP BY {key}, valuationdate)"""
    return f"""
SELECT p.{key}, p.{date}, COALESCE(b.valuationdate, f.valuationdate) AS snapshot_day, {chosen}
FROM {probe} p
ASOF LEFT JOIN {newest} b ON b.{key} = p.{key} AND p.{date} >= b.valuationdate
ASOF LEFT JOIN {newest} f ON f.{key} = p.{key} AND p.{date} <= f.valuationdate
WHERE COALESCE(b.valuationdate, f.valuationdate) IS NOT NULL
"""


# --- worksheet with dirty cells ------------------------------------------------------------------

AMOUNT_TEXT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
DAY_TEXT = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
SHEET = Derived(
    "orders",
    (
        "o_orderkey AS row_no",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' "
        "WHEN o_orderkey % 11 = 0 THEN ' - ' WHEN o_orderkey % 13 = 0 THEN 'N/A' "
        "WHEN o_orderkey % 17 = 0 THEN ' #Ref ! ' WHEN o_orderkey % 23 = 0 THEN chr(9) || 'NA' || chr(10) "
        "WHEN o_orderkey % 29 = 0 THEN '#N/A' || chr(160) WHEN o_orderkey % 31 = 0 THEN chr(160) "
        f"ELSE {AMOUNT_TEXT} END AS amount",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'true' "
        "WHEN o_orderkey % 5 = 1 THEN 'True' WHEN o_orderkey % 5 = 2 THEN 'TRUE' "
        "WHEN o_orderkey % 5 = 3 THEN 'no' ELSE '0' END AS flag",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 6 = 0 THEN '12' "
        "WHEN o_orderkey % 6 = 1 THEN '12.7' WHEN o_orderkey % 6 = 2 THEN '13.5' "
        "WHEN o_orderkey % 6 = 3 THEN 'abc' WHEN o_orderkey % 6 = 4 THEN '7' "
        "ELSE '' END AS qty",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL "
        "WHEN o_orderkey % 4 = 0 THEN CAST(34700 + o_orderkey % 2400 AS STRING) "
        "WHEN o_orderkey % 4 = 1 THEN CAST(34700 + o_orderkey % 2400 AS STRING) || '.5' "
        f"WHEN o_orderkey % 4 = 2 THEN {DAY_TEXT} "
        "WHEN o_orderkey % 8 = 3 THEN '1970-01-01' WHEN o_orderkey % 16 = 7 THEN '9999-12-31' "
        "ELSE 'soon' END AS order_date",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'nan' "
        "ELSE o_orderpriority END AS note",
        "CAST(NULL AS STRING) AS unused",
    ),
)
# Clean text columns, blank in places, for inference.
CLEAN_SHEET = Derived(
    "orders",
    (
        "CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE CAST(o_orderkey AS STRING) END AS Whole_No",
        f"CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE {AMOUNT_TEXT} END AS Amount",
        "CASE WHEN o_orderstatus = 'F' THEN 'TRUE' WHEN o_orderstatus = 'P' THEN ' ' "
        "ELSE 'false' END AS Is_Open",
        f"CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {DAY_TEXT} END AS Order_Date",
        "o_orderpriority AS Note",
        "CAST(NULL AS STRING) AS Unused",
    ),
)

# --- events as run ledger and registry -----------------------------------------------------------

# Client, pipeline and status come from the event; a run lasts `value` seconds; error runs fail.
# The signups have not ended yet.
RUNS = Derived(
    "events",
    (
        "event_id AS run_id",
        "event_type AS pipeline_name",
        "user_id % 3 AS client_id",
        "CASE WHEN user_id % 2 = 0 THEN 'orders' ELSE 'returns' END AS data_type",
        "ts AS start_time",
        "CAST(floor(value * 1000000) AS BIGINT) AS run_micros",
        "CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'running' "
        "ELSE 'success' END AS status",
        "CAST(floor(value) AS BIGINT) AS record_count",
    ),
)


def runs(t: Tables) -> DataFrame:
    end = F.timestamp_add("MICROSECOND", F.col("run_micros"), F.col("start_time"))
    ended = F.when(F.col("status") != "running", end)
    return RUNS.spark(t).withColumn("end_time", ended).drop("run_micros")


RUNS_SQL = f"""
SELECT * EXCLUDE (run_micros),
       CASE WHEN status <> 'running' THEN start_time + to_microseconds(run_micros) END AS end_time
FROM ({RUNS.sql})
"""

REGISTRY = Derived(
    "events",
    (
        "user_id % 3 AS client_id",
        "event_type AS data_type",
        "user_id AS source_id",
        "event_id AS run_id",
        "ts AS processed_at",
        "CASE WHEN value >= 5 THEN ts END AS source_updated_at",
        "CASE WHEN value >= 20 THEN props END AS metadata",
        "'drop/' || event_type AS output_location",
    ),
)
