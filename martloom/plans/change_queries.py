"""Registered queries: table-change operators, refreshes and stream ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import change
from martloom.operators.dedup import merge_keep_last
from martloom.operators.refresh import full_refresh, reconcile_columns, refresh_result
from martloom.plans.inputs import (
    CHANGED, CHANGED_NULLS, CLEAN_SHEET, LINE_SEQ, LINES, NEW, SHEET, STAGING_SQL, TARGET, TARGET_NULLS,
    WINDOW, ctes, staging,
)
from martloom.plans.suite import Tables, query
from martloom.sources import loads
from martloom.sources.file_table import FileTable
from martloom.sources.publish import VersionedTable
from martloom.sources.tables import (
    load_days, load_many, load_table, load_totals, merge_partitions, write_partitioned,
)
from martloom.streaming.ingest import ingest_files, ingest_once, ingest_partitioned

REPLACED = """
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL BY NAME SELECT * FROM s"""


@query("upsert_positional", ctes(
    t=TARGET_NULLS,
    s=f"{CHANGED_NULLS.sql} UNION ALL {NEW.sql} UNION ALL {NEW.sql} AND o_orderstatus = 'F'",
) + REPLACED)
def upsert_positional(t: Tables) -> DataFrame:
    """NULL keys on both sides, and part of the staging rows twice."""
    new = NEW.spark(t)
    rows = CHANGED_NULLS.spark(t).union(new).union(new.where("o_orderstatus = 'F'"))
    unnamed = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return change.replace_by_position(TARGET_NULLS.spark(t), unnamed, ["o_orderkey"])


@query("upsert_by_name", ctes(
    t=TARGET,
    s=f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM ({STAGING_SQL})",
) + REPLACED)
def upsert_by_name(t: Tables) -> DataFrame:
    """Staging lacks a target column, has one of its own, and orders columns differently."""
    rows = staging(t).withColumn("loaded_from", F.lit("drop"))
    rows = rows.select(*reversed([c for c in rows.columns if c != "o_orderpriority"]))
    return change.replace_by_name(TARGET.spark(t), rows, ["o_orderkey"])


@query("upsert_mapped", ctes(
    t=TARGET,
    s=f"""SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice, o_orderdate,
          CAST(NULL AS VARCHAR) AS o_orderpriority FROM ({STAGING_SQL})""",
) + REPLACED)
def upsert_mapped(t: Tables) -> DataFrame:
    rows = staging(t).select(
        F.col("o_orderkey").alias("Order No"), F.col("o_custkey").alias("Customer"),
        F.col("o_totalprice").alias("Total"), F.col("o_orderdate").alias("Placed"),
        F.col("o_orderstatus").alias("Unused"),
    )
    pairs = {
        "Order No": "o_orderkey", "Customer": "o_custkey", "Total": "o_totalprice",
        "Placed": "o_orderdate", "Unused": "not_a_column", "Gone": "o_orderpriority",
    }
    return change.replace_mapped(TARGET.spark(t), rows, ["o_orderkey"], pairs)


_GROUP = ["o_custkey", "o_orderstatus"]
_GROUP_DELETED = """
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE s.o_custkey = t.o_custkey AND s.o_orderstatus = t.o_orderstatus)"""


@query("business_key_delete", ctes(t=TARGET, s=STAGING_SQL) + _GROUP_DELETED)
def business_key_delete(t: Tables) -> DataFrame:
    return change.delete_groups(TARGET.spark(t), staging(t), _GROUP)


@query("load_business_key", ctes(
    t0=TARGET, s=STAGING_SQL, t=_GROUP_DELETED.replace("FROM t ", "FROM t0 t "),
) + REPLACED)
def load_business_key(t: Tables) -> DataFrame:
    """Loaded into a published table: group delete, keyed replace, one switch."""
    table = VersionedTable(t.spark, t.scratch())
    table.publish(TARGET.spark(t))
    outcome = load_table(table, staging(t), ["o_orderkey"], _GROUP, include_counts=False)
    if not outcome["success"]:
        raise RuntimeError(outcome["message"])
    return table.read()


@query("load_keyed_files", ctes(
    t0=TARGET, s=STAGING_SQL, t=_GROUP_DELETED.replace("FROM t ", "FROM t0 t "),
) + REPLACED)
def load_keyed_files(t: Tables) -> DataFrame:
    """The same load into a file table: only the files that may hold a key or a group are
    rewritten."""
    table = FileTable(t.spark, t.scratch(), (("o_orderkey",), tuple(_GROUP)))
    table.publish(TARGET.spark(t))
    outcome = loads.load_keyed(table, staging(t), ["o_orderkey"], _GROUP)
    if not outcome["success"]:
        raise RuntimeError(outcome["message"])
    return table.read()


@query("upsert_partial_update", ctes(t=TARGET, s=STAGING_SQL) + """
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey""")
def upsert_partial_update(t: Tables) -> DataFrame:
    return change.update_or_insert(TARGET.spark(t), staging(t), ["o_orderkey"], ["o_totalprice"])


@query("merge_single_key", ctes(t=TARGET, s=STAGING_SQL) + REPLACED)
def merge_single_key(t: Tables) -> DataFrame:
    return change.merge_on_key(TARGET.spark(t), staging(t), "o_orderkey")


@query("append_move", ctes(t=TARGET, s=STAGING_SQL) + "SELECT * FROM t UNION ALL SELECT * FROM s")
def append_move(t: Tables) -> DataFrame:
    return change.append_rows(TARGET.spark(t), staging(t))


@query("slice_replace", ctes(t=TARGET, s=CHANGED) + f"""
SELECT * FROM t WHERE COALESCE(NOT ({WINDOW}), true) UNION ALL SELECT * FROM s""")
def slice_replace(t: Tables) -> DataFrame:
    return change.replace_slice(TARGET.spark(t), F.expr(WINDOW), CHANGED.spark(t))


@query("upsert_stats", ctes(t=TARGET_NULLS, s=f"{CHANGED_NULLS.sql} UNION ALL {NEW.sql}") + """
SELECT (SELECT COUNT(*) FROM s) AS staging_count,
       (SELECT COUNT(*) FROM t WHERE o_orderkey IN (SELECT o_orderkey FROM s WHERE o_orderkey IS NOT NULL)) AS deleted_count,
       (SELECT COUNT(*) FROM s) AS inserted_count""")
def upsert_stats(t: Tables) -> DataFrame:
    rows = CHANGED_NULLS.spark(t).union(NEW.spark(t))
    return change.change_counts(TARGET_NULLS.spark(t), rows, ["o_orderkey"])


@query("multi_load_summary", ctes(s=CHANGED, n=NEW) + """
SELECT CAST(2 AS BIGINT) AS loaded_files, CAST(1 AS BIGINT) AS failed_files,
       CAST((SELECT COUNT(*) FROM s) + (SELECT COUNT(*) FROM n) AS BIGINT) AS inserted_rows""")
def multi_load_summary(t: Tables) -> DataFrame:
    """Two good drops and one missing drop."""
    root = t.scratch()
    table = VersionedTable(t.spark, f"{root}/table")
    table.publish(TARGET.spark(t))
    CHANGED.spark(t).write.parquet(f"{root}/changed")
    NEW.spark(t).write.parquet(f"{root}/new")
    paths = [f"{root}/changed", f"{root}/missing", f"{root}/new"]
    return load_totals(load_many(t.spark, table, paths, ["o_orderkey"]))


@query("multi_load_files", ctes(
    t=TARGET, s=f"{STAGING_SQL}",
) + REPLACED)
def multi_load_files(t: Tables) -> DataFrame:
    """Two good drops, a missing and a misfitting one, loaded with one rewrite of the table."""
    root = t.scratch()
    table = FileTable(t.spark, f"{root}/table", (("o_orderkey",),))
    table.publish(TARGET.spark(t))
    CHANGED.spark(t).write.parquet(f"{root}/changed")
    NEW.spark(t).write.parquet(f"{root}/new")
    t.customer.select(F.col("c_name").alias("o_orderkey")).write.parquet(f"{root}/other")
    paths = [f"{root}/{name}" for name in ("changed", "missing", "other", "new")]
    outcome = loads.load_many_files(table, paths, ["o_orderkey"])
    if outcome.where("ok").count() != 2 or table.version() != 2:
        raise RuntimeError("expected two drops in one version")
    return table.read()


_READY = "o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'P'"


@query("load_by_day", ctes(
    t=TARGET, drop_rows=STAGING_SQL,
    judged=f"""SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n_rows, bool_and({_READY}) AS ok
      FROM drop_rows GROUP BY 1""",
    s="SELECT d.* FROM drop_rows d JOIN judged ON day = CAST(o_orderdate AS DATE) WHERE ok",
    loaded=REPLACED,
    after="SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS table_rows FROM loaded GROUP BY 1",
) + """
SELECT j.day, n_rows, ok, CASE WHEN NOT ok THEN 'urgent order pending' END AS error,
       COALESCE(table_rows, 0) AS table_rows
FROM judged j LEFT JOIN after a ON a.day = j.day""")
def load_by_day(t: Tables) -> DataFrame:
    """Days with a pending urgent order are left out; each day with its rows in the table after."""
    table = VersionedTable(t.spark, t.scratch())
    table.publish(TARGET.spark(t))
    day = F.col("o_orderdate").cast("date")
    checks = {"urgent order pending": F.expr(_READY)}
    outcomes = load_days(table, staging(t), day, ["o_orderkey"], checks)
    after = table.read().groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("table_rows"))
    rows = F.coalesce("table_rows", F.lit(0).cast("bigint")).alias("table_rows")
    return outcomes.join(after, "day", "left").select("day", "n_rows", "ok", "error", rows)


# --- partition merge and dedup -------------------------------------------------------------------

_PART = "l_returnflag"
_KEYS = ["l_orderkey", "l_linenumber"]
# Existing rows shipped before 1999; incoming rows since then, for two of the three flags.
_OLD = "l_shipdate < TIMESTAMP '1999-01-01 00:00:00'"
_NEW = "l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' AND l_returnflag <> 'N'"
_LAST = ", ".join(f"{c} DESC" for c in [*LINE_SEQ, "l_linestatus"])


def _merged_sql(part: str, keys: str) -> str:
    return f"""
SELECT * EXCLUDE (rn, origin) FROM (
  SELECT *, row_number() OVER (PARTITION BY {part}{keys} ORDER BY origin DESC, {_LAST}) AS rn
  FROM both_rows) WHERE rn = 1"""


_BOTH = f"""SELECT *, 0 AS origin FROM ({LINES.sql}) WHERE {_OLD}
UNION ALL SELECT *, 1 FROM ({LINES.sql}) WHERE {_NEW}"""


# The last row per partition and key, by ``arg_max``; the incoming rows outrank the old ones.
_LAST_OF = f"""
SELECT arg_max(r, ({', '.join(['origin', *LINE_SEQ, 'l_linestatus'])})) AS r FROM (
  SELECT l AS r, l.*, 0 AS origin FROM ({LINES.sql}) l WHERE {_OLD}
  UNION ALL SELECT l AS r, l.*, 1 FROM ({LINES.sql}) l WHERE {_NEW})
GROUP BY {_PART}, {', '.join(_KEYS)}"""
_TOUCHED = f"l_returnflag IN (SELECT DISTINCT l_returnflag FROM ({LINES.sql}) WHERE {_NEW})"


@query("partition_merge_dedup", f"SELECT * FROM (SELECT unnest(r) FROM ({_LAST_OF})) WHERE {_TOUCHED}")
def partition_merge_dedup(t: Tables) -> DataFrame:
    lines = LINES.spark(t)
    return merge_keep_last(
        lines.where(_OLD), lines.where(_NEW), _KEYS, [*LINE_SEQ, "l_linestatus"], partition_by=[_PART]
    )


# Untouched partitions keep their rows as they are, repeated keys among them.
_MERGED_WHOLE = f"""
SELECT * FROM (SELECT unnest(r) FROM ({_LAST_OF})) WHERE {_TOUCHED}
UNION ALL BY NAME SELECT * FROM ({LINES.sql}) WHERE {_OLD} AND NOT {_TOUCHED}"""


@query("partition_merge_write", _MERGED_WHOLE)
def partition_merge_write(t: Tables) -> DataFrame:
    """Merged into a partitioned dataset, touched partitions replaced."""
    path, lines = t.scratch(), LINES.spark(t)
    write_partitioned(lines.where(_OLD), path, [_PART])
    merge_partitions(t.spark, lines.where(_NEW), path, [_PART], _KEYS, [*LINE_SEQ, "l_linestatus"])
    return t.spark.read.schema(lines.schema).parquet(path).select(*lines.columns)


@query("partition_merge_files", _MERGED_WHOLE)
def partition_merge_files(t: Tables) -> DataFrame:
    """Merged into a file table: one record makes all touched partitions current."""
    lines = LINES.spark(t)
    table = FileTable(t.spark, t.scratch(), ((_PART,),))
    table.publish(lines.where(_OLD))
    loads.merge_in_table(table, lines.where(_NEW), [_PART], _KEYS, [*LINE_SEQ, "l_linestatus"])
    return table.read()


@query("merge_dedup", ctes(both_rows=_BOTH) + f"""
SELECT * EXCLUDE (rn, origin) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(_KEYS)}
                               ORDER BY origin DESC, {_LAST}, l_returnflag DESC) AS rn
  FROM both_rows) WHERE rn = 1""")
def merge_dedup(t: Tables) -> DataFrame:
    lines = LINES.spark(t)
    seq = [*LINE_SEQ, "l_linestatus", "l_returnflag"]
    return merge_keep_last(lines.where(_OLD), lines.where(_NEW), _KEYS, seq)


# --- refresh -----------------------------------------------------------------------------------


@query("full_refresh", ctes(sheet=CLEAN_SHEET) + """
SELECT TRY_CAST(TRY_CAST(NULLIF(trim(Whole_No), '') AS DOUBLE) AS BIGINT) AS Whole_No,
       TRY_CAST(NULLIF(trim(Amount), '') AS DOUBLE) AS Amount,
       CASE lower(trim(Is_Open)) WHEN 'true' THEN true WHEN 'false' THEN false END AS Is_Open,
       TRY_CAST(NULLIF(trim(Order_Date), '') AS TIMESTAMP) AS Order_Date, Note,
       CAST(NULL AS VARCHAR) AS Unused, 'run-2' AS run_id FROM sheet""")
def full_refresh_query(t: Tables) -> DataFrame:
    """Refreshed twice: a first sheet with another column set, then the sheet."""
    table = VersionedTable(t.spark, t.scratch())
    sheet = CLEAN_SHEET.spark(t)
    full_refresh(table, sheet.select(F.col("Note"), F.lit("x").alias("Old Column")), "run-1")
    full_refresh(table, sheet.toDF(*[c.replace("_", " ") for c in sheet.columns]), "run-2")
    full_refresh(table, sheet.limit(0), "run-3")
    return table.read()


@query("reconcile_columns", ctes(sheet=SHEET) + """
SELECT CAST(row_no AS VARCHAR) AS row_no, TRY_CAST(amount AS DOUBLE) AS amount, flag, note FROM sheet""")
def reconcile(t: Tables) -> DataFrame:
    """The table has row_no as text, amount as number and a column that the sheet lost."""
    sheet = SHEET.spark(t).select("note", "row_no", "flag", "amount")
    table = t.spark.createDataFrame([], "row_no string, gone int, amount double").schema
    return reconcile_columns(sheet, table)


@query("mv_refresh", """
SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, COUNT(*) AS n
FROM orders GROUP BY o_orderstatus""")
def mv_refresh(t: Tables) -> DataFrame:
    """Refreshed with a new definition: the stored result follows the current one."""
    table = VersionedTable(t.spark, t.scratch())
    refresh_result(table, lambda: t.orders.groupBy("o_orderstatus").count())
    value = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value")
    refresh_result(
        table, lambda: t.orders.groupBy("o_orderstatus").agg(value, F.count(F.lit(1)).alias("n"))
    )
    return table.read()


@query("stream_upsert", ctes(t=TARGET, s=STAGING_SQL) + REPLACED)
def stream_upsert(t: Tables) -> DataFrame:
    """Two drops arrive one after the other; the second call loads only the new drop."""
    root = t.scratch()
    table = VersionedTable(t.spark, f"{root}/table")
    schema = TARGET.spark(t).schema

    def arrive(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{root}/drops")
        ingest_files(t.spark, f"{root}/drops", schema, table, ["o_orderkey"], f"{root}/checkpoint")

    arrive(TARGET.spark(t))
    arrive(staging(t))
    return table.read()


@query("stream_upsert_partitioned", ctes(
    t=TARGET, s=f"{CHANGED.sql} UNION ALL {NEW.sql}",
) + REPLACED)
def stream_upsert_partitioned(t: Tables) -> DataFrame:
    """The same drops into a table partitioned by order status: the keys keep their partition."""
    root = t.scratch()
    schema = TARGET.spark(t).schema

    def arrive(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{root}/drops")
        ingest_partitioned(
            t.spark, f"{root}/drops", schema, f"{root}/table", ["o_orderstatus"], ["o_orderkey"],
            f"{root}/checkpoint",
        )

    arrive(TARGET.spark(t))
    arrive(staging(t))
    return t.spark.read.schema(schema).parquet(f"{root}/table").select(*schema.fieldNames())


@query("stream_upsert_once", ctes(t=TARGET, s=STAGING_SQL) + REPLACED)
def stream_upsert_once(t: Tables) -> DataFrame:
    """Drops into a file table; the last batch is then run again, as after a failure."""
    root = t.scratch()
    table = FileTable(t.spark, f"{root}/table", (("o_orderkey",),))
    schema = TARGET.spark(t).schema

    def arrive(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{root}/drops")
        ingest_once(t.spark, f"{root}/drops", schema, table, ["o_orderkey"], f"{root}/checkpoint")

    arrive(TARGET.spark(t))
    arrive(staging(t))
    loads.load_keyed(table, staging(t), ["o_orderkey"], batch=(f"{root}/checkpoint", 1))
    return table.read()
