"""Registered queries: sources, sinks and table maintenance."""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.validate import catalog_schema, schema_findings
from martloom.plans.inputs import CHANGED, ORDER_COLUMNS, WINDOW
from martloom.plans.suite import Tables, query
from martloom.sources import files, tables
from martloom.sources.file_table import FileTable
from martloom.sources.loads import replace_in_table
from martloom.sources.publish import VersionedTable
from martloom.sources.queries import optional_filter, run_named

NULLED = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority"


def _database(t: Tables) -> str:
    """A fresh catalog database whose tables live in the shared folder."""
    name = f"martloom_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{t.scratch()}'")
    return name


@query("scan_parquet", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def scan_parquet(t: Tables) -> DataFrame:
    return files.read_parquet(t.spark, t.path("orders")).where(WINDOW).select(
        "o_orderkey", "o_totalprice"
    )


@query("csv_ingest", """
SELECT o_orderkey AS order_key, o_totalprice AS total_inr, o_orderdate AS order_date, o_orderpriority AS prio,
       'run-9' AS run_id FROM orders""")
def csv_ingest(t: Tables) -> DataFrame:
    path = t.scratch()
    t.orders.select(
        F.col("o_orderkey").alias("Order Key"),
        F.col("o_totalprice").alias("Total (INR)"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Order-Date"),
        F.col("o_orderpriority").alias("Prio."),
    ).write.option("header", "true").csv(path)
    schema = "`Order Key` bigint, `Total (INR)` double, `Order-Date` string, `Prio.` string"
    return files.read_csv_drop(
        t.spark, path, schema, run_id="run-9", date_columns=["order_date"], date_format="dd/MM/yyyy"
    )


@query("json_records", """
SELECT o_orderkey AS key, o_totalprice AS price FROM orders
UNION ALL SELECT -o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def json_records(t: Tables) -> DataFrame:
    """Response documents with an empty list and a list of one or two records."""
    path = t.scratch()
    one = F.struct(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    two = F.struct((-F.col("o_orderkey")).alias("key"), F.col("o_totalprice").alias("price"))
    records = F.when(F.col("o_orderstatus") == "F", F.array(one, two)).otherwise(F.array(one))
    docs = t.orders.select(
        F.lit("ok").alias("status"), F.slice(records, 1, 0).alias("errors"), records.alias("results")
    )
    docs.write.json(path)
    record = "array<struct<key: bigint, price: double>>"
    schema = f"status string, errors {record}, results {record}"
    return files.read_json_records(t.spark, path, schema, doc_per_line=True)


@query("json_in_order", """
SELECT o_orderkey AS key, o_totalprice AS price FROM orders
UNION ALL SELECT -o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def json_in_order(t: Tables) -> DataFrame:
    """Documents whose first filled list differs in name; a later list, first by name, is passed
    over."""
    path = t.scratch()
    one = F.struct(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    two = F.struct((-F.col("o_orderkey")).alias("key"), F.col("o_totalprice").alias("price"))
    records = F.when(F.col("o_orderstatus") == "F", F.array(one, two)).otherwise(F.array(one))
    none, odd = F.slice(records, 1, 0), F.col("o_orderkey") % 2 == 1
    docs = t.orders.select(
        F.lit("[ok]").alias("status"), none.alias("zero"), F.when(odd, records).alias("results"),
        F.when(~odd, records).alias("orders"), F.array(F.struct(F.lit(0).alias("key"))).alias("also"),
    )
    docs.write.json(path)
    return files.read_json_in_order(t.spark, path, "key bigint, price double", doc_per_line=True)


def _nested_orders(t: Tables) -> DataFrame:
    """Order documents with two items each, written and read as JSON."""
    path = t.scratch()
    half = F.col("o_totalprice") / 2
    items = F.array(
        F.struct(F.lit(1).alias("line"), half.alias("price")),
        F.struct(F.lit(2).alias("line"), (F.col("o_totalprice") - half).alias("price")),
    )
    t.orders.select("o_orderkey", "o_orderstatus", items.alias("items")).write.json(path)
    schema = (
        "o_orderkey bigint, o_orderstatus string, items array<struct<line: int, price: double>>"
    )
    return t.spark.read.schema(schema).json(path)


@query("json_parent", "SELECT o_orderkey, o_orderstatus FROM orders")
def json_parent(t: Tables) -> DataFrame:
    return files.split_items(_nested_orders(t), "o_orderkey")[0]


@query("json_items", """
SELECT o_orderkey AS parent_o_orderkey, 1 AS line, o_totalprice / 2 AS price FROM orders
UNION ALL SELECT o_orderkey, 2, o_totalprice - o_totalprice / 2 FROM orders""")
def json_items(t: Tables) -> DataFrame:
    return files.split_items(_nested_orders(t), "o_orderkey")[1]


@query("external_scan", "SELECT o_orderkey, o_orderstatus FROM orders")
def external_scan(t: Tables) -> DataFrame:
    """A wildcard over the drop folder with declared columns."""
    schema = "o_orderkey bigint, o_orderstatus string"
    return files.read_parquet(t.spark, t.sf_dir, schema, glob="order*.parquet")


TEXTS = {
    "orders_since": """
        SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM martloom_orders
        WHERE o_orderstatus = :status AND o_orderdate >= :since""",
}


@query("param_query", """
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1999-01-01'""")
def param_query(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("martloom_orders")
    params = {"status": "O", "since": date(1999, 1, 1)}
    return run_named(t.spark, TEXTS, "orders_since", params)


@query("optional_filters", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 100000""")
def optional_filters(t: Tables) -> DataFrame:
    status, priority, minimum = None, "1-URGENT", 100000
    rules = [
        (status, F.col("o_orderstatus") == status),
        (priority, F.col("o_orderpriority") == priority),
        (minimum, F.col("o_totalprice") >= minimum),
    ]
    return optional_filter(t.orders, rules).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("file_listing", """
SELECT o_orderstatus, true AS has_files, true AS has_bytes FROM orders GROUP BY o_orderstatus""")
def file_listing(t: Tables) -> DataFrame:
    """The files of a partitioned copy, counted per partition folder."""
    path = t.scratch()
    tables.write_partitioned(t.orders, path, ["o_orderstatus"])
    listed = files.list_files(t.spark, path, ".parquet")
    status = F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("o_orderstatus")
    return listed.groupBy(status).agg(
        (F.count("path") > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes")
    )


@query("zip_json", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def zip_json(t: Tables) -> DataFrame:
    """Every batch of orders is zipped as a JSON list, then unpacked and typed again."""

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("drop.json", json.dumps(batch.to_dict("records")))
            yield pd.DataFrame({"content": [buffer.getvalue()]})

    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return files.unzip_records(rows.mapInPandas(zipped, "content binary"), rows.schema)


@query("date_layout", """
SELECT event_id, year(ts + INTERVAL 330 MINUTE)::INTEGER AS year, month(ts + INTERVAL 330 MINUTE)::INTEGER AS month,
       day(ts + INTERVAL 330 MINUTE)::INTEGER AS day FROM events""")
def date_layout(t: Tables) -> DataFrame:
    """Written and read below year=/month=/day= of the business zone."""
    path = t.scratch()
    dated = files.with_date_layout(t.events.select("event_id", "ts"), "ts").drop("ts")
    tables.write_partitioned(dated, path, ["year", "month", "day"])
    return t.spark.read.parquet(path)


# --- sinks ---------------------------------------------------------------------------------------


@query("write_roundtrip", "SELECT * FROM orders")
def write_roundtrip(t: Tables) -> DataFrame:
    path = t.scratch()
    tables.write_parquet(t.customer, path, codec="zstd")
    tables.write_parquet(t.orders, path, codec="gzip", overwrite=True)
    return t.spark.read.parquet(path)


@query("write_partitioned", f"SELECT o_orderkey, o_totalprice, o_orderstatus, {NULLED} FROM orders")
def write_partitioned(t: Tables) -> DataFrame:
    path = t.scratch()
    rows = t.orders.selectExpr("o_orderkey", "o_totalprice", "o_orderstatus", NULLED)
    tables.write_partitioned(rows, path, ["o_orderstatus", "o_orderpriority"])
    return t.spark.read.parquet(path)


@query("partition_replace", """
SELECT * FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderpriority < '3')
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderpriority < '3'""")
def partition_replace(t: Tables) -> DataFrame:
    """Two of five partitions are replaced by repriced rows."""
    path = t.scratch()
    tables.write_partitioned(t.orders, path, ["o_orderpriority"])
    changed = CHANGED.spark(t).where("o_orderpriority < '3'")
    tables.replace_partitions(changed, path, ["o_orderpriority"])
    return t.spark.read.schema(t.orders.schema).parquet(path).select(*ORDER_COLUMNS)


@query("partition_replace_files", """
SELECT * FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderpriority < '3')
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderpriority < '3'""")
def partition_replace_files(t: Tables) -> DataFrame:
    """The same partitions of a file table, replaced together."""
    table = FileTable(t.spark, t.scratch(), (("o_orderpriority",),))
    table.publish(t.orders)
    replace_in_table(table, CHANGED.spark(t).where("o_orderpriority < '3'"), ["o_orderpriority"])
    return table.read()


@query("insert_modes", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def insert_modes(t: Tables) -> DataFrame:
    name = f"{_database(t)}.orders_copy"
    rows = t.orders.select("o_orderkey", "o_totalprice")
    tables.insert_into(rows, name, "fail")
    tables.insert_into(rows, name, "replace")
    tables.insert_into(rows, name, "append")
    return t.spark.table(name)


@query("export_query", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def export_query(t: Tables) -> DataFrame:
    """Exported as compressed CSV and read back."""
    path = t.scratch()
    t.orders.createOrReplaceTempView("martloom_orders")
    tables.export(
        t.spark,
        "SELECT o_orderkey, o_orderstatus, o_totalprice FROM martloom_orders WHERE o_orderstatus = 'F'",
        path, "csv", codec="gzip", options={"header": "true"},
    )
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    return t.spark.read.option("header", "true").schema(schema).csv(path)


@query("import_files", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def import_files(t: Tables) -> DataFrame:
    """A JSON drop and a Parquet drop loaded into one table."""
    path, name = t.scratch(), f"{_database(t)}.imported"
    rows = t.orders.select("o_orderkey", "o_totalprice")
    tables.export(t.spark, rows, f"{path}/json", "json")
    tables.export(t.spark, rows, f"{path}/parquet")
    tables.import_files(t.spark, f"{path}/json", name, "json", schema=rows.schema)
    tables.import_files(t.spark, f"{path}/parquet", name)
    return t.spark.table(name)


@query("table_like", "SELECT o_orderkey, o_totalprice FROM orders")
def table_like(t: Tables) -> DataFrame:
    """An empty table made like another one, then filled."""
    database = _database(t)
    rows = t.orders.select("o_orderkey", "o_totalprice")
    tables.create_from(rows, f"{database}.first_copy")
    tables.create_like(t.spark, f"{database}.first_copy", f"{database}.second_copy")
    rows.write.insertInto(f"{database}.second_copy")
    return t.spark.table(f"{database}.second_copy")


_SPARK_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END"""


@query("table_columns", f"""
SELECT CAST(ordinal_position AS INTEGER) AS ordinal, lower(column_name) AS column_name, {_SPARK_TYPE} AS data_type
FROM information_schema.columns WHERE table_name = 'orders'""")
def table_columns(t: Tables) -> DataFrame:
    name = f"{_database(t)}.orders_layout"
    tables.create_from(t.orders, name)
    return tables.table_columns(t.spark, name)


@query("catalog_schema", f"""
SELECT column_name, {_SPARK_TYPE} AS data_type, true AS nullable
FROM information_schema.columns WHERE table_name = 'orders'""")
def catalog_schema_query(t: Tables) -> DataFrame:
    name = f"{_database(t)}.orders_layout"
    tables.create_from(t.orders, name)
    declared = catalog_schema(t.spark, name)
    rows = [(c, spec["type"], spec["nullable"]) for c, spec in declared.items()]
    return t.spark.createDataFrame(rows, "column_name string, data_type string, nullable boolean")


@query("schema_validate", """
SELECT * FROM (VALUES ('o_orderpriority', 'missing in file', NULL, 'string', false),
  ('o_totalprice', 'type differs', 'string', 'double', true),
  ('loaded_from', 'extra in file', 'string', NULL, false),
  ('year', 'missing in file', NULL, 'int', false),
  ('batch', 'missing in file', NULL, 'string', true))
  v(column_name, finding, file_type, table_type, fails)""")
def schema_validate(t: Tables) -> DataFrame:
    file = t.orders.select(
        F.col("o_orderkey").cast("int").alias("O_ORDERKEY"), "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_orderdate",
        F.lit("drop").alias("loaded_from"),
    )
    required = [T.StructField("year", T.IntegerType(), False), T.StructField("batch", T.StringType(), False)]
    return schema_findings(t.spark, file.schema, T.StructType(t.orders.schema.fields + required))


@query("compact", "SELECT * FROM orders")
def compact(t: Tables) -> DataFrame:
    """Many small files of one version become four in the next."""
    table = VersionedTable(t.spark, t.scratch())
    table.publish(t.orders.repartition(16))
    tables.compact(t.spark, table, 4)
    return table.read()


@query("compact_small_files", "SELECT * FROM orders")
def compact_small_files(t: Tables) -> DataFrame:
    """One large file and many small ones of one table; the small ones are packed, what they were
    expires."""
    table = FileTable(t.spark, t.scratch(), (("o_orderkey",),))
    table.publish(t.orders.where("o_orderkey % 4 <> 0"))
    small = t.orders.where("o_orderkey % 4 = 0")
    for k in range(3):
        table.commit(add=small.where(F.pmod("o_custkey", F.lit(3)) == k))
    large = table.files().agg(F.max("bytes")).first()[0]
    table.compact(large, large)
    table.expire(datetime.now(timezone.utc))
    return table.read()


@query("table_size", """
SELECT COUNT(*) AS "rows", true AS has_bytes, true AS has_files FROM lineitem""")
def table_size(t: Tables) -> DataFrame:
    path = t.scratch()
    tables.write_parquet(t.lineitem, path)
    size = tables.table_size(t.spark, path)
    return size.select(
        "rows", (F.col("bytes") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files")
    )
