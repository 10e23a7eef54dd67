"""Registered queries: declared schemas, conversion, inference."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.convert import FALSE_TEXTS, TRUE_TEXTS
from martloom.functions.names import clean_names
from martloom.operators import inference, schema
from martloom.plans.inputs import CLEAN_SHEET, SHEET, ctes
from martloom.plans.suite import Tables, query

_TRUE = ", ".join(f"'{v}'" for v in TRUE_TEXTS)
_FALSE = ", ".join(f"'{v}'" for v in FALSE_TEXTS)


def _bool_sql(c: str) -> str:
    return f"CASE WHEN {c} IN ({_TRUE}) THEN true WHEN {c} IN ({_FALSE}) THEN false END"


def _int_sql(c: str) -> str:
    return f"TRY_CAST(round_even(TRY_CAST({c} AS DOUBLE), 0) AS BIGINT)"


@query("apply_schema", ctes(sheet=SHEET) + f"""
SELECT row_no, TRY_CAST(amount AS DOUBLE) AS amount, COALESCE({_bool_sql('flag')}, false) AS flag,
       COALESCE({_int_sql('qty')}, 0) AS qty,
       CAST(CASE WHEN order_date LIKE '____-__-__' THEN TRY_CAST(order_date AS TIMESTAMP) END AS DATE) AS order_date,
       CASE WHEN note <> 'nan' THEN note END AS note FROM sheet""")
def apply_schema(t: Tables) -> DataFrame:
    dates = F.when(F.col("order_date").like("____-__-__"), F.col("order_date"))
    sheet = SHEET.spark(t).drop("unused").withColumn("order_date", dates)
    declared = {
        "amount": {"type": "float"},
        "flag": {"type": "bool", "nullable": False},
        "qty": {"type": "int", "nullable": False},
        "order_date": {"type": "date"},
        "note": {"type": "str"},
        "not_there": {"type": "int"},
    }
    return schema.apply_schema(sheet, declared)


@query("conform_types", ctes(sheet=SHEET) + f"""
SELECT CAST(row_no AS VARCHAR) AS row_no, TRY_CAST(amount AS DOUBLE) AS amount, {_bool_sql('flag')} AS flag,
       {_int_sql('qty')} AS qty, '["' || note || '","x"]' AS tags_text,
       CAST(CASE WHEN note IS NOT NULL THEN 2 END AS INTEGER) AS n_tags FROM sheet""")
def conform_types(t: Tables) -> DataFrame:
    """Text to the target's types; list text to an array and an array to text."""
    tags = F.concat(F.lit('["'), F.col("note"), F.lit('","x"]'))
    sheet = SHEET.spark(t).select("row_no", "amount", "flag", "qty", tags.alias("tags"))
    target = T.StructType.fromDDL(
        "row_no string, amount double, flag boolean, qty bigint, tags array<string>"
    )
    conformed = schema.conform_types(sheet, target)
    sized = conformed.withColumn("n_tags", F.array_size("tags"))
    text = schema.conform_types(sized, T.StructType.fromDDL("tags string"))
    return text.withColumnRenamed("tags", "tags_text")


@query("conform_values", ctes(sheet=SHEET) + """
SELECT row_no, TRY_CAST(trunc(TRY_CAST(NULLIF(trim(qty), '') AS DOUBLE)) AS BIGINT) AS qty,
       TRY_CAST(NULLIF(trim(amount), '') AS DOUBLE) AS amount,
       lower(trim(flag)) IN ('true', 't', 'yes', 'y', '1') AS flag,
       note AS first_tag, CAST(CASE WHEN note IS NOT NULL THEN 2 END AS INTEGER) AS n_tags,
       CAST(row_no AS VARCHAR) AS one_text FROM sheet""")
def conform_values(t: Tables) -> DataFrame:
    tags = F.concat(F.lit("{"), F.col("note"), F.lit(",x}"))
    sheet = SHEET.spark(t).select(
        "row_no", "qty", "amount", "flag", tags.alias("tags"), F.col("row_no").alias("one")
    )
    target = T.StructType.fromDDL(
        "row_no bigint, qty bigint, amount double, flag boolean, tags array<string>, one array<bigint>"
    )
    loaded = schema.conform_values(sheet, target)
    return loaded.select(
        "row_no", "qty", "amount", "flag",
        F.get("tags", F.lit(0)).alias("first_tag"),
        F.array_size("tags").alias("n_tags"),
        F.array_join(F.col("one").cast("array<string>"), ",").alias("one_text"),
    )


@query("transform_columns", ctes(sheet=SHEET) + f"""
SELECT row_no AS order_no, CAST({_int_sql('qty')} AS BIGINT) AS quantity,
       round_even(TRY_CAST(amount AS DOUBLE), 1) AS value, upper(note) AS remark FROM sheet""")
def transform_columns(t: Tables) -> DataFrame:
    return schema.transform_columns(
        SHEET.spark(t),
        mapping={"row_no": "order_no", "qty": "quantity", "amount": "value", "note": "remark", "no": "x"},
        types={"quantity": "int", "value": "float"},
        precision={"value": 1, "quantity": 0},
        custom={"remark": F.upper},
    )


@query("nullability_profile", ctes(sheet=SHEET) + "".join(
    f"""{'UNION ALL ' if i else ''}SELECT '{c}' AS column_name, '{kind}' AS data_type,
    COUNT(*) > COUNT({c}) AS nullable, COUNT(*) - COUNT({c}) AS null_count FROM sheet
""" for i, (c, kind) in enumerate([
        ("row_no", "bigint"), ("amount", "string"), ("flag", "string"), ("qty", "string"),
        ("order_date", "string"), ("note", "string"), ("unused", "string")])))
def nullability_profile(t: Tables) -> DataFrame:
    return schema.nullability(SHEET.spark(t))


_INT_RULE = """CASE WHEN MAX(ABS({c})) < 32767 THEN 'smallint' WHEN MAX(ABS({c})) < 2147483647 THEN 'integer'
               ELSE 'bigint' END"""
_NUMERIC_RULE = """CASE WHEN MAX(ABS({c})) < 1000000 THEN
  printf('numeric(%d,%d)', LEAST(length(CAST(CAST(floor(MAX(ABS({c}))) AS BIGINT) AS VARCHAR)) + MAX({s}), 15), MAX({s}))
  ELSE 'double precision' END"""
_SCALE = "GREATEST(length(rtrim(split_part(CAST(CAST({c} AS DECIMAL(18,6)) AS VARCHAR), '.', 2), '0')), 1)"
_VARCHAR = "printf('character varying(%d)', CAST(GREATEST(LEAST(floor(MAX(length({c})) * 1.5), 1000), 1) AS BIGINT))"


@query("infer_types", f"""
SELECT 'key_text' AS column_name, {_INT_RULE.format(c='o_orderkey')} AS inferred_type, false AS nullable FROM orders
UNION ALL SELECT 'price_text', {_NUMERIC_RULE.format(c='priced', s=_SCALE.format(c='priced'))}, COUNT(*) > COUNT(priced)
  FROM (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS priced FROM orders)
UNION ALL SELECT 'big', {_INT_RULE.format(c='o_orderkey * 1000000')}, false FROM orders
UNION ALL SELECT 'o_totalprice', {_NUMERIC_RULE.format(c='o_totalprice', s=_SCALE.format(c='o_totalprice'))}, false FROM orders
UNION ALL SELECT 'o_orderdate', CASE WHEN MAX(CAST(o_orderdate <> CAST(o_orderdate AS DATE) AS INTEGER)) = 1 THEN 'timestamp' ELSE 'date' END, false FROM orders
UNION ALL SELECT 'o_orderpriority', {_VARCHAR.format(c='o_orderpriority')}, false FROM orders
UNION ALL SELECT 'doc', 'jsonb', false
UNION ALL SELECT 'blank', 'character varying(255)', false
UNION ALL SELECT 'nothing', 'text', true
UNION ALL SELECT 'flag', 'boolean', false""")
def infer_types(t: Tables) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return inference.infer_types(
        t.orders.select(
            F.col("o_orderkey").cast("string").alias("key_text"),
            F.when(F.col("o_orderpriority") != "5-LOW", price).alias("price_text"),
            (F.col("o_orderkey") * 1000000).alias("big"),
            "o_totalprice", "o_orderdate", "o_orderpriority",
            F.to_json(F.struct("o_orderkey")).alias("doc"),
            F.lit(" ").alias("blank"),
            F.lit(None).cast("string").alias("nothing"),
            (F.col("o_orderkey") > 5).alias("flag"),
        )
    )


def _key_sql(name: str, columns: list[str], table: str) -> str:
    usable = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    row = f"({', '.join(columns)})"
    return f"""
SELECT '{name}' AS key_columns, CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(COUNT(*) - COUNT(*) FILTER ({usable}) AS BIGINT) AS null_rows,
       CAST(COUNT(DISTINCT {row}) FILTER ({usable}) AS BIGINT) AS distinct_keys,
       COUNT(*) = COUNT(DISTINCT {row}) FILTER ({usable}) AS is_key FROM {table}"""


@query("key_discovery", "WITH r AS (" + " UNION ALL ".join([
    _key_sql("order_id", ["l_orderkey"], "lineitem"),
    _key_sql("order_id+line_no", ["l_orderkey", "l_linenumber"], "lineitem"),
    _key_sql("order_id+item_id", ["l_orderkey", "l_partkey"], "lineitem"),
]) + """)
SELECT *, is_key AND NOT (key_columns = 'order_id+item_id'
                          AND (SELECT is_key FROM r WHERE key_columns = 'order_id+line_no')) AS chosen FROM r""")
def key_discovery(t: Tables) -> DataFrame:
    """The candidates by name for a table of order lines, each counted over all rows, and the ones
    that discovery chooses."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("item_id"),
    )
    singles, pairs = inference.key_candidates(lines.columns, "order_lines")
    found = ["+".join(k) for k in inference.discover_keys(lines, "order_lines").values() if k]
    report = inference.key_report(lines, [[c] for c in singles] + [list(p) for p in pairs])
    return report.withColumn("chosen", F.col("key_columns").isin(found))


@query("audit_columns", """
SELECT c_custkey, TIMESTAMP '2024-01-31 12:00:00' AS inserted_at, TIMESTAMP '2024-01-31 12:00:00' AS updated_at,
       'batch-7' AS batch_id, 'drop' AS source FROM customer""")
def audit_columns(t: Tables) -> DataFrame:
    at = F.lit(datetime(2024, 1, 31, 12)).cast("timestamp_ntz")
    return schema.with_audit_columns(t.customer.select("c_custkey"), "batch-7", "drop", at)


@query("name_rule_numeric", ctes(sheet=SHEET) + """
SELECT row_no, CAST(TRY_CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS amount,
       CAST(TRY_CAST(qty AS DECIMAL(10,2)) AS DOUBLE) AS qty, flag FROM sheet""")
def name_rule_numeric(t: Tables) -> DataFrame:
    return schema.numbers_by_name(SHEET.spark(t).select("row_no", "amount", "qty", "flag"))


@query("sheet_infer", ctes(sheet=CLEAN_SHEET) + """
SELECT 'Whole_No' AS column_name, CASE WHEN COUNT(TRY_CAST(Whole_No AS DOUBLE)) = COUNT(NULLIF(trim(Whole_No), '')) THEN 'BIGINT' END AS inferred_type FROM sheet
UNION ALL SELECT 'Amount', CASE WHEN COUNT(TRY_CAST(Amount AS DOUBLE)) = COUNT(NULLIF(trim(Amount), '')) THEN 'DOUBLE PRECISION' END FROM sheet
UNION ALL SELECT 'Is_Open', CASE WHEN bool_and(lower(trim(Is_Open)) IN ('true', 'false', '')) THEN 'BOOLEAN' END FROM sheet
UNION ALL SELECT 'Order_Date', CASE WHEN COUNT(TRY_CAST(Order_Date AS TIMESTAMP)) = COUNT(Order_Date) THEN 'TIMESTAMP' END FROM sheet
UNION ALL SELECT 'Note', 'TEXT'
UNION ALL SELECT 'Unused', 'TEXT'""")
def sheet_infer(t: Tables) -> DataFrame:
    return inference.infer_sheet_types(CLEAN_SHEET.spark(t))


@query("sheet_coerce", ctes(sheet=SHEET) + """
SELECT row_no, TRY_CAST(NULLIF(trim(amount), '') AS DOUBLE) AS amount,
       CASE lower(trim(flag)) WHEN 'true' THEN true WHEN 'false' THEN false END AS flag,
       TRY_CAST(round_even(TRY_CAST(qty AS DOUBLE), 0) AS BIGINT) AS qty, note FROM sheet""")
def sheet_coerce(t: Tables) -> DataFrame:
    kinds = {"amount": "DOUBLE PRECISION", "flag": "BOOLEAN", "qty": "BIGINT", "note": "TEXT"}
    return inference.coerce_sheet(SHEET.spark(t).select("row_no", *kinds), kinds)


@query("clean_names", """
SELECT c_custkey AS Customer_No, c_name AS Customer_Name, c_name AS Customer_Name_2, c_nationkey AS col_2nd_key,
       c_mktsegment AS unnamed_col, c_acctbal AS Balance FROM customer""")
def clean_names_query(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.col("c_custkey").alias(" Customer No."[:-1]),
        F.col("c_name").alias("Customer - Name"),
        F.col("c_name").alias("Customer.Name"),
        F.col("c_nationkey").alias("2nd key"),
        F.col("c_mktsegment").alias("#!"),
        F.col("c_acctbal").alias("(Balance)"),
    )
    return clean_names(raw)


def _weight_class(size: Column) -> Column:
    """A vectorised Python value function, as a user would pass for one column."""

    @F.pandas_udf("string")
    def classify(values: pd.Series) -> pd.Series:
        return pd.cut(values, [-np.inf, 10, 30, np.inf], labels=["light", "medium", "heavy"]).astype(object)

    return classify(size)


@query("udf_column", """
SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'light' WHEN p_size <= 30 THEN 'medium' ELSE 'heavy' END AS size_class,
       replace(trim(p_name), ' ', '+') AS name FROM part""")
def udf_column(t: Tables) -> DataFrame:
    from martloom.functions.cleaning import keyword

    return schema.transform_columns(
        t.part,
        mapping={"p_partkey": "p_partkey", "p_size": "size_class", "p_name": "name"},
        types={"size_class": _weight_class},
        custom={"name": keyword},
    )
