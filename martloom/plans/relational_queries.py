"""Registered queries: relational operators and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import cleaning
from martloom.operators.asof import join_nearest_snapshot
from martloom.operators.dedup import keep_last
from martloom.operators.skew import lookup_join, null_high, one_per_key, with_keys, without_keys
from martloom.plans.inputs import (
    LINE_SEQ, LINES, SHEET, SNAPSHOTS_SQL, ctes, nearest_sql, snapshots,
)
from martloom.plans.suite import Tables, query
from martloom.sources.queries import page

MONEY = "decimal(18,2)"


@query("project_consts", """
SELECT o_orderkey AS order_key, 'ORDERS' AS datasource, CAST(NULL AS VARCHAR) AS invoicenumber,
       -o_totalprice AS reversed_value
FROM orders""")
def project_consts(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_key"),
        F.lit("ORDERS").alias("datasource"),
        F.lit(None).cast("string").alias("invoicenumber"),
        (-F.col("o_totalprice")).alias("reversed_value"),
    )


@query("filter_not_in", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE NULLIF(o_orderpriority, '3-MEDIUM') <> ALL (['5-LOW', '4-NOT SPECIFIED'])""")
def filter_not_in(t: Tables) -> DataFrame:
    value = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    kept = t.orders.where(~value.isin("5-LOW", "4-NOT SPECIFIED"))
    return kept.select("o_orderkey", "o_orderpriority")


@query("filter_like", """
SELECT p_partkey, p_name, p_type FROM part WHERE p_name LIKE '%ring%' OR p_type LIKE 'ECON%'""")
def filter_like(t: Tables) -> DataFrame:
    kept = t.part.where(F.col("p_name").like("%ring%") | F.col("p_type").like("ECON%"))
    return kept.select("p_partkey", "p_name", "p_type")


@query("join_left", """
SELECT l_orderkey, l_linenumber, l_partkey, p_brand
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO')
  ON CAST(l_partkey AS VARCHAR) = CAST(p_partkey AS VARCHAR)""")
def join_left(t: Tables) -> DataFrame:
    parts = t.part.where("p_type <> 'PROMO'").select("p_partkey", "p_brand")
    same = F.col("l_partkey").cast("string") == F.col("p_partkey").cast("string")
    joined = t.lineitem.join(parts, same, "left")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_brand")


@query("join_left_composite", """
SELECT l_orderkey, l.l_linenumber, l.l_returnflag, discounted_qty
FROM lineitem l LEFT JOIN (
  SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey, year(l_shipdate) AS y,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS discounted_qty
  FROM lineitem WHERE l_discount >= 0.08 GROUP BY ALL) d
ON l.l_returnflag = d.l_returnflag AND l.l_linestatus = d.l_linestatus
   AND l.l_linenumber = d.l_linenumber AND l.l_suppkey = d.l_suppkey AND year(l_shipdate) = d.y""")
def join_left_composite(t: Tables) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "ship_year"]
    lines = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    quantity = F.sum(F.col("l_quantity").cast(MONEY)).alias("discounted_qty")
    discounted = lines.where("l_discount >= 0.08D").groupBy(*keys).agg(quantity)
    facts = lines.select(*keys, "l_orderkey")
    joined = lookup_join(facts, discounted, keys)
    return joined.select("l_orderkey", "l_linenumber", "l_returnflag", "discounted_qty")


@query("join_left_residual", """
SELECT l_orderkey, l_linenumber, l_returnflag, p_brand
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
  AND (l_returnflag = 'R' AND p_size < 10 OR l_returnflag = 'A' AND p_type = 'PROMO')""")
def join_left_residual(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    rule = ((flag == "R") & (F.col("p_size") < 10)) | ((flag == "A") & (F.col("p_type") == "PROMO"))
    joined = t.lineitem.join(t.part, (F.col("p_partkey") == F.col("l_partkey")) & rule, "left")
    return joined.select("l_orderkey", "l_linenumber", "l_returnflag", "p_brand")


@query("join_computed_key", """
SELECT c_custkey, n_name, n_regionkey
FROM customer JOIN nation ON upper('nation_' || CAST(c_nationkey AS VARCHAR)) = n_name""")
def join_computed_key(t: Tables) -> DataFrame:
    name = F.upper(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")))
    return t.customer.join(t.nation, name == F.col("n_name")).select(
        "c_custkey", "n_name", "n_regionkey"
    )


@query("distinct_on", """
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority IS NOT NULL
ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC""")
def distinct_on(t: Tables) -> DataFrame:
    rows = t.orders.where(F.col("o_orderpriority").isNotNull()).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"
    )
    return one_per_key(rows, ["o_custkey"], [*null_high("o_orderdate"), "o_orderkey"], "last")


@query("asof_prior_else_next", ctes(
    snaps=SNAPSHOTS_SQL,
    probes="SELECT DISTINCT l_partkey AS p_partkey, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem",
    found=nearest_sql("probes", "snaps", "p_partkey", "ship_day", ["cost"]),
) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(l_shipdate AS DATE) AS ship_day,
       snapshot_day, cost
FROM lineitem LEFT JOIN found ON p_partkey = l_partkey AND ship_day = CAST(l_shipdate AS DATE)""")
def asof_prior_else_next(t: Tables) -> DataFrame:
    facts = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("ship_day"),
    )
    costs = snapshots(t).withColumnRenamed("p_partkey", "l_partkey")
    return join_nearest_snapshot(
        facts, costs, ["l_partkey"], "ship_day", "valuationdate", "updated", ["cost"], "snapshot_day"
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("union_all_typed", """
SELECT 'order' AS source, CAST(o_orderkey AS VARCHAR) AS ref, CAST(o_orderdate AS DATE) AS day,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'finished', CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS DATE),
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'line', CAST(l_orderkey AS VARCHAR), CAST(l_shipdate AS DATE),
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT 'return', CAST(l_orderkey AS VARCHAR), CAST(l_shipdate AS DATE),
       -CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'event', CAST(event_id AS VARCHAR), CAST(ts AS DATE),
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) FROM events
UNION ALL SELECT 'customer', c_name, CAST(NULL AS DATE),
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) FROM customer""")
def union_all_typed(t: Tables) -> DataFrame:
    def branch(df, source, ref, day, amount):
        return df.select(
            F.lit(source).alias("source"),
            F.col(ref).cast("string").alias("ref"),
            (F.col(day) if day else F.lit(None)).cast("date").alias("day"),
            F.expr(amount).cast(MONEY).alias("amount"),
        )

    branches = [
        branch(t.orders.where("o_orderstatus <> 'F'"), "order", "o_orderkey", "o_orderdate", "o_totalprice"),
        branch(t.orders.where("o_orderstatus = 'F'"), "finished", "o_orderkey", "o_orderdate", "o_totalprice"),
        branch(t.lineitem.where("l_returnflag <> 'R'"), "line", "l_orderkey", "l_shipdate", "l_extendedprice"),
        branch(t.lineitem.where("l_returnflag = 'R'"), "return", "l_orderkey", "l_shipdate", "-l_extendedprice"),
        branch(t.events, "event", "event_id", "ts", "value"),
        branch(t.customer, "customer", "c_name", None, "c_acctbal"),
    ]
    return reduce(DataFrame.unionByName, branches)


@query("agg_basic", """
SELECT l_returnflag, l_linestatus,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       MAX(l_extendedprice) AS max_price, MIN(l_extendedprice) AS min_price,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price,
       COUNT(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_basic(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast(MONEY)).alias("sum_qty"),
        F.max(price).alias("max_price"),
        F.min(price).alias("min_price"),
        (F.sum(price.cast(MONEY)).cast("double") / F.count(F.lit(1))).alias("avg_price"),
        F.count(F.lit(1)).alias("n"),
    )


@query("window_row_number", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def window_row_number(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return one_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "first")


@query("count_distinct_case", """
SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS customers,
       COUNT(DISTINCT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_custkey END) AS urgent_customers
FROM orders GROUP BY o_orderstatus""")
def count_distinct_case(t: Tables) -> DataFrame:
    # One row per (status, customer) first: the counts then need no second distinct pass.
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    per_customer = t.orders.groupBy("o_orderstatus", "o_custkey").agg(F.max(urgent).alias("urgent"))
    return per_customer.groupBy("o_orderstatus").agg(
        F.count("o_custkey").alias("customers"),
        F.count(F.when(F.col("urgent"), F.col("o_custkey"))).alias("urgent_customers"),
    )


@query("sum_case", """
SELECT l_linestatus, year(l_shipdate) AS ship_year,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS returned,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS return_lines
FROM lineitem GROUP BY ALL""")
def sum_case(t: Tables) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_linestatus", F.year("l_shipdate").cast("bigint").alias("ship_year")).agg(
        F.sum(F.when(returned, F.col("l_extendedprice").cast(MONEY)).otherwise(0)).alias("returned"),
        F.count_if(returned).alias("return_lines"),
    )


@query("group_by_expr", """
SELECT CASE WHEN o_orderpriority IS NOT NULL AND o_orderpriority <> '5-LOW' THEN upper(o_orderpriority)
            ELSE 'CORE' END AS kind,
       CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n
FROM orders GROUP BY ALL""")
def group_by_expr(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    kind = F.when(priority.isNotNull() & (priority != "5-LOW"), F.upper(priority)).otherwise("CORE")
    return t.orders.groupBy(
        kind.alias("kind"), F.col("o_orderdate").cast("date").alias("day")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("order_by_nulls", """
SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders
ORDER BY priority DESC NULLS FIRST, o_totalprice ASC NULLS LAST, o_orderkey""")
def order_by_nulls(t: Tables) -> DataFrame:
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    return t.orders.select("o_orderkey", priority, "o_totalprice").orderBy(
        F.desc_nulls_first("priority"), F.asc_nulls_last("o_totalprice"), "o_orderkey"
    )


@query("paginate", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def paginate(t: Tables) -> DataFrame:
    return page(
        t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice",
        ["o_totalprice", "o_orderdate"], limit=50, offset=100, tiebreak=["o_orderkey"],
    )


@query("semi_join", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""")
def semi_join(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    keys = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return with_keys(t.customer.select("c_custkey", "c_name"), keys, ["c_custkey"])


@query("anti_join", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'R')""")
def anti_join(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return without_keys(t.orders.select("o_orderkey", "o_custkey"), returned, ["o_orderkey"])


@query("dedup_keep_last", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(f'{c} DESC' for c in LINE_SEQ)}, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM ({LINES.sql})) WHERE rn = 1""")
def dedup_keep_last(t: Tables) -> DataFrame:
    seq = [*LINE_SEQ, "l_returnflag", "l_linestatus"]
    return keep_last(LINES.spark(t), ["l_orderkey", "l_linenumber"], seq)


# --- scalar functions ------------------------------------------------------------------------


@query("scalar_coalesce", """
SELECT o_orderkey, COALESCE(NULLIF(o_orderpriority, '5-LOW'), 'Unmapped') AS priority,
       COALESCE(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, 0) AS finished_value FROM orders""")
def scalar_coalesce(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("Unmapped")).alias("priority"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), F.lit(0.0)).alias("finished_value"),
    )


@query("scalar_case", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'RTO' WHEN o_orderstatus = 'O' THEN 'Sale' END AS saletype,
       CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' THEN 'hot'
            ELSE 'normal' END AS heat
FROM orders""")
def scalar_case(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    hot = ((F.col("o_totalprice") > 100000) & (status == "O")) | (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "RTO").when(status == "O", "Sale").alias("saletype"),
        F.when(hot, "hot").otherwise("normal").alias("heat"),
    )


@query("scalar_string", """
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower, trim('  ' || p_type || ' ') AS type_trim,
       upper(p_name) || ' / ' || upper(NULLIF(p_type, 'PROMO')) AS label FROM part""")
def scalar_string(t: Tables) -> DataFrame:
    kind = F.upper(F.nullif(F.col("p_type"), F.lit("PROMO")))
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("name_upper"),
        F.lower("p_brand").alias("brand_lower"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("type_trim"),
        F.concat(F.upper("p_name"), F.lit(" / "), kind).alias("label"),
    )


@query("json_field", """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS missing FROM events""")
def json_field(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.get_json_object("props", "$.none").alias("missing"),
    )


@query("scalar_math", """
SELECT l_orderkey, l_linenumber, l_partkey,
       -CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS negated,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) * -1 AS DOUBLE) AS times_minus_one,
       ROUND(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) / 1.18::DOUBLE, 2) AS net,
       CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS DOUBLE) AS discount_pct
FROM lineitem""")
def scalar_math(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast(MONEY)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (-quantity).alias("negated"),
        (quantity * -1).alias("times_minus_one"),
        F.round(F.col("l_extendedprice").cast(MONEY) / F.lit("1.18").cast("decimal(3,2)"), 2).alias("net"),
        (F.col("l_discount").cast(MONEY) * 100).alias("discount_pct"),
    )


@query("safe_divide", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / NULLIF(l_discount, 0) AS price_per_discount
FROM lineitem""")
def safe_divide(t: Tables) -> DataFrame:
    ratio = F.try_divide("l_extendedprice", "l_discount").alias("price_per_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", ratio)


@query("scalar_cast", ctes(sheet=SHEET) + """
SELECT row_no, CAST(row_no AS VARCHAR) AS row_text, CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       TRY_CAST(CASE WHEN order_date LIKE '____-__-__' THEN order_date END AS DATE) AS day,
       CAST(TRY_CAST(qty AS DOUBLE) AS DOUBLE) AS qty FROM sheet""")
def scalar_cast(t: Tables) -> DataFrame:
    date_text = F.when(F.col("order_date").like("____-__-__"), F.col("order_date"))
    return SHEET.spark(t).select(
        "row_no",
        F.col("row_no").cast("string").alias("row_text"),
        F.col("amount").try_cast(MONEY).alias("amount"),
        date_text.try_cast("date").alias("day"),
        F.col("qty").try_cast("double").alias("qty"),
    )


# --- cleaning ----------------------------------------------------------------------------------

_BLANK = ", ".join(f"'{p}'" for p in cleaning.PLACEHOLDERS)
_WHITE = f"'{cleaning.WHITE_SPACE}'"
_ERRORS = ", ".join(f"'{e}'" for e in cleaning.SHEET_ERRORS)


def _blank_sql(column: str) -> str:
    return (
        f"CASE WHEN trim({column}, {_WHITE}) IN ({_BLANK}) OR replace(upper(trim({column}, {_WHITE})), ' ', '') IN ({_ERRORS}) "
        f"THEN NULL ELSE {column} END AS {column}"
    )


@query("null_placeholders", ctes(sheet=SHEET) + f"""
SELECT row_no, {', '.join(_blank_sql(c) for c in ['amount', 'flag', 'qty', 'order_date', 'note'])} FROM sheet""")
def null_placeholders(t: Tables) -> DataFrame:
    return cleaning.null_placeholders(SHEET.spark(t).drop("unused"))


@query("drop_all_null", ctes(sheet=SHEET) + """
SELECT amount, flag, qty, order_date, note FROM sheet
WHERE COALESCE(amount, flag, qty, order_date, note, unused) IS NOT NULL""")
def drop_all_null(t: Tables) -> DataFrame:
    return cleaning.drop_all_null(SHEET.spark(t).drop("row_no"))


@query("serial_dates", ctes(sheet=SHEET) + """
SELECT row_no,
  CASE WHEN TRY_CAST(order_date AS DOUBLE) BETWEEN 20000 AND 60000
       THEN TIMESTAMP '1899-12-30 00:00:00' + to_microseconds(CAST(round(TRY_CAST(order_date AS DOUBLE) * 86400000000) AS BIGINT))
       WHEN TRY_CAST(order_date AS TIMESTAMP) <> TIMESTAMP '1970-01-01 00:00:00' THEN TRY_CAST(order_date AS TIMESTAMP)
  END AS order_date
FROM sheet""")
def serial_dates(t: Tables) -> DataFrame:
    return cleaning.serial_dates(SHEET.spark(t).select("row_no", "order_date"))


@query("ragged_rows", """
SELECT conv_id, turn, NULLIF(split_part(text, ' ', 1), '') AS c0, NULLIF(split_part(text, ' ', 2), '') AS c1,
       NULLIF(split_part(text, ' ', 3), '') AS c2, NULLIF(split_part(text, ' ', 4), '') AS c3 FROM conversations""")
def ragged_rows(t: Tables) -> DataFrame:
    cells = cleaning.fit_row(F.split("text", " "), 4)
    return t.conversations.select(
        "conv_id", "turn",
        *[F.nullif(c, F.lit("")).alias(f"c{i}") for i, c in enumerate(cells)],
    )


@query("keyword_normalise", """
SELECT p_partkey, replace(trim(p_name), ' ', '+') AS keyword FROM part WHERE p_name IS NOT NULL""")
def keyword_normalise(t: Tables) -> DataFrame:
    kept = t.part.where(F.col("p_name").isNotNull())
    return kept.select("p_partkey", cleaning.keyword(F.col("p_name")).alias("keyword"))


@query("parse_number_text", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
       CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS DOUBLE) AS pct FROM lineitem""")
def parse_number_text(t: Tables) -> DataFrame:
    shown = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.format_number("l_extendedprice", 2).alias("price"),
        F.concat((F.col("l_discount").cast(MONEY) * 100).cast("string"), F.lit("%")).alias("pct"),
    )
    return shown.withColumns({c: cleaning.number_text(F.col(c)) for c in ["price", "pct"]})


@query("flatten_unique_join", """
SELECT conv_id, turn, list_aggregate(list_distinct_ordered, 'string_agg', ',') AS words FROM (
  SELECT conv_id, turn, list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
           lambda x: list_position(w, x[1]) = x[2]), lambda x: x[1]) AS list_distinct_ordered
  FROM (SELECT conv_id, turn, list_concat(string_split(text, ' '), [role], string_split(role, 's')) AS w FROM conversations))""")
def flatten_unique_join(t: Tables) -> DataFrame:
    lists = F.array(F.split("text", " "), F.array("role"), F.split("role", "s"))
    return t.conversations.select("conv_id", "turn", cleaning.join_unique(lists).alias("words"))
