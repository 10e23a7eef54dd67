"""The layered run: steps that need the disk of the largest one only, and a mart in parts."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from martloom.operators.asof import join_nearest_snapshot, join_nearest_snapshots
from martloom.plans.layered import layered_run
from martloom.plans.mart_queries import order_lines, order_lines_by_order
from martloom.plans.suite import Tables
from martloom.session import shuffles_released
from martloom.sources.publish import VersionedTable
from martloom.sources.run_log import RunLog


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that stay; they go a little after their query."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_layered_run_publishes_parts_and_keeps_no_shuffle(spark, folder, rows):
    lines = spark.range(500).selectExpr("id div 4 AS o", "id % 4 AS l", "id % 7 AS q")
    lines.write.option("header", "true").option("maxRecordsPerFile", 100).csv(f"{folder}/drop", compression="gzip")

    def mart(t):
        return [t.where(where).groupBy("q").agg(F.count("*").alias("n")) for where in ("q < 3", "q >= 3")]

    for version in (1, 2):  # the second run replaces every order by itself
        before = shuffle_files(spark)
        got = layered_run(
            spark, f"{folder}/drop", folder, "o string, l string, q string", {c: {"type": "int"} for c in "olq"},
            ["o", "l"], ["o"], mart, RunLog(spark, f"{folder}/log"), "p",
        )
        assert not left_over(spark, before)
        assert rows(got) == [(q, len(range(q, 500, 7))) for q in range(7)]
        assert VersionedTable(spark, f"{folder}/mart").version() == version
    assert VersionedTable(spark, f"{folder}/table").read().count() == 500


def test_released_shuffles_can_be_made_again(spark):
    before = shuffle_files(spark)
    with shuffles_released(spark):
        counts = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
        first = counts.collect()
        assert not left_over(spark, before)
        assert sorted(counts.collect()) == sorted(first)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_parts_are_one_version(spark, folder, rows):
    table = VersionedTable(spark, folder)
    parts = [spark.range(2).withColumn("v", F.lit("a")), spark.range(0).withColumn("v", F.lit("b")),
             spark.createDataFrame([(7, None)], "id long, v string")]
    assert table.publish(parts, compression="zstd") == 1
    assert rows(table.read()) == [(0, "a"), (1, "a"), (7, None)]


def test_nearest_snapshots_of_several_tables(spark, rows):
    costs = spark.createDataFrame(
        [("a", "2020-01-05", 1, 1), ("a", "2021-06-01", 1, 2), ("b", "2020-02-01", 1, 3), ("b", "2020-02-01", 2, 4)],
        "k string, d string, u int, cost int",
    )
    one = spark.createDataFrame([("a", "2019-01-01"), ("a", "2021-05-31"), (None, "2020-01-01"), ("c", "2020-01-01")], "k string, day string")
    two = spark.createDataFrame([("b", "2020-03-01"), ("a", "2021-06-01"), ("a", None)], "k string, day string")
    args = (costs, ["k"], "day", "d", "u", ["cost"])
    for slot in ("month", "year"):
        parts = join_nearest_snapshots([one, two], *args, slot=slot)
        assert rows(parts[0]) == rows(join_nearest_snapshot(one, *args)) and rows(parts[0])[0] == ("a", "2019-01-01", 1)
        assert rows(parts[1]) == [("a", "2021-06-01", 2), ("a", None, None), ("b", "2020-03-01", 4)]


def test_order_lines_by_order_are_the_same_rows(spark, rows):
    t = Tables(spark, "")
    t.lineitem = spark.sql("""SELECT id % 5 AS l_orderkey, IF(id = 6, NULL, id % 3) AS l_partkey, id AS l_suppkey, id AS l_linenumber,
        1.5D AS l_quantity, 10D AS l_extendedprice, 0.1D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,
        TIMESTAMP_NTZ '1996-01-01' AS l_shipdate FROM range(12)""")
    t.orders = spark.sql("""SELECT * FROM VALUES (0L, 1L, 'F', '2-HIGH'), (0L, 2L, 'O', '5-LOW'), (1L, 1L, 'P', '3-MEDIUM'), (2L, 9L, 'O', '5-LOW'),
        (3L, NULL, 'O', '5-LOW'), (NULL, 1L, 'O', '5-LOW') AS v(o_orderkey, o_custkey, o_orderstatus, o_orderpriority)""").selectExpr("*", "TIMESTAMP_NTZ '1996-01-01' AS o_orderdate")
    t.customer = spark.sql("SELECT * FROM VALUES (1L, 'c1', 200D, 'BUILDING'), (1L, 'c1b', 6000D, 'HOUSEHOLD'), (2L, 'c2', 0D, NULL) AS v(c_custkey, c_name, c_acctbal, c_mktsegment)")
    t.part = spark.sql("SELECT * FROM VALUES (0L, 'Brand#1', 5D), (1L, 'Brand#2', 6D), (1L, 'Brand#2', 7D) AS v(p_partkey, p_brand, p_retailprice)")
    assert rows(order_lines_by_order(t)) == rows(order_lines(t)) != []
