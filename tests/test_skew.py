"""Results and plans when one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from martloom.operators.asof import join_nearest_snapshot
from martloom.operators import skew
from martloom.operators.dedup import merge_keep_last
from martloom.operators.skew import in_groups, lookup_join, next_in_key, one_per_key, with_keys, without_keys

HOT = "CASE WHEN id % 3 = 0 THEN 0 ELSE id END"


@pytest.fixture
def small_partitions(spark):
    """Skew limits low enough for test data, and no broadcast joins."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, n=60000):
    return spark.range(0, n, 1, 64).select(F.expr(HOT).alias("k"), F.col("id").alias("v"))


def test_membership_joins_split_a_hot_key(spark, small_partitions):
    staged = facts(spark).where("v % 2 = 0").select("k")
    kept = without_keys(facts(spark), staged, ["k"])
    assert "skew=true" in final_plan(kept)
    assert kept.count() == facts(spark).where("k % 2 = 1").count()
    assert with_keys(facts(spark), staged, ["k"]).count() == 60000 - kept.count()


def test_lookup_join_splits_a_hot_key(spark, small_partitions):
    names = one_per_key(facts(spark), ["k"], ["v"], "first").withColumnRenamed("v", "first_v")
    joined = lookup_join(facts(spark), names, ["k"])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000
    assert joined.where("first_v is null or first_v > v").count() == 0


def test_nearest_snapshot_splits_a_hot_key(spark, small_partitions):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("v") % 20).cast("int"))
    costs = facts(spark, 300).select("k", day.alias("d"), F.lit(1).alias("u"), F.col("v").alias("cost"))
    sales = facts(spark).withColumn("day", day)
    joined = join_nearest_snapshot(sales, costs, ["k"], "day", "d", "u", ["cost"])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000


def test_lookup_join_keeps_null_keys_and_fan_out(spark, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, w string")
    assert rows(lookup_join(left, right, ["k"])) == [
        (1, "a", "x"), (1, "a", "y"), (2, "c", None), (None, "b", None)
    ]


def test_one_per_key_reads_only_what_it_needs(spark):
    df = facts(spark)
    plan = one_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_next_in_key_equals_lead(spark):
    from pyspark.sql import Window

    df = facts(spark, 5000).select(
        F.when(F.col("k") != 7, F.col("k") % 11).alias("k"),
        F.timestamp_add("MINUTE", F.col("v") * 37 % 90000, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
        F.col("v").alias("id"),
    )
    lead = F.lead("id").over(Window.partitionBy("k").orderBy("ts", "id"))
    for grain in ("hour", "day", "month"):
        got = next_in_key(df, ["k"], "ts", "id", "id", "following", grain)
        want = df.withColumn("following", lead)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("few", [1, 10_000])
def test_groups_meet_whether_few_or_many(spark, rows, monkeypatch, few):
    monkeypatch.setattr(skew, "FEW_GROUPS", few)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c"), (1, "a")], "v int, g string").repartition(3)
    other = spark.createDataFrame([("a",), (None,), ("a",), ("x",)], "g string")
    assert rows(in_groups(df, other, ["g"])) == [(1, "a"), (1, "a"), (3, None)]
    assert rows(in_groups(df, other, ["g"], inside=False)) == [(2, "b"), (4, "c")]


def test_partition_merge_moves_no_partition_to_one_task(spark, small_partitions):
    """Three partition values: the existing rows meet the touched ones where they lie."""
    old = spark.range(3000).select("id", F.expr("id % 3").alias("g"), F.lit(0).alias("v"))
    new = old.where("id < 10 AND g = 1").withColumn("v", F.lit(1))
    merged = merge_keep_last(old, new, ["id"], ["v"], partition_by=["g"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(coalesce(g" not in plan and "BroadcastHashJoin" in plan
    assert merged.count() == 1000 and merged.where("v = 1").count() == new.count()
