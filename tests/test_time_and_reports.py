from datetime import date, datetime

from pyspark.sql import functions as F

from martloom.operators import increments, registry, report
from martloom.plans import marts

NOW = datetime(2024, 5, 10, 12)
DEFAULT = (datetime(2024, 1, 1), datetime(2024, 12, 31))


def window(spark, stamps):
    df = spark.createDataFrame([(s, True) for s in stamps], "source_updated_at timestamp_ntz, is_current boolean")
    return tuple(increments.hwm_window(df, NOW, *DEFAULT).first())


def test_high_water_mark(spark):
    old = datetime(2024, 5, 1)
    assert window(spark, [old, datetime(2024, 4, 1)]) == (old, NOW, "update")
    recent = datetime(2024, 5, 10, 11, 56)
    assert window(spark, [recent]) == (recent, recent, "up to date")
    assert window(spark, [datetime(2024, 5, 10, 11, 55)])[2] == "update"
    assert window(spark, []) == (*DEFAULT, "default")


def days(spark, last):
    df = spark.createDataFrame([(v,) for v in last], "last_date date")
    return [r.day for r in increments.missing_days(df, date(2024, 5, 4)).orderBy("day").collect()]


def test_missing_days(spark):
    assert days(spark, [date(2024, 4, 29), None]) == [date(2024, 4, 30), date(2024, 5, 1), date(2024, 5, 2)]
    assert days(spark, [date(2024, 5, 2)]) == []
    assert days(spark, [date(2024, 6, 1)]) == []
    assert days(spark, [None]) == [date(2024, 5, 1), date(2024, 5, 2)]


def test_backfill_and_lists(spark, rows):
    bounds = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 1, 13)), (datetime(2024, 2, 1), datetime(2024, 2, 1))],
        "start_at timestamp_ntz, end_at timestamp_ntz",
    )
    steps = increments.backfill_windows(bounds, "6 hours")
    assert [(r[0].hour, r[1].hour) for r in steps.orderBy("window_start").collect()] == [(0, 6), (6, 12)]
    facts = spark.createDataFrame([(datetime(2024, 1, 1, h),) for h in (0, 5, 6, 12)], "ts timestamp_ntz")
    assert increments.in_windows(facts, "ts", steps).count() == 3
    listed = steps.withColumn("position", F.when(F.hour("window_start") == 0, 0).otherwise(1))
    assert increments.nth_window(listed, "position", 1).first().window_start.hour == 6


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 9, 3),)], "ts timestamp_ntz")
    assert increments.freshness(df, "ts", "t-1", NOW.date()).first().is_fresh
    assert not increments.freshness(df, "ts", "t-0", NOW.date()).first().is_fresh
    assert increments.freshness(df.limit(0), "ts", "t-9", NOW.date()).first().is_fresh is False


def test_business_hour_near_midnight(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31, 18, 45),)], "ts timestamp_ntz")
    assert df.select(increments.hour_bucket(F.col("ts"))).first()[0] == datetime(2024, 2, 1, 0)


def test_bulk_registration_checks_columns(spark):
    import pytest

    with pytest.raises(ValueError, match="lack required"):
        registry.bulk_rows(spark.range(1), ["client_id"], NOW)


def test_total_row_defaults(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("b", None, "y")], "name string, n int, t string")
    assert ("Grand Total", 1, "", True) in rows(report.with_total_row(df))


def test_top_flags_rank_null_lowest(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 1), ("d", -5)], "k string, v int")
    assert rows(report.flag_top(df, "v", 2, ["k"])) == [
        ("a", 1, True), ("b", None, False), ("c", 1, True), ("d", -5, False)
    ]


def test_progress_is_clamped(spark):
    df = spark.createDataFrame([(-5,), (50,), (900,), (None,)], "v int")
    got = [r[0] for r in df.select(report.progress(F.col("v"), 0, 200)).collect()]
    assert got == [0.0, 25.0, 100.0, None]


def test_inventory_without_bins_keeps_rows(spark, rows):
    stock = spark.createDataFrame(
        [("s", "l", "In Process", 1, 5), ("s", "l", "In Process", 2, 7), ("s", "l", "good", 1, 3)],
        "skucode string, location string, bucket string, seq int, quantity int",
    )
    at = F.lit(NOW)
    kept = marts.inventory(stock, None, ["seq"], at).drop("updated_on")
    assert rows(kept) == [("s", "l", "In Process", 7), ("s", "l", "good", 3)]
    bins = spark.createDataFrame(
        [("s", "l", " StageBin ", 2), ("s", "l", "B1", 1), ("s", "l", "B2", 4), ("q", "l", None, 9)],
        "skucode string, location string, bincode string, quantity int",
    )
    replaced = marts.inventory(stock, bins, ["seq"], at).drop("updated_on")
    assert rows(replaced) == [
        ("q", "l", "In Process", 9), ("s", "l", "In Process", 5), ("s", "l", "Stage bin", 2), ("s", "l", "good", 3)
    ]
    assert rows(marts.inventory(stock, bins.limit(0), ["seq"], at).drop("updated_on")) == rows(kept)


def test_marketplace_rules(spark):
    sales = spark.createDataFrame(
        [("p1", "Return", 2, "o1", date(2024, 1, 1), "i1", 10.0), ("p9", "Fee", 1, "o2", None, "i2", 5.0),
         ("p1", None, 1, "o3", None, "i3", 5.0)],
        "code string, event string, quantity int, order_id string, invoice_date date, invoice_id string, amount double",
    )
    skus = spark.createDataFrame([("p1", "Sku1")], "platformcode string, whsku string")
    rules = marts.Marketplace(
        "P", "M", "S", "E", "D", "F", sale_types={"Return": "RTO"}, negative_types=["Return"], drop_types=["Void"]
    )
    got = {r.externalordernumber: r for r in marts.marketplace_sales(sales, skus, rules).collect()}
    assert set(got) == {"o1", "o2"}
    assert (got["o1"].quantity, got["o1"].saletype, got["o1"].whsku_key, float(got["o1"].rto)) == (-2, "RTO", "SKU1", 10.0)
    assert (got["o2"].whsku, got["o2"].saletype, float(got["o2"].rto)) == ("Unmapped", None, 0.0)


def test_channel_totals_count_over_narrow_rows(spark, rows, capsys):
    lines = spark.createDataFrame(
        [
            ("A", "1995-01-01", "CORE", "DIRECT", "PAID", "o1", "ann", "TRUE", None, 1, "b1", "10.10"),
            ("A", "1995-01-01", "CORE", "DIRECT", "PAID", "o1", "bob", "FALSE", "Cancelled", 0, "b2", "-0.05"),
            ("A", "1995-01-01", "CORE", "DIRECT", "PAID", "o2", None, "TRUE", "Cancelled", 2, "b1", None),
            ("A", "1995-01-01", "CORE", "DIRECT", "PAID", None, "ann", "TRUE", "Cancelled", 2, None, "1.00"),
            ("A", "1995-01-01", "CORE", "DIRECT", "PAID", "o3", "bob", None, "shipped & returned", 3, "b1", "2.00"),
            ("B", None, None, "DIRECT", "PAID", "o4", None, "FALSE", "Cancelled", 0, None, None),
        ],
        "store string, orderdate string, marketingtype string, marketingsource string, marketingchannel string, "
        "ordername string, phone string, new_customer string, orderstatus string, quantity int, brandname string, "
        "netsales string",
    ).withColumn("netsales", F.col("netsales").cast("decimal(18,2)"))
    totals = marts._channel_orders(lines, ["netsales"], {})
    counts = ["total_order", "new_customer", "total_customer", "canc_orders"]
    assert rows(totals.select("store", *counts, F.col("netsales").cast("string"), "brandname")) == [
        ("A", 2, 1, 2, 2, "13.05", "b2"),
        ("B", 0, 0, 0, 1, "0.00", None),
    ]
    assert totals.schema["netsales"].dataType.simpleString() == "decimal(38,2)"
    # Three projections (sums, orders, customers) and the columns they give; no decimals yet.
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    try:
        totals.explain()
    finally:
        spark.conf.unset("spark.sql.maxToStringFields")
    expands = [line for line in capsys.readouterr().out.splitlines() if "Expand [[" in line]
    assert expands and all(line.count("[store#") == 4 and "decimal" not in line for line in expands)
