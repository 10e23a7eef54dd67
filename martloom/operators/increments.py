"""Incremental windows and freshness checks. ``now`` and ``as_of`` are arguments, never the clock."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A source younger than this counts as up to date; load days end two days back.
UP_TO_DATE_SECONDS = 300
SETTLE_DAYS = 2
BUSINESS_ZONE = "Asia/Kolkata"


def hwm_window(
    registry: DataFrame, now: datetime, default_start: datetime, default_end: datetime
) -> DataFrame:
    """One row (window_start, window_end, state) from the newest current registry entry.

    Newer than five minutes: an empty window. No entry: the default window.
    """
    def at(value: datetime) -> Column:
        return F.lit(value).cast("timestamp_ntz")

    newest = registry.where("is_current").agg(F.max("source_updated_at").alias("hwm"))
    hwm = F.col("hwm")
    age = F.timestamp_diff("SECOND", hwm, at(now))
    fresh = age < UP_TO_DATE_SECONDS
    return newest.select(
        F.coalesce(hwm, at(default_start)).alias("window_start"),
        F.when(hwm.isNull(), at(default_end)).when(fresh, hwm).otherwise(at(now)).alias("window_end"),
        F.when(hwm.isNull(), "default").when(fresh, "up to date").otherwise("update").alias("state"),
    )


def incremental_slice(facts: DataFrame, ts: str, window: DataFrame) -> DataFrame:
    """Facts after the window's start and up to its end.

    The one-row window is fetched so that its bounds reach the scan as pushed-down literals.
    """
    bounds = window.select("window_start", "window_end").first()
    start, end = (F.lit(b).cast("timestamp_ntz") for b in bounds)
    return facts.where((F.col(ts) > start) & (F.col(ts) <= end))


def last_loaded(facts: DataFrame, column: str, channel: tuple[str, int] | None = None,
                products: DataFrame | None = None, on: tuple[str, str] | None = None) -> DataFrame:
    """MAX of a date column, over all rows or over one channel's products."""
    if channel is not None:
        name, value = channel
        wanted = products.where(F.col(name) == value).select(F.col(on[1]).alias(on[0]))
        facts = facts.join(wanted, on[0], "left_semi")
    return facts.agg(F.max(F.col(column).cast("date")).alias("last_date"))


def missing_days(last_dates: DataFrame, today: date) -> DataFrame:
    """Days still to load: from the day after the newest ``last_date`` to today - 2; without any
    date from the first of that day's month."""
    until = F.lit(today - timedelta(days=SETTLE_DAYS)).cast("date")
    newest = last_dates.agg(F.max("last_date").alias("last_date"))
    start = F.coalesce(F.date_add("last_date", 1), F.trunc(until, "month"))
    days = F.when(start <= until, F.sequence(start, until, F.expr("interval 1 day")))
    return newest.select(F.explode(days).alias("day"))


def backfill_windows(bounds: DataFrame, step: str = "1 day") -> DataFrame:
    """Consecutive (window_start, window_end) rows covering each (start_at, end_at) of ``bounds``."""
    width = F.expr(f"interval {step}")
    last = F.col("end_at") - width
    starts = F.when(F.col("start_at") <= last, F.sequence("start_at", last, width))
    return bounds.select(F.explode(starts).alias("window_start")).withColumn(
        "window_end", F.col("window_start") + width
    )


def in_windows(facts: DataFrame, ts: str, windows: DataFrame) -> DataFrame:
    """Facts joined to the windows (window_start inclusive, window_end exclusive) they fall in.

    Windows are laid out by day for an equi-join on the day, so the list may be of any length.
    """
    last = F.col("window_end") - F.expr("interval 1 microsecond")
    days = F.sequence(
        F.col("window_start").cast("date"), last.cast("date"), F.expr("interval 1 day")
    )
    laid_out = windows.where("window_start < window_end").withColumn("_day", F.explode(days))
    dated = facts.withColumn("_day", F.col(ts).cast("date"))
    inside = (F.col(ts) >= F.col("window_start")) & (F.col(ts) < F.col("window_end"))
    return dated.join(laid_out, "_day").where(inside).drop("_day")


def nth_window(windows: DataFrame, position: str, index: int) -> DataFrame:
    """The window at a saved position of an explicit list."""
    return windows.where(F.col(position) == index)


def day_outcomes(rows: DataFrame, day: Column, checks: Mapping[str, Column]) -> DataFrame:
    """(day, n_rows, ok, error): a day is good if every row of it meets every check; else the
    first check that a row fails (NULL fails) is the error. Rows without a day are one bad day."""
    failed = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(checks.values())]
    judged = rows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), *failed)
    error = F.when(F.col("day").isNull(), "no day")
    for i, name in enumerate(checks):
        error = error.when(F.col(f"_{i}") > 0, name)
    judged = judged.withColumn("error", error)
    return judged.select("day", "n_rows", F.col("error").isNull().alias("ok"), "error")


def freshness(
    facts: DataFrame,
    column: str,
    period: str,
    as_of: date,
    where: Column | None = None,
    joins: Sequence[tuple[DataFrame, Column, str]] = (),
) -> DataFrame:
    """One row: newest date, expected date (``t-n``) and whether the data reaches it."""
    for other, on, how in joins:
        facts = facts.join(other, on, how or "left")
    facts = facts if where is None else facts.where(where)
    expected = F.lit(as_of - timedelta(days=int(period.removeprefix("t-")))).cast("date")
    newest = facts.agg(F.max(F.col(column).cast("date")).alias("newest"))
    return newest.select(
        "newest",
        expected.alias("expected"),
        F.coalesce(F.col("newest") >= expected, F.lit(False)).alias("is_fresh"),
    )


def business_time(ts: Column, zone: str = BUSINESS_ZONE) -> Column:
    """A UTC timestamp as wall-clock time of the business zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def hour_bucket(ts: Column, zone: str = BUSINESS_ZONE) -> Column:
    return F.date_trunc("hour", business_time(ts, zone)).cast("timestamp_ntz")


def trailing_months(facts: DataFrame, ts: str, now: datetime, months: int = 3) -> DataFrame:
    """Facts of the last ``months`` months up to ``now``; the bounds fold into literals."""
    end = F.lit(now).cast("timestamp_ntz")
    start = (F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {months} months"))
    return facts.where((F.col(ts) >= start) & (F.col(ts) <= end))
