"""Nearest-date lookup: the latest snapshot on or before a date, else the earliest later one.

Snapshots become validity intervals that cover all time: each runs from its day to the next
snapshot's day, and the first also covers everything before it. A fact then lies in exactly one
interval of its key. Intervals are cut at slot borders (months by default), which gives an
equi-join on (key, slot) with a date condition on the few intervals of that slot: the facts are
shuffled once, are never ranked, and a hot key is spread over its slots and split further by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.skew import all_not_null, null_high, one_per_key
from martloom.session import settle

_STEP = {"week": "interval 7 days", "month": "interval 1 month", "year": "interval 1 year"}


def snapshot_intervals(
    snapshots: DataFrame, keys: Sequence[str], snapshot_date: str, updated: str,
    values: Sequence[str],
) -> DataFrame:
    """(keys, values, _day, _from, _to): one interval per snapshot day, open ends NULL.

    Of several snapshots of one day the newest update counts, an unset update time ranking
    newest. Snapshots without a key or date are left out.
    """
    dated = snapshots.select(
        *keys, F.col(snapshot_date).cast("date").alias("_day"), updated, *values
    ).where(all_not_null([*keys, "_day"]))
    newest = one_per_key(dated, [*keys, "_day"], [*null_high(updated), *null_high(*values)], "last")
    # One row per key and day is left, so a window partition holds at most a calendar of days.
    days = Window.partitionBy(*keys).orderBy("_day")
    return newest.select(
        *keys,
        *values,
        "_day",
        F.when(F.lag("_day").over(days).isNotNull(), F.col("_day")).alias("_from"),
        F.lead("_day").over(days).alias("_to"),
    )


def join_nearest_snapshot(
    facts: DataFrame,
    snapshots: DataFrame,
    keys: Sequence[str],
    date: str,
    snapshot_date: str,
    updated: str,
    values: Sequence[str],
    day_column: str | None = None,
    slot: str = "month",
) -> DataFrame:
    """Facts with the nearest snapshot's values, NULL where the key has no snapshot.

    ``day_column`` names an extra output for the chosen snapshot's day. Facts without a key or
    date find nothing. ``slot`` (week, month, year) sets how finely a key is spread.
    """
    asked = join_nearest_snapshots(
        [facts], snapshots, keys, date, snapshot_date, updated, values, day_column, slot
    )
    return asked[0]


def join_nearest_snapshots(
    facts: Sequence[DataFrame],
    snapshots: DataFrame,
    keys: Sequence[str],
    date: str,
    snapshot_date: str,
    updated: str,
    values: Sequence[str],
    day_column: str | None = None,
    slot: str = "month",
) -> list[DataFrame]:
    """``join_nearest_snapshot`` for several tables of facts. The intervals are found once and kept
    in the shared folder, so the tables can also be written one by one; constant columns of a table
    do not travel, as they would in a union."""
    extra = [day_column] if day_column else []
    intervals = snapshot_intervals(snapshots, keys, snapshot_date, updated, values)
    if len(facts) > 1:
        intervals = settle(intervals)
    if day_column:
        intervals = intervals.withColumn(day_column, F.col("_day"))

    def slot_of(day: Column) -> Column:
        return F.trunc(day, slot)

    # Facts outside the snapshots' calendar use its first or last slot, where the open intervals are.
    span = snapshots.agg(
        slot_of(F.min(F.col(snapshot_date).cast("date"))).alias("low"),
        slot_of(F.max(F.col(snapshot_date).cast("date"))).alias("high"),
    ).first()
    low, high = (F.lit(span["low"]).cast("date"), F.lit(span["high"]).cast("date"))
    slots = F.sequence(
        F.coalesce(slot_of(F.col("_from")), low),
        F.coalesce(slot_of(F.date_sub("_to", 1)), high),
        F.expr(_STEP[slot]),
    )
    # The planner takes the intervals for as small as the snapshots' files, but each is repeated once
    # per slot: without the hint the driver would collect them for a broadcast.
    cut = intervals.select(
        *keys, *values, *extra, "_from", "_to", F.explode(slots).alias("_slot")
    ).hint("merge").alias("i")

    day = F.col(date).cast("date")
    slotted = F.when(day.isNotNull(), F.least(F.greatest(slot_of(day), low), high))
    on_day = F.col(f"f.{date}").cast("date")
    same = [F.col(f"f.{c}") == F.col(f"i.{c}") for c in [*keys, "_slot"]]
    inside = [
        F.col("i._from").isNull() | (on_day >= F.col("i._from")),
        F.col("i._to").isNull() | (on_day < F.col("i._to")),
    ]
    matches = reduce(lambda a, b: a & b, [*same, *inside])
    return [
        rows.withColumn("_slot", slotted).alias("f").join(cut, matches, "left").select(
            *[F.col(f"f.{c}") for c in rows.columns],
            *[F.col(f"i.{c}") for c in [*values, *extra]],
        )
        for rows in facts
    ]


def nearest_snapshot(
    probes: DataFrame, snapshots: DataFrame, keys: Sequence[str], date: str, snapshot_date: str,
    updated: str, values: Sequence[str], day_column: str = "snapshot_day",
) -> DataFrame:
    """The lookup table itself: each distinct (key, day) asked, with its snapshot."""
    asked = (
        probes.select(*keys, F.col(date).cast("date").alias(date))
        .where(all_not_null([*keys, date]))
        .distinct()
    )
    found = join_nearest_snapshot(
        asked, snapshots, keys, date, snapshot_date, updated, values, day_column
    )
    return found.where(F.col(day_column).isNotNull())
