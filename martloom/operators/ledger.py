"""Run-ledger analytics over ``runs`` and ``steps`` tables kept as append-only events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.skew import one_per_key
from martloom.sources.queries import optional_filter


def seconds(start: str, end: str) -> Column:
    """Exact seconds between two timestamps, microseconds included."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1000000.0)


def _after(now: datetime, days: int) -> Column:
    return F.col("start_time") > F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {days} days")


def runs_recent(
    runs: DataFrame, now: datetime, days: int = 7, client_id=None, pipeline_name=None,
    data_type=None, status=None, limit: int = 100,
) -> DataFrame:
    """The newest runs of the last days with their duration."""
    chosen = optional_filter(
        runs.where(_after(now, days)),
        [
            (client_id, F.col("client_id") == client_id),
            (pipeline_name, F.col("pipeline_name") == pipeline_name),
            (data_type, F.col("data_type") == data_type),
            (status, F.col("status") == status),
        ],
    )
    timed = chosen.withColumn("duration_seconds", seconds("start_time", "end_time"))
    return timed.orderBy(F.desc("start_time"), "run_id").limit(limit)


def run_metrics(
    runs: DataFrame, now: datetime, days: int = 30, client_id=None, pipeline_name=None
) -> DataFrame:
    """Counts, success rate, durations and throughput of finished runs per pipeline."""
    finished = optional_filter(
        runs.where(_after(now, days) & F.col("end_time").isNotNull()),
        [
            (client_id, F.col("client_id") == client_id),
            (pipeline_name, F.col("pipeline_name") == pipeline_name),
        ],
    ).withColumn("_micros", F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")))
    stats = finished.groupBy("pipeline_name", "client_id", "data_type").agg(
        F.count(F.lit(1)).alias("run_count"),
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failure_count"),
        (F.sum("_micros").cast("double") / F.count("_micros") / 1e6).alias("avg_duration_seconds"),
        (F.max("_micros") / F.lit(1e6)).alias("max_duration_seconds"),
        (F.min("_micros") / F.lit(1e6)).alias("min_duration_seconds"),
        F.sum("record_count").alias("total_records"),
        F.avg("record_count").alias("avg_records"),
    )
    per_second = F.try_divide(F.col("total_records").cast("double"), F.col("avg_duration_seconds"))
    rate = F.try_divide(F.col("success_count").cast("double"), F.col("run_count")) * 100
    return stats.withColumns({"success_rate": rate, "avg_records_per_second": per_second})


def run_state(events: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Current state of every run (or step) from its events (event_time, event_seq, status, ...):
    start and end, and the last value given for every other field."""
    order = ["event_time", "event_seq"]

    def latest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)

    ended = F.col("status") != "running"
    return events.groupBy(*keys).agg(
        F.min("event_time").alias("start_time"),
        F.max(F.when(ended, F.col("event_time"))).alias("end_time"),
        *[latest(c) for c in events.columns if c not in [*keys, *order]],
    )


def latest_step(steps: DataFrame, status: str = "success", step_name: str | None = None) -> DataFrame:
    """Per run: its last started step with the given status."""
    chosen = optional_filter(
        steps.where(F.col("status") == status), [(step_name, F.col("step_name") == step_name)]
    )
    return one_per_key(chosen, ["run_id"], ["start_time", "step_id"], "last")


def run_steps(
    steps: DataFrame, run_id, step_name=None, step_id=None, status=None
) -> DataFrame:
    """All steps of a run, oldest first."""
    chosen = optional_filter(
        steps.where(F.col("run_id") == run_id),
        [
            (step_name, F.col("step_name") == step_name),
            (step_id, F.col("step_id") == step_id),
            (status, F.col("status") == status),
        ],
    )
    return chosen.orderBy("start_time", "step_id")


def event(df: DataFrame, status: str, columns: Sequence[str]) -> DataFrame:
    """Rows as ledger events of one status; fields not named are NULL."""
    kinds = {"record_count": "bigint", "error": "string"}
    return df.select(
        "run_id",
        "event_time",
        "event_seq",
        F.lit(status).alias("status"),
        *[F.col(c) if c in columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()],
    )
