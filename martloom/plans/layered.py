"""A layered run: raw drop, typed Parquet, keyed load, mart refresh, each step in the run ledger."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.refresh import refresh_result
from martloom.operators.schema import apply_schema
from martloom.session import shuffles_released
from martloom.sources.files import read_csv_drop
from martloom.sources.publish import VersionedTable
from martloom.sources.run_log import RunLog
from martloom.sources.tables import load_table, write_parquet

# Every step's output stays, so all are written small.
CODEC = "zstd"


def layered_run(
    spark: SparkSession,
    drop: str,
    root: str,
    raw_schema: str,
    declared: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str],
    business_keys: Sequence[str],
    mart: Callable[[DataFrame], DataFrame | Sequence[DataFrame]],
    log: RunLog,
    pipeline_name: str,
) -> DataFrame:
    """Load a CSV drop into the table below ``root`` and refresh the mart built on it.

    ``mart`` may give the mart in parts with equal columns. They are written one after another and
    published as one, so that the shuffles of one part take disk at a time.
    """
    with shuffles_released(spark):
        return _run(
            spark, drop, root, raw_schema, declared, keys, business_keys, mart, log, pipeline_name
        )


def _run(
    spark: SparkSession, drop: str, root: str, raw_schema: str,
    declared: Mapping[str, Mapping[str, Any]], keys: Sequence[str], business_keys: Sequence[str],
    mart: Callable[[DataFrame], DataFrame | Sequence[DataFrame]], log: RunLog, pipeline_name: str,
) -> DataFrame:
    run_id = log.start_run(pipeline_name, "all", "csv")
    table, result = VersionedTable(spark, f"{root}/table"), VersionedTable(spark, f"{root}/mart")
    typed_path = f"{root}/typed/{run_id}"
    try:
        with log.step(run_id, "type") as outcome:
            raw = read_csv_drop(spark, drop, raw_schema)
            write_parquet(apply_schema(raw, declared), typed_path, CODEC)
            outcome["output_location"] = typed_path
        with log.step(run_id, "load") as outcome:
            typed = spark.read.parquet(typed_path)
            if not table.exists():
                table.publish(typed.limit(0))
            loaded = load_table(table, typed, keys, business_keys, compression=CODEC)
            if not loaded["success"]:
                raise ValueError(loaded["message"])
            outcome["record_count"] = (loaded["counts"] or {}).get("inserted_count", 0)
        with log.step(run_id, "mart"):
            refresh_result(result, lambda: mart(table.read()), compression=CODEC)
    except Exception as problem:
        log.complete(run_id, "failed", error=str(problem).splitlines()[0])
        raise
    log.complete(run_id, "success", record_count=outcome.get("record_count"))
    return result.read()
