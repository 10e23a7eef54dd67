"""Data registry: current entries, archived history, patches, bulk registration, queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.skew import all_not_null, next_in_key, one_per_key
from martloom.sources.queries import optional_filter, page

KEY = ["client_id", "data_type", "source_id"]
SORTABLE = ["processed_at", "source_updated_at", "run_id", "client_id", "data_type", "source_id"]


def current_entries(registrations: DataFrame) -> DataFrame:
    """The newest registration per (client, type, source)."""
    return one_per_key(registrations, KEY, ["processed_at", "run_id"], "last")


def archived_entries(registrations: DataFrame, grain: str = "day") -> DataFrame:
    """Every superseded registration with the run that archived it.

    ``grain`` is the time slot used to spread one key's registrations over tasks.
    """
    led = next_in_key(
        registrations, KEY, "processed_at", "run_id", "run_id", "archived_by_run_id", grain
    )
    return led.where(F.col("archived_by_run_id").isNotNull())


def patch_entries(registry: DataFrame, patches: DataFrame) -> DataFrame:
    """Registry after updates keyed by (client, run).

    Given fields overwrite; a missing ``source_updated_at`` or ``metadata`` keeps the old value.
    Unknown keys are added. Several patches of one key apply in ``processed_at`` order.
    """
    keys = ["client_id", "run_id"]
    plain = [c for c in registry.columns if c not in [*keys, "source_updated_at", "metadata"]]

    def given(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("processed_at")))

    merged = patches.groupBy(*keys).agg(
        F.max_by(F.struct(*plain), "processed_at").alias("_new"),
        given("source_updated_at").alias("_source_updated_at"),
        given("metadata").alias("_metadata"),
    )
    # A NULL key matches nothing, so its rows stay out of the join and cannot meet in one task.
    keyed = all_not_null(keys)
    joined = registry.where(keyed).join(merged.where(keyed), keys, "full")
    unmatched = merged.where(~keyed).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in registry.schema.fields if f.name not in keys}
    )
    hit = F.col("_new").isNotNull()
    kept = {"data_type", "source_id"}

    def out(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in plain:
            new = F.col(f"_new.{c}")
            value = F.coalesce(F.col(c), new) if c in kept else F.when(hit, new).otherwise(F.col(c))
            return value.alias(c)
        return F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c)

    changed = joined.unionByName(unmatched).select(*[out(c) for c in registry.columns])
    return changed.unionByName(registry.where(~keyed))


def bulk_rows(
    records: DataFrame, required: Sequence[str], processed_at: datetime, is_current: bool = True
) -> DataFrame:
    """Records ready to append: required columns checked, defaults set, metadata as JSON text."""
    missing = [c for c in required if c not in records.columns]
    if missing:
        raise ValueError(f"records lack required columns {missing}")
    defaults = {
        "processed_at": F.lit(processed_at).cast("timestamp_ntz"),
        "is_current": F.lit(is_current),
    }
    filled = {
        c: F.coalesce(F.col(c), value) if c in records.columns else value
        for c, value in defaults.items()
    }
    if "metadata" in records.columns and isinstance(
        records.schema["metadata"].dataType, (T.StructType, T.MapType, T.ArrayType)
    ):
        filled["metadata"] = F.to_json("metadata")
    return records.withColumns(filled)


def query_registry(
    registry: DataFrame,
    filters: Mapping[str, Any] | None = None,
    sort_by: str = "processed_at",
    descending: bool = True,
    limit: int | None = 100,
    offset: int = 0,
    metadata_schema: str | None = None,
) -> DataFrame:
    """Filtered, sorted page of the registry; metadata parsed when its schema is given."""
    chosen = optional_filter(
        registry, [(v, F.col(c) == v) for c, v in (filters or {}).items()]
    )
    paged = page(chosen, sort_by, SORTABLE, descending, limit, offset, tiebreak=["run_id"])
    if metadata_schema is None:
        return paged
    return paged.withColumn("metadata", F.from_json("metadata", metadata_schema))
