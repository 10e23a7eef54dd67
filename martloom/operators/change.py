"""Table-change operators: pure functions from (target, staging) to the new table.

Keys compare with ``=``: a NULL key never matches, so old NULL-key rows stay and new ones are
added. Staging duplicates are all inserted. Publishing the result is a separate step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.skew import all_not_null, thin_keys, with_keys, without_keys


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _need(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


def by_position(staging: DataFrame, target: DataFrame) -> DataFrame:
    """Staging columns take the target's names and types by position."""
    if len(staging.columns) != len(target.columns):
        raise ValueError("staging and target differ in their number of columns")
    renamed = staging.toDF(*target.columns)
    return renamed.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])


def by_name(staging: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staging in the target's layout: shared columns by name, the others NULL.

    Staging-only columns are ignored. Raises when nothing is shared or a key is missing.
    """
    shared = {c for c in target.columns if c in staging.columns}
    if not shared:
        raise ValueError("staging and target share no column")
    missing = [k for k in keys if k not in shared]
    if missing:
        raise ValueError(f"key columns {missing} are not in both tables")
    return staging.select(
        *[
            (F.col(f.name) if f.name in shared else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def replace_by_position(
    target: DataFrame, staging: DataFrame, keys: str | Sequence[str]
) -> DataFrame:
    """Keyed replace, columns matched by position."""
    keys = _as_list(keys)
    _need(target, keys, "target")
    rows = by_position(staging, target)
    return without_keys(target, rows, keys).union(rows)


def replace_by_name(target: DataFrame, staging: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keyed replace, columns matched by name in the target's order."""
    keys = _as_list(keys)
    rows = by_name(staging, target, keys)
    return without_keys(target, rows, keys).unionByName(rows)


def replace_mapped(
    target: DataFrame, staging: DataFrame, keys: str | Sequence[str], mapping: Mapping[str, str]
) -> DataFrame:
    """Keyed replace after renaming staging columns; pairs unknown on either side are dropped."""
    pairs = {s: t for s, t in mapping.items() if s in staging.columns and t in target.columns}
    if not pairs:
        raise ValueError("the column mapping names no known column")
    renamed = staging.select(*[F.col(s).alias(t) for s, t in pairs.items()])
    return replace_by_name(target, renamed, keys)


def delete_groups(
    target: DataFrame, staging: DataFrame, business_keys: str | Sequence[str]
) -> DataFrame:
    """Drop every target row whose business key appears in staging."""
    keys = _as_list(business_keys)
    _need(target, keys, "target")
    _need(staging, keys, "staging")
    return without_keys(target, staging, keys)


def load(
    target: DataFrame,
    staging: DataFrame,
    keys: str | Sequence[str],
    business_keys: str | Sequence[str] | None = None,
    match: str = "name",
) -> DataFrame:
    """Group replace when business keys are given, then keyed replace, as one new table."""
    base = delete_groups(target, staging, business_keys) if business_keys else target
    replace = replace_by_name if match == "name" else replace_by_position
    return replace(base, staging, keys)


def update_or_insert(
    target: DataFrame,
    staging: DataFrame,
    keys: str | Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """On a key match set only ``update_columns`` (default: all non-key), else insert.

    A key repeated in staging fails the job with its row count. The check rides on the shuffle
    that the join needs. NULL keys insert and skip the join, so they cannot pile up in one task.
    """
    keys = _as_list(keys)
    _need(staging, keys, "staging")
    rest = [c for c in target.columns if c not in keys]
    shared = [c for c in rest if c in staging.columns]
    updates = [c for c in (update_columns or shared) if c in shared]

    rows = by_name(staging, target, keys)
    keyed, loose = all_not_null(keys), ~all_not_null(keys)
    grouped = rows.where(keyed).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.any_value(F.struct(F.lit(True).alias("_hit"), *rest)).alias("_s"),
    )
    checked = grouped.select(
        *keys,
        F.when(
            F.col("_n") > 1,
            F.raise_error(F.concat(F.lit("staging key repeats, rows: "), F.col("_n"))).cast(
                grouped.schema["_s"].dataType
            ),
        ).otherwise(F.col("_s")).alias("_s"),
    )
    base = target.where(keyed).select(*keys, F.struct(F.lit(True).alias("_hit"), *rest).alias("_t"))
    joined = base.join(checked, keys, "full")

    def merged(c: str) -> Column:
        new, old = F.col(f"_s.`{c}`"), F.col(f"_t.`{c}`")
        if c in updates:
            return F.when(F.col("_s").isNotNull(), new).otherwise(old).alias(c)
        return F.when(F.col("_t").isNotNull(), old).otherwise(new).alias(c)

    result = joined.select(*[F.col(c) if c in keys else merged(c) for c in target.columns])
    return result.unionByName(target.where(loose)).unionByName(rows.where(loose))


def merge_on_key(target: DataFrame, staging: DataFrame, key: str | None = None) -> DataFrame:
    """Single-key replace by name; without a key a plain append."""
    if key is None:
        return append_rows(target, staging)
    return replace_by_name(target, staging, [key])


def append_rows(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Move all staging rows into the target, by position."""
    return target.union(by_position(staging, target))


def replace_slice(target: DataFrame, predicate: Column, rows: DataFrame) -> DataFrame:
    """Delete the rows for which ``predicate`` is true, add the replacement rows."""
    kept = target.where(~F.coalesce(predicate, F.lit(False)))
    return kept.unionByName(rows)


def change_counts(target: DataFrame, staging: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: staging, deleted and inserted counts of a keyed replace."""
    keys = _as_list(keys)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    staged = staging.select(one.alias("staging_count"), zero.alias("deleted_count"))
    dropped = with_keys(target.select(*keys), staging, keys).select(
        zero.alias("staging_count"), one.alias("deleted_count")
    )
    return staged.unionByName(dropped).agg(
        F.coalesce(F.sum("staging_count"), zero).alias("staging_count"),
        F.coalesce(F.sum("deleted_count"), zero).alias("deleted_count"),
        F.coalesce(F.sum("staging_count"), zero).alias("inserted_count"),
    )


def stamp_run(df: DataFrame, run_id: str | None) -> DataFrame:
    """Put the run id on every row; no run id, no column."""
    return df if run_id is None else df.withColumn("run_id", F.lit(run_id))


__all__ = [
    "append_rows", "by_name", "by_position", "change_counts", "delete_groups", "load",
    "merge_on_key", "replace_by_name", "replace_by_position", "replace_mapped", "replace_slice",
    "stamp_run", "thin_keys", "update_or_insert",
]
