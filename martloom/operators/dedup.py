"""Keep-last dedup, alone and against an existing dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.skew import in_groups, one_per_key


def keep_last(df: DataFrame, keys: Sequence[str], seq: Sequence[Column | str]) -> DataFrame:
    """The last row per key by an explicit sequence (Spark rows have no order of their own)."""
    return one_per_key(df, keys, seq, "last")


def merge_keep_last(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Existing rows followed by incoming ones, last row per key kept, NULL equal to NULL.

    With ``partition_by`` the dedup stays inside a partition, and only the partitions that the
    incoming rows touch come back, ready for a dynamic partition overwrite.
    """
    old = existing.withColumn("_origin", F.lit(0))
    if partition_by:
        old = in_groups(old, incoming, partition_by)
    both = old.unionByName(incoming.withColumn("_origin", F.lit(1)))
    return keep_last(both, [*partition_by, *keys], ["_origin", *seq]).drop("_origin")
