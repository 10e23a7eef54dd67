"""Query sources: JDBC reads, named-parameter SQL, optional predicates, pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """A database query as a DataFrame, read by ``partitions`` parallel range scans.

    Needs the database's JDBC driver on the class path.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(partitions))
        .load()
    )


def run_named(
    spark: SparkSession, texts: Mapping[str, str], name: str, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Run the SQL text stored under ``name`` with its ``:param`` markers bound."""
    if name not in texts:
        raise KeyError(f"no query named {name!r}")
    return spark.sql(texts[name], args=dict(params or {}))


def optional_filter(df: DataFrame, predicates: Sequence[tuple[Any, Column]]) -> DataFrame:
    """Apply only the predicates whose argument is given."""
    active = [p for value, p in predicates if value is not None]
    return df.where(reduce(lambda a, b: a & b, active)) if active else df


def page(
    df: DataFrame,
    sort_by: str,
    allowed: Sequence[str],
    descending: bool = True,
    limit: int | None = None,
    offset: int = 0,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One page of a sorted listing; the sort column must be on the allow-list."""
    if sort_by not in allowed:
        raise ValueError(f"cannot sort by {sort_by!r}")
    if offset and limit is None:
        raise ValueError("an offset needs a limit")  # alone it would pass every row to one task
    first = F.desc_nulls_first(sort_by) if descending else F.asc_nulls_last(sort_by)
    ordered = df.orderBy(first, *tiebreak)
    ordered = ordered.offset(offset) if offset else ordered
    return ordered.limit(limit) if limit is not None else ordered
