"""Full refresh of a table from a worksheet-like frame, and refresh of a stored result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import clean_names
from martloom.operators.change import stamp_run
from martloom.operators.inference import coerce_sheet, sheet_types
from martloom.sources.publish import VersionedTable


def reconcile_columns(rows: DataFrame, table: T.StructType) -> DataFrame:
    """Rows under the table's refreshed column set: shared columns keep the table's type and place,
    new ones follow, columns gone from the sheet are dropped."""
    kept = [f for f in table.fields if f.name in rows.columns]
    new = [c for c in rows.columns if c not in table.fieldNames()]
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in kept], *new)


def prepare_sheet(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Clean names, infer and coerce types, stamp the run."""
    named = clean_names(df)
    return stamp_run(coerce_sheet(named, sheet_types(named)), run_id)


def full_refresh(table: VersionedTable, df: DataFrame, run_id: str | None = None) -> dict[str, Any]:
    """Replace the table's rows and column set. Empty input keeps the table as it is.

    Readers switch from the old to the new version at once and never see an empty table.
    """
    if df.isEmpty():
        return {"loaded": False, "version": table.version()}
    rows = prepare_sheet(df, run_id)
    if table.exists():
        rows = reconcile_columns(rows, table.read().schema)
    return {"loaded": True, "version": table.publish(rows)}


def refresh_result(
    table: VersionedTable, build: Callable[[], DataFrame | Sequence[DataFrame]], **options: str
) -> int:
    """Create or refresh a stored query result, whole or in parts: recompute from the current
    definition, switch."""
    return table.publish(build(), **options)
