"""Schema checks: a file against a table, and the catalog as a declared schema."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fields that come from the directory layout and may be absent in a file.
LAYOUT_FIELDS = {"year", "month", "day", "hour"}


def family(kind: T.DataType) -> str:
    """Types of one family can be loaded into each other."""
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "number"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return kind.simpleString()


def schema_findings(spark: SparkSession, file: T.StructType, table: T.StructType) -> DataFrame:
    """One row per difference: column, finding, and whether it makes the file unfit."""
    return spark.createDataFrame(
        _findings(file, table),
        "column_name string, finding string, file_type string, table_type string, fails boolean",
    )


def compatible(file: T.StructType, table: T.StructType) -> list[str]:
    """The failing differences as messages; empty when the file can be loaded."""
    return [f"{c}: {what}" for c, what, _, _, fails in _findings(file, table) if fails]


def _findings(file: T.StructType, table: T.StructType) -> list[tuple[Any, ...]]:
    have = {f.name.lower(): f for f in file.fields}
    want = {f.name.lower(): f for f in table.fields}
    rows: list[tuple[Any, ...]] = []
    for name, field in want.items():
        kind = field.dataType.simpleString()
        if name not in have:
            fails = not field.nullable and name not in LAYOUT_FIELDS
            rows.append((name, "missing in file", None, kind, fails))
        elif family(have[name].dataType) != family(field.dataType):
            rows.append((name, "type differs", have[name].dataType.simpleString(), kind, True))
    for name, field in have.items():
        if name not in want:
            rows.append((name, "extra in file", field.dataType.simpleString(), None, False))
    return rows


def catalog_schema(spark: SparkSession, table: str) -> dict[str, dict[str, Any]]:
    """A catalog table as a declared schema: column to type and nullability."""
    return {
        f.name: {"type": f.dataType.simpleString(), "nullable": f.nullable}
        for f in spark.table(table).schema.fields
    }
