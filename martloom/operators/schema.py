"""Declared schemas: apply, conform, transform, profile, and text forms.

A declared schema is ``{column: {"type": kind, "nullable": bool, "spark_type": ddl}}`` with kind
one of int, float, bool, datetime, date, str. Every operator here is a single projection.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import convert
from martloom.functions.cleaning import number

# What a missing value becomes in a column that may not be NULL.
FILL = {"int": 0, "float": 0.0, "bool": False}
# Text columns with one of these names hold numbers.
NUMBER_NAMES = [
    "quantity", "qty", "price", "amount", "cost", "rate", "discount", "tax", "total", "subtotal",
    "orderqty", "shippedqty", "returnqty", "cancelledqty", "unitprice", "discountamt", "taxamount",
]


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def apply_schema(df: DataFrame, schema: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Convert the declared columns; others pass through. Bad values become NULL, and NULL
    becomes the type's fill value in columns declared not nullable."""

    def converted(c: str) -> Column:
        spec = schema.get(c)
        kind = spec["type"] if spec else None
        if kind not in convert.CONVERTERS or (kind == "bool" and not _is_text(df, c)):
            return F.col(c)
        value = convert.CONVERTERS[kind](F.col(c))
        if not spec.get("nullable", True) and kind in FILL:
            value = F.coalesce(value, F.lit(FILL[kind]))
        return value.alias(c)

    return df.select(*[converted(c) for c in df.columns])


def conform_types(df: DataFrame, target: T.StructType) -> DataFrame:
    """Give columns the target table's types: list-like text to arrays, nested values to JSON."""
    want = {f.name: f.dataType for f in target.fields}

    def conformed(c: str) -> Column:
        have, kind = df.schema[c].dataType, want.get(c)
        if kind is None or have == kind:
            return F.col(c)
        if isinstance(kind, T.ArrayType) and isinstance(have, T.StringType):
            return convert.array_from_json(F.col(c)).try_cast(kind).alias(c)
        if isinstance(kind, T.StringType) and isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(c).alias(c)
        if isinstance(kind, T.BooleanType) and isinstance(have, T.StringType):
            return convert.to_bool(F.col(c)).alias(c)
        if isinstance(kind, T.IntegralType):
            return convert.to_int(F.col(c)).try_cast(kind).alias(c)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return number(F.col(c)).cast(kind).alias(c)
        return F.col(c).try_cast(kind).alias(c)

    return df.select(*[conformed(c) for c in df.columns])


def conform_values(df: DataFrame, target: T.StructType) -> DataFrame:
    """Convert staged text to the target's types by the looser loading rules."""
    want = {f.name: f.dataType for f in target.fields}

    def loaded(c: str) -> Column:
        kind = want.get(c)
        if isinstance(kind, T.ArrayType):
            as_list = convert.array_from_literal(F.col(c)) if _is_text(df, c) else F.array(c)
            return as_list.alias(c)
        if kind is None or not _is_text(df, c):
            return F.col(c)
        if isinstance(kind, T.IntegralType):
            return convert.int_from_text(F.col(c)).try_cast(kind).alias(c)
        if isinstance(kind, T.BooleanType):
            return convert.flag_from_text(F.col(c)).alias(c)
        if isinstance(kind, T.NumericType):
            return convert.float_from_text(F.col(c)).try_cast(kind).alias(c)
        return F.nullif(F.col(c), F.lit("")).try_cast(kind).alias(c)

    return df.select(*[loaded(c) for c in df.columns])


def transform_columns(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    types: Mapping[str, str | Callable[[Column], Column]] | None = None,
    precision: Mapping[str, int] | None = None,
    custom: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Keep and rename, type, round, and apply column functions, in that order.

    A function takes and returns a Column; wrap Python logic in a ``pandas_udf`` to pass it here.
    """
    if mapping:
        df = df.select(*[F.col(s).alias(t) for s, t in mapping.items() if s in df.columns])
    typed = {
        c: (kind(F.col(c)) if callable(kind) else convert.CONVERTERS[kind](F.col(c)))
        for c, kind in (types or {}).items()
        if c in df.columns
    }
    df = df.withColumns(typed) if typed else df
    rounded = {
        c: (F.bround(c).cast("bigint") if places == 0 else F.bround(c, places))
        for c, places in (precision or {}).items()
        if c in df.columns and isinstance(df.schema[c].dataType, T.NumericType)
    }
    df = df.withColumns(rounded) if rounded else df
    changed = {c: f(F.col(c)) for c, f in (custom or {}).items() if c in df.columns}
    return df.withColumns(changed) if changed else df


def with_audit_columns(
    df: DataFrame, batch_id: str | None, source: str | None, at: Column | None = None
) -> DataFrame:
    """Add inserted and updated times, batch id and source."""
    now = F.current_timestamp() if at is None else at
    return df.withColumns(
        {
            "inserted_at": now,
            "updated_at": now,
            "batch_id": F.lit(batch_id).cast("string"),
            "source": F.lit(source).cast("string"),
        }
    )


def numbers_by_name(df: DataFrame) -> DataFrame:
    """Text columns named like a number (quantity, price, ...) become DECIMAL(10,2)."""
    return df.select(
        *[
            F.col(c).try_cast("decimal(10,2)").alias(c)
            if c.lower() in NUMBER_NAMES and _is_text(df, c)
            else F.col(c)
            for c in df.columns
        ]
    )


def nullability(df: DataFrame) -> DataFrame:
    """Per column: stored type and whether a NULL occurs. One aggregate for all columns."""
    cols = df.columns
    counts = df.agg(*[F.count_if(F.isnull(c)).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                (F.col(f"n{i}") > 0).alias("nullable"),
                F.col(f"n{i}").alias("null_count"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return counts.select(F.inline(rows))


def create_table_ddl(name: str, schema: T.StructType, location: str | None = None) -> str:
    """CREATE TABLE text for a schema."""
    columns = ",\n".join(
        f"  `{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    tail = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE {name} (\n{columns}\n) USING parquet{tail}"


def schema_text(schema: T.StructType) -> str:
    return schema.json()


def schema_from_text(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))
