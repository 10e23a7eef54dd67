"""Type inference and key discovery from values: one aggregate pass over all columns.

Each profile is lazy and gives one row per column; the data is read once, partial results are
combined map-side, and only the small profile row reaches the last task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import convert
from martloom.functions.cleaning import number, stripped
from martloom.operators.skew import all_not_null

# The limits of the type rules.
SMALLINT_MAX, INTEGER_MAX = 32767, 2147483647
NUMERIC_MAX, NUMERIC_DIGITS = 1000000, 15
VARCHAR_MAX, VARCHAR_EMPTY = 1000, 255
# Key names tried in order, and the parts of composite keys of child tables.
KEY_NAMES = ["id", "{table}_id", "key", "code", "orderId", "order_id"]
BASE_KEY_NAMES = ["{base}_id", "{base}Id"]
CHILD_WORDS = ["item", "line", "detail"]
PARENT_KEYS = ["order_id", "orderId", "parent_id", "parentId", "header_id", "headerId"]
CHILD_KEYS = [
    "line_no", "lineNo", "item_id", "itemId", "detail_id", "detailId", "line_number",
    "lineNumber", "lineno",
]


def _scale(value: Column) -> Column:
    """Digits after the point of a double, at least one (whole values print as ``12.0``)."""
    # One more, so that the text has no exponent; from NUMERIC_MAX on the type has no scale.
    text = (F.abs(value).try_cast("decimal(28,20)") + F.lit(1)).cast("string")
    digits = F.length(F.rtrim(F.substring_index(text, ".", -1), F.lit("0")))
    bounded = F.least(F.greatest(digits, F.lit(1)), F.lit(NUMERIC_DIGITS))
    return F.when(value == F.rint(value), 1).when(F.abs(value) < NUMERIC_MAX, bounded)


def _parts(df: DataFrame) -> DataFrame:
    """Per column its filled text (``_f``) and its number (``_v``), each worked out once."""
    text, value = {}, {}
    for i, f in enumerate(df.schema.fields):
        if isinstance(f.dataType, T.StringType):
            text[f"_f{i}"] = F.nullif(stripped(F.col(f.name)), F.lit(""))
            value[f"_v{i}"] = number(F.col(f"_f{i}"))
        elif isinstance(f.dataType, T.NumericType):
            value[f"_v{i}"] = number(F.col(f.name))
    df = df.withColumns(text) if text else df
    return df.withColumns(value) if value else df


def _value_stats(i: int, field: T.StructField) -> dict[str, Column]:
    col, kind = F.col(field.name), field.dataType
    filled, value = F.col(f"_f{i}"), F.col(f"_v{i}")
    stats = {"nulls": F.count_if(col.isNull()), "seen": F.count(col)}
    if isinstance(kind, (T.StringType, T.NumericType)):
        stats |= {"top": F.max(F.abs(value)), "scale": F.max(_scale(value))}
    if isinstance(kind, T.StringType):
        stats |= {
            "filled": F.count(filled),
            "numeric": F.count(value),
            "whole": F.count_if(value == F.rint(value)),
            "length": F.max(F.when(filled.isNotNull(), F.length(col))),
            "json": F.count_if(
                (col.startswith("{") | col.startswith("["))
                & F.try_parse_json(col).isNotNull()
            ),
        }
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        stats |= {"timed": F.count_if(F.date_trunc("day", col) != col)}
    return stats


def _int_rule(top: Column) -> Column:
    return (
        F.when(top < SMALLINT_MAX, "smallint")
        .when(top < INTEGER_MAX, "integer")
        .otherwise("bigint")
    )


def _float_rule(top: Column, scale: Column) -> Column:
    digits = F.least(F.length(F.floor(top).cast("string")) + scale, F.lit(NUMERIC_DIGITS))
    numeric = F.format_string("numeric(%d,%d)", F.greatest(digits, scale), scale)
    return F.when((scale > 0) & (top < NUMERIC_MAX), numeric).otherwise("double precision")


def _type_rule(kind: T.DataType, s: Mapping[str, Column]) -> Column:
    if isinstance(kind, T.StringType):
        width = F.least(F.floor(s["length"] * 1.5), F.lit(VARCHAR_MAX))
        text = F.when(s["length"] > VARCHAR_MAX, "text").otherwise(
            F.format_string("character varying(%d)", F.greatest(width, F.lit(1)))
        )
        return (
            F.when(s["seen"] == 0, "text")
            .when(s["filled"] == 0, f"character varying({VARCHAR_EMPTY})")
            .when((s["numeric"] == s["filled"]) & (s["whole"] == s["filled"]), _int_rule(s["top"]))
            .when(s["numeric"] == s["filled"], _float_rule(s["top"], s["scale"]))
            .when(s["json"] == s["seen"], "jsonb")
            .otherwise(text)
        )
    if isinstance(kind, T.IntegralType):
        return F.when(s["seen"] == 0, "integer").otherwise(_int_rule(s["top"]))
    if isinstance(kind, T.NumericType):
        rule = _float_rule(s["top"], s["scale"])
        return F.when(s["top"].isNull(), "double precision").otherwise(rule)
    if isinstance(kind, T.BooleanType):
        return F.lit("boolean")
    if isinstance(kind, T.DateType):
        return F.lit("date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.when((s["seen"] == 0) | (s["timed"] > 0), "timestamp").otherwise("date")
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.lit("jsonb")
    return F.lit("text")


def infer_types(df: DataFrame) -> DataFrame:
    """One row per column: the narrowest safe warehouse type, and whether NULLs occur.

    All values count, not a sample, so the answer is the same on every run.
    """
    fields = df.schema.fields
    stats = [_value_stats(i, f) for i, f in enumerate(fields)]
    profile = _parts(df).agg(*[c.alias(f"{k}_{i}") for i, s in enumerate(stats) for k, c in s.items()])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            _type_rule(f.dataType, {k: F.col(f"{k}_{i}") for k in s}).alias("inferred_type"),
            (F.col(f"nulls_{i}") > 0).alias("nullable"),
        )
        for i, (f, s) in enumerate(zip(fields, stats))
    ]
    return profile.select(F.inline(F.array(*rows)))


def _sheet_stats(i: int) -> dict[str, Column]:
    filled, value = F.col(f"_f{i}"), F.col(f"_v{i}")
    return {
        "filled": F.count(filled),
        "flags": F.count_if(F.lower(filled).isin("true", "false")),
        "numeric": F.count(value),
        "whole": F.count_if(value == F.rint(value)),
        "dates": F.count(filled.try_cast("timestamp_ntz")),
    }


def _sheet_rule(s: Mapping[str, Column]) -> Column:
    whole = F.when(s["whole"] == s["filled"], "BIGINT").otherwise("DOUBLE PRECISION")
    return (
        F.when(s["filled"] == 0, "TEXT")
        .when(s["flags"] == s["filled"], "BOOLEAN")
        .when(s["numeric"] == s["filled"], whole)
        .when(s["dates"] == s["filled"], "TIMESTAMP")
        .otherwise("TEXT")
    )


def infer_sheet_types(df: DataFrame) -> DataFrame:
    """One row per worksheet column: BOOLEAN, BIGINT, DOUBLE PRECISION, TIMESTAMP or TEXT, judged
    on the cells that are not blank."""
    stats = [_sheet_stats(i) for i in range(len(df.columns))]
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])
    profile = _parts(text).agg(*[c.alias(f"{k}_{i}") for i, s in enumerate(stats) for k, c in s.items()])
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            _sheet_rule({k: F.col(f"{k}_{i}") for k in s}).alias("inferred_type"),
        )
        for i, (name, s) in enumerate(zip(df.columns, stats))
    ]
    return profile.select(F.inline(F.array(*rows)))


def sheet_types(df: DataFrame) -> dict[str, str]:
    """``infer_sheet_types`` as a mapping (one small row per column)."""
    return {r["column_name"]: r["inferred_type"] for r in infer_sheet_types(df).toLocalIterator()}


def coerce_sheet(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Blank cells to NULL, then each column to its inferred type, bad values to NULL."""

    def coerced(c: str) -> Column:
        kind = types.get(c)
        if kind is None:
            return F.col(c)
        text = F.col(c).cast("string")
        filled = F.when(stripped(text) != "", text)
        if kind == "BIGINT":
            return convert.to_int(stripped(filled)).alias(c)
        if kind == "DOUBLE PRECISION":
            return number(stripped(filled)).alias(c)
        if kind == "BOOLEAN":
            flag = F.lower(stripped(filled))
            return F.when(flag == "true", True).when(flag == "false", False).alias(c)
        if kind == "TIMESTAMP":
            return stripped(filled).try_cast("timestamp_ntz").alias(c)
        return filled.alias(c)

    return df.select(*[coerced(c) for c in df.columns])


def key_candidates(columns: Sequence[str], table: str) -> tuple[list[str], list[tuple[str, str]]]:
    """Candidate keys by name: single columns in order, and (parent, child) pairs."""
    names = [n.format(table=table) for n in KEY_NAMES]
    if "_" in table:
        names += [n.format(base=table.split("_")[0]) for n in BASE_KEY_NAMES]
    singles = [n for n in dict.fromkeys(names) if n in columns]
    pairs = []
    if any(word in table.lower() for word in CHILD_WORDS):
        pairs = [(p, c) for p in PARENT_KEYS for c in CHILD_KEYS if p in columns and c in columns]
    return singles, pairs


def key_report(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Per candidate key: rows, NULL-key rows, distinct keys, and whether it is a key.

    Distinct keys are counted by grouping (map-side combined), one narrow scan per candidate.
    """
    out = None
    for keys in candidates:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        usable = all_not_null(keys)
        one = per_key.agg(
            F.lit("+".join(keys)).alias("key_columns"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.when(~usable, F.col("n"))), F.lit(0)).alias("null_rows"),
            F.count_if(usable).alias("distinct_keys"),
        )
        out = one if out is None else out.unionByName(one)
    return out.withColumn(
        "is_key", (F.col("null_rows") == 0) & (F.col("distinct_keys") == F.col("total_rows"))
    )


def is_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Exact: no NULL and no repeated key; stops at the first repeat found."""
    against = ~all_not_null(keys) | (F.col("_n") > 1)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(against).isEmpty()


# Relative standard deviation of the sketches that screen candidate keys, and how many of them a
# count may be off before a candidate counts as failed.
SKETCH_ERROR, SKETCH_SPREAD = 0.02, 6


def may_be_keys(df: DataFrame, candidates: Sequence[Sequence[str]]) -> list[bool]:
    """For each candidate whether it can be a key, in one scan of its columns.

    It cannot when a key column is NULL anywhere, or when the sketch (HyperLogLog) of its values
    counts fewer than the rows by more than six times its error. A candidate that fails exactly
    may pass here, never the other way, but for a chance of about one in a billion.
    """
    if not candidates:
        return []
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, keys in enumerate(candidates):
        value = F.when(all_not_null(keys), F.xxhash64(*keys))
        measures.append(F.count(value).alias(f"filled_{i}"))
        measures.append(F.approx_count_distinct(value, SKETCH_ERROR).alias(f"about_{i}"))
    row = df.agg(*measures).first()
    least = row["rows"] * (1 - SKETCH_SPREAD * SKETCH_ERROR)
    return [row[f"filled_{i}"] == row["rows"] and row[f"about_{i}"] >= least for i in range(len(candidates))]


def discover_keys(df: DataFrame, table: str) -> dict[str, list[str] | None]:
    """The first single-column key and the first composite key that hold. One scan screens all
    candidates; only those that may hold are checked exactly, one shuffle each."""
    singles, pairs = key_candidates(df.columns, table)
    candidates = [[c] for c in singles] + [list(p) for p in pairs]
    passed = dict(zip(map(tuple, candidates), may_be_keys(df, candidates)))
    held = lambda keys: passed[tuple(keys)] and is_key(df, list(keys))
    primary = next(([c] for c in singles if held([c])), None)
    composite = next((list(p) for p in pairs if held(p)), None)
    return {"primary": primary, "composite": composite}
