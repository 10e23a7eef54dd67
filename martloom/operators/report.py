"""Report tables: display columns, formats, total row, top-n and threshold marks, progress.

Reports work on grouped results (one row per brand, channel, ...), which grow with the number of
groups, not with the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.formats import format_cell

TOTALS = {"sum": F.sum, "mean": F.avg, "median": F.median, "min": F.min, "max": F.max}


def display(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Chosen columns under their display names."""
    return df.select(*[F.col(c).alias(name) for c, name in columns.items()])


def format_columns(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Formatted text in place of the listed columns."""
    return df.withColumns({c: format_cell(F.col(c), spec) for c, spec in formats.items()})


def with_total_row(
    df: DataFrame,
    calculations: Mapping[str, str | Column] | None = None,
    label: str = "Grand Total",
    marker: str = "is_total",
) -> DataFrame:
    """Append a total row. A calculation is sum, mean, median, min, max or a Column over the
    rows (for example a ratio of sums); by default every numeric column is summed.

    The label goes to the first column; other text cells are empty, other cells NULL. ``marker``
    tells the total from the data, as rows have no order.
    """
    fields = df.schema.fields
    if calculations is None:
        calculations = {f.name: "sum" for f in fields if isinstance(f.dataType, T.NumericType)}
    first = df.columns[0]

    def total(f: T.StructField) -> Column:
        if f.name == first:
            return F.lit(label).alias(f.name)
        calculation = calculations.get(f.name)
        if calculation is None:
            empty = F.lit("") if isinstance(f.dataType, T.StringType) else F.lit(None)
            return empty.cast(f.dataType).alias(f.name)
        if isinstance(calculation, str):
            calculation = TOTALS[calculation](f.name)
        return calculation.alias(f.name)

    rows = df.withColumn(first, F.col(first).cast("string")).withColumn(marker, F.lit(False))
    return rows.unionByName(df.agg(*[total(f) for f in fields]).withColumn(marker, F.lit(True)))


def flag_top(
    df: DataFrame, column: str, n: int, key: Sequence[str], flag: str = "is_top"
) -> DataFrame:
    """Flag the ``n`` largest values, NULL lowest, ties settled by the row key.

    The n winners come from a distributed top-n; their size decides how they are joined.
    """
    best = df.orderBy(F.desc_nulls_last(column), *key).limit(n).select(*key)
    marked = best.withColumn(flag, F.lit(True)).alias("b")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    joined = df.alias("r").join(marked, same, "left")
    return joined.select("r.*", F.coalesce(F.col(f"b.{flag}"), F.lit(False)).alias(flag))


def threshold_code(c: Column, threshold: float = 0) -> Column:
    return (
        F.when(c > threshold, "above").when(c < threshold, "below").when(c == threshold, "equal")
    )


def flag_rows(df: DataFrame, condition: Column, flag: str = "flagged") -> DataFrame:
    """Mark the rows for which a condition over any columns holds."""
    return df.withColumn(flag, F.coalesce(condition, F.lit(False)))


def progress(c: Column, low: float = 0, high: float = 100) -> Column:
    """Position between ``low`` and ``high`` in percent, kept within 0 and 100."""
    share = (c.cast("double") - low) / (high - low) * 100
    return F.when(c.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), share)))
