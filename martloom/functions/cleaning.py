"""Scalar cleaning rules as Column expressions (no Python in the tasks)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that mean "no value".
PLACEHOLDERS = ["", "-", "--", "NA", "N/A", "None", "none", "null"]
SHEET_ERRORS = [
    "#N/A", "#N/A!", "#REF!", "#VALUE!", "#DIV/0!", "#NAME?", "#NULL!", "#NUM!", "#GETTING_DATA",
]
# Day numbers count from this day, and only this range is taken as a day number.
SERIAL_EPOCH = "1899-12-30 00:00:00"
SERIAL_RANGE = (20000, 60000)
# The characters that Unicode counts as white space, and the four separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The years that a Spark timestamp is defined for; text beyond them is no date.
YEARS = (1, 9999)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def number(c: Column) -> Column:
    """Text or number as DOUBLE; bad text and NaN become NULL."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def stripped(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    """Blank, placeholder and sheet-error texts to NULL; other text unchanged."""
    text = stripped(c)
    error = F.upper(F.replace(text, F.lit(" "), F.lit(""))).isin(SHEET_ERRORS)
    return F.when(~(text.isin(PLACEHOLDERS) | error), c)


def null_placeholders(df: DataFrame) -> DataFrame:
    texts = set(string_columns(df))
    return df.select(
        *[blank_to_null(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def drop_all_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="all", subset=list(columns) if columns else None)


def used_columns(df: DataFrame) -> list[str]:
    """Columns with at least one value: one aggregate over the data, one row back."""
    probe = df.agg(
        *[F.max(F.when(F.col(c).isNotNull(), 1)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    ).first()
    return [c for i, c in enumerate(df.columns) if probe[f"c{i}"]]


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows and then columns that hold no value at all."""
    return drop_all_null_rows(df).select(*used_columns(df))


def serial_to_timestamp(c: Column) -> Column:
    """Day numbers (fraction = time of day) or date text to a timestamp; 1970-01-01 means none."""
    value = number(c)
    low, high = SERIAL_RANGE
    micros = F.round(value * F.lit(86400000000)).cast("bigint")
    counted = F.timestamp_add(
        "MICROSECOND", micros, F.lit(SERIAL_EPOCH).cast("timestamp_ntz")
    )
    parsed = c.try_cast("timestamp_ntz")
    none = F.lit("1970-01-01").cast("date")
    kept = F.when((parsed.cast("date") != none) & F.year(parsed).between(*YEARS), parsed)
    return F.when(value.between(low, high), counted).otherwise(kept)


def serial_dates(df: DataFrame) -> DataFrame:
    """Apply ``serial_to_timestamp`` to the text columns whose name contains ``date``."""
    wanted = {c for c in string_columns(df) if "date" in c.lower()}
    return df.select(
        *[serial_to_timestamp(F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def fit_row(cells: Column, width: int) -> list[Column]:
    """The first ``width`` cells of a ragged row, missing ones NULL."""
    return [F.get(cells, F.lit(i)) for i in range(width)]


def keyword(c: Column) -> Column:
    """Search keyword: trimmed, space as ``+``."""
    return F.replace(stripped(c), F.lit(" "), F.lit("+"))


def number_text(c: Column) -> Column:
    """``1,234.5`` or ``12%`` as DOUBLE: commas and percent signs removed, no scaling."""
    return number(F.translate(c, ",%", ""))


def join_unique(lists: Column, separator: str = ",") -> Column:
    """A list of lists as one text: unique items in first-seen order."""
    return F.array_join(F.array_distinct(F.flatten(lists)), separator)
