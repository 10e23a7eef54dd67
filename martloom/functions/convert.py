"""Value conversion to a declared type: bad values become NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.cleaning import number, stripped

# Texts read as true and as false by the declared-schema rule.
TRUE_TEXTS = ["true", "True", "t", "T", "1", "yes", "Yes", "Y", "y"]
FALSE_TEXTS = ["false", "False", "f", "F", "0", "no", "No", "N", "n"]


def to_int(c: Column) -> Column:
    """Nearest integer, halves to even. Whole numbers keep all their digits; only fractions,
    exponents and floating-point columns go through DOUBLE."""
    text, near = c.cast("string"), F.bround(number(c))
    wide = F.bround(text.try_cast("decimal(38,10)")).try_cast("bigint")
    rounded = near.try_cast("bigint")
    from_text = F.when(F.abs(near) < 2.0**53, rounded).otherwise(F.coalesce(wide, rounded))
    return F.when(F.typeof(c).isin("double", "float"), rounded).otherwise(
        F.coalesce(text.try_cast("bigint"), from_text)
    )


def to_bool(c: Column) -> Column:
    """Exact token map; every other text (``TRUE`` too) is NULL."""
    return F.when(c.isin(TRUE_TEXTS), True).when(c.isin(FALSE_TEXTS), False)


def to_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def to_date(c: Column) -> Column:
    return c.try_cast("timestamp_ntz").cast("date")


def to_text(c: Column) -> Column:
    """Text, with the text ``nan`` read as missing."""
    text = c.cast("string")
    return F.when(text != "nan", text)


CONVERTERS = {
    "int": to_int,
    "float": number,
    "bool": to_bool,
    "datetime": to_timestamp,
    "date": to_date,
    "str": to_text,
}


def int_from_text(c: Column) -> Column:
    """Staged text to an integer: blank is NULL, a fraction is cut off."""
    value = number(F.nullif(stripped(c), F.lit("")))
    return F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value)).try_cast("bigint")


def float_from_text(c: Column) -> Column:
    return number(F.nullif(stripped(c), F.lit("")))


def flag_from_text(c: Column) -> Column:
    """Staged text to a flag: text outside the true set is false, NULL stays NULL."""
    # Texts read as true when loading staged text.
    return F.lower(stripped(c)).isin("true", "t", "yes", "y", "1")


def array_from_literal(c: Column) -> Column:
    """``{a,b}`` text to an array: outer braces stripped, split at commas."""
    return F.split(F.btrim(c, F.lit("{}")), ",")


def array_from_json(c: Column) -> Column:
    """JSON list text to an array of text; other text, a broken list too, to a one-element array."""
    parsed = F.when(stripped(c).startswith("["), F.from_json(c, "array<string>"))
    return F.when(c.isNotNull(), F.coalesce(parsed, F.array(c)))
