"""Exact decimal sums on 64-bit integers.

A DECIMAL sum widens its buffer past 18 digits, which makes every update a big-number addition.
Summing the unscaled value as BIGINT is exact too and keeps the hash table small. Its high and low
halves are summed apart, so that 2^33 rows of the largest values still fit, in ANSI mode or not.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Up to this unscaled size a decimal goes through DOUBLE without loss.
_EXACT_DOUBLE = 2.0**50
# Values of 18 digits have 60 bits: two halves of 30. Wider scales would not fit ``whole``.
_HALF_BITS, _MAX_SCALE = 30, 4


def scale_of(df: DataFrame, column: str) -> int | None:
    """The scale to sum a column at, or None when it is no decimal that fits 64-bit sums."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 18 and kind.scale <= _MAX_SCALE:
        return kind.scale
    return None


def units(c: Column, scale: int) -> Column:
    """A decimal's value in units of its last digit."""
    power = 10**scale
    scaled = c.cast("double") * float(power)
    return F.when(F.abs(scaled) < _EXACT_DOUBLE, F.rint(scaled).cast("bigint")).otherwise(
        (c * F.lit(power)).cast("bigint")
    )


def halves(unit: Column) -> tuple[Column, Column]:
    """The high and the low half of a value in units, to be summed apart."""
    return F.shiftright(unit, _HALF_BITS), unit.bitwiseAND(F.lit((1 << _HALF_BITS) - 1))


def whole(high: Column, low: Column, scale: int) -> Column:
    """Sums of both halves as one decimal again, narrow enough to be summed once more."""
    one = F.lit(Decimal(1).scaleb(-scale))
    units_ = high.cast("decimal(20,0)") * F.lit(Decimal(1 << _HALF_BITS)) + low.cast("decimal(20,0)")
    return units_ * one
