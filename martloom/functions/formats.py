"""Display formats for report cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.cleaning import number_text

# Indian-unit divisors with their suffixes, and the currency sign.
UNITS = {"lakh": (100000, "L"), "crore": (10000000, "Cr")}
CURRENCY_SIGN = "₹"


def round_exact(value: Column, decimals: int) -> Column:
    """A double rounded by its exact binary value, ties to even: 0.125 to 0.12, 2.675 (which is a
    little less) to 2.67.

    The product with the power of ten can round onto a tie that the value is not; the part that
    the product lost, found by splitting both factors in halves, then decides.
    """
    power = 10.0**decimals

    def halves(x):
        high = x * 134217729.0 - (x * 134217729.0 - x)
        return high, x - high

    def rounded(v: Column) -> Column:
        scaled = v * power
        (high, low), (power_high, power_low) = halves(v), halves(power)
        lost = ((high * power_high - scaled) + high * power_low + low * power_high) + low * power_low
        below = F.floor(scaled).cast("double")
        whole = (
            F.when((scaled - below != 0.5) | (lost == 0), F.rint(scaled))
            .when(lost > 0, below + 1)
            .otherwise(below)
        )
        return F.when(F.abs(scaled) < 2.0**52, whole / power).otherwise(v)

    # The lambda names the value, which would otherwise be written out at each of its uses.
    return F.get(F.transform(F.array(value), rounded), F.lit(0))


def format_cell(c: Column, spec: str) -> Column:
    """Text for ``kind`` or ``kind:decimals`` (default 2); NULL shows as empty text.

    The cell may be a number or number text such as ``1,234`` or ``12%``.

    Kinds: comma, lakh, crore, percent, currency.
    """
    kind, _, places = spec.partition(":")
    decimals = int(places) if places.isdigit() else 2
    value = number_text(c.cast("string"))
    if kind in UNITS:
        value = value / UNITS[kind][0]
    value = round_exact(value, decimals)
    if kind == "comma":
        text = F.format_string(f"%,.{decimals}f", value)
    elif kind in UNITS:
        text = F.format_string(f"%.{decimals}f{UNITS[kind][1]}", value)
    elif kind == "percent":
        text = F.format_string(f"%.{decimals}f%%", value)
    elif kind == "currency":
        text = F.format_string(f"{CURRENCY_SIGN}%,.{decimals}f", value)
    else:
        raise ValueError(f"unknown format {spec!r}")
    return F.when(c.isNotNull(), text).otherwise("")
