"""Column-name rules. Pure functions on names; apply them with ``DataFrame.toDF``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

_SEPARATOR = re.compile(r"[\s.-]+")
_PLAIN = re.compile(r"[A-Za-z0-9_]+")
_NO_BRACKETS = str.maketrans("", "", "()")


def clean_name(name: str, lower: bool = False) -> str:
    """A plain identifier: no brackets or symbols, separators to ``_``, never empty."""
    words = _SEPARATOR.split(str(name).strip().translate(_NO_BRACKETS))
    plain = "_".join("".join(_PLAIN.findall(word)) for word in words)
    plain = plain.lower() if lower else plain
    if plain[:1].isdigit():
        plain = "col_" + plain
    return plain or "unnamed_col"


def unique_names(names: Sequence[str]) -> list[str]:
    """Later duplicates get ``_2``, ``_3``, ...; case-insensitive, as Spark resolves names."""
    used: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in used:
            n += 1
            candidate = f"{name}_{n}"
        used.add(candidate.lower())
        out.append(candidate)
    return out


def clean_names(df: DataFrame, lower: bool = False) -> DataFrame:
    return df.toDF(*unique_names([clean_name(c, lower) for c in df.columns]))


def csv_name(name: str) -> str:
    """Header rule of CSV drops: lower case, ``()`` and ``.`` removed, space or hyphen to ``_``."""
    return re.sub(r"[\s-]+", "_", name.strip().lower()).translate(str.maketrans("", "", "()."))


def header_name(value: str | None, index: int) -> str:
    """Worksheet header rule: whitespace collapsed, a blank header named by its position."""
    words = "" if value is None else " ".join(str(value).split())
    return words or f"unnamed_{index}"


def sheet_headers(values: Sequence[str | None], header_row: bool = True) -> list[str]:
    if not header_row:
        return [f"col_{i}" for i in range(len(values))]
    return [header_name(v, i) for i, v in enumerate(values)]
