"""Joins and picks that stay balanced when one key holds a large share of the rows.

AQE can split a skewed join partition only when the join reads its shuffles directly. A
``distinct`` or ``groupBy`` on the join key removes that shuffle (its partitioning is reused),
so a hot key would stay in one task. The joins here always give both sides a fresh shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PART = "_part"
_SALT = "_salt"
_ROW = "_row"
FEW_GROUPS = 10_000  # groups that a membership test broadcasts
GROUP_SALTS = 32  # sub-groups that the rows of a group are spread over where there are more


def all_not_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def thin_keys(df: DataFrame, keys: Sequence[str], copies: int = 64) -> DataFrame:
    """Key rows for a membership test: NULL keys dropped, at most ``copies`` rows per key.

    Duplicates are combined map-side, so a key repeated in a third of the rows shrinks to a few.
    Grouping by (key, map partition group) instead of the key alone leaves the join its own
    shuffle, which AQE may split.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(copies)).alias(_PART)
    return df.where(all_not_null(keys)).select(*keys, part).distinct().select(*keys)


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``. Keys compare with ``=``: NULL never matches."""
    return df.join(thin_keys(other, keys), list(keys), "left_anti")


def with_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``."""
    return df.join(thin_keys(other, keys), list(keys), "left_semi")


def in_groups(df: DataFrame, other: DataFrame, by: Sequence[str], inside: bool = True) -> DataFrame:
    """Rows of ``df`` whose values of ``by`` occur in ``other`` (or do not), NULL equal to NULL.

    For groups of many rows, such as partitions: few groups are broadcast, so that the rows stay
    where they are; many are repeated once per salt, and the rows of a group are spread over the
    salts. Counting the groups up to ``FEW_GROUPS`` takes a scan of ``by`` in ``other``.
    """
    how = "left_semi" if inside else "left_anti"
    groups = other.select(*by).distinct()
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in by]
    if groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        return df.alias("r").join(F.broadcast(groups).alias("g"), same, how).select(*[F.col(f"r.`{c}`") for c in df.columns])
    spread = df.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(GROUP_SALTS)))
    copies = groups.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(GROUP_SALTS - 1))))
    same.append(F.col(f"r.{_SALT}") == F.col(f"g.{_SALT}"))
    kept = spread.alias("r").join(copies.alias("g").hint("merge"), same, how)
    return kept.select(*[F.col(f"r.`{c}`") for c in df.columns])


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", salts: int = 2
) -> DataFrame:
    """Join facts to a lookup that has one row per key.

    The facts are spread over ``salts`` sub-keys by their map partition (the same on a retry) and
    the lookup is repeated once per sub-key. The salt also makes both sides shuffle anew, so AQE
    can split a hot sub-key further; two salts keep a large lookup cheap to repeat, a small one
    affords more.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    spread = left.withColumn(_SALT, salt)
    copies = right.where(all_not_null(on)).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return spread.join(copies, [*on, _SALT], how).drop(_SALT)


def null_high(*columns: Column | str) -> list[Column]:
    """Sort keys under which NULL ranks above every value (the warehouse's NULL order)."""
    out: list[Column] = []
    for c in columns:
        c = F.col(c) if isinstance(c, str) else c
        out += [c.isNull(), c]
    return out


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick: str = "last"
) -> DataFrame:
    """One row per key: the ``last`` or ``first`` by ``order`` (compared left to right).

    An aggregate instead of a ranked window: each map task keeps one row per key before the
    shuffle. NULL keys form one group. NULL order values rank lowest; see ``null_high``.
    ``order`` must settle ties, or any of the tied rows may come back.
    """
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*order)
    row = F.struct(*rest)
    choose = F.max_by(row, by) if pick == "last" else F.min_by(row, by)
    picked = df.groupBy(*keys).agg(choose.alias(_ROW))
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"{_ROW}.`{c}`").alias(c) for c in df.columns]
    )


def next_in_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, value: str, out: str,
    grain: str = "day",
) -> DataFrame:
    """``lead(value)`` over (``keys`` ordered by ``ts``, ``tiebreak``), spread over time slots.

    Rows lead inside (key, slot). Each slot gets one extra row at its end that carries the first
    value of the key's next used slot, and is dropped again. A key's rows are thus sorted slot by
    slot in many tasks; the only window per key runs over one row per slot. The data is shuffled
    once.
    """
    slot = F.date_trunc(grain, F.col(ts)).alias("_slot")
    firsts = (
        df.select(*keys, slot, ts, tiebreak, value)
        .groupBy(*keys, "_slot")
        .agg(F.min_by(F.struct(value), F.struct(ts, tiebreak)).alias("_value"))
    )
    across = Window.partitionBy(*keys).orderBy("_slot")
    ends = firsts.select(
        *keys, "_slot", F.lit(1).alias("_end"), F.lead("_value").over(across).alias("_value")
    ).where(F.col("_value").isNotNull())

    data = df.select("*", slot, F.lit(0).alias("_end"), F.struct(value).alias("_value"))
    both = data.unionByName(ends, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_slot").orderBy("_end", ts, tiebreak)
    led = both.withColumn("_next", F.lead("_value").over(inside)).where("_end = 0")
    return led.select(*df.columns, F.col("_next")[value].alias(out))
