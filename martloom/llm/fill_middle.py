"""Fill-in-the-middle transformation, its cuts found through a learned rank index.

A text's units are words with the white space before them. The index of a text maps a rank (how
many units) to the offset of that unit's end: straight lines, each off by at most ``ERROR`` code
points, and beside them what each rank is off by, in one byte. A cut is predicted by its line and
put right by its residual, so it is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = 127  # a residual fits one signed byte
SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_CUTS = "n long, low long, high long"


@dataclass(frozen=True)
class RankIndex:
    """The rank indexes of several texts, one behind the other.

    ``first``: where each text's ranks begin among all (its rank 0 is offset 0), and the end.
    ``segment``: where each line's ranks begin; ``base``, ``rise`` and ``run`` give the line.
    ``residual``: what each rank is off by.
    """

    first: np.ndarray
    segment: np.ndarray
    base: np.ndarray
    rise: np.ndarray
    run: np.ndarray
    residual: np.ndarray

    @property
    def units(self) -> np.ndarray:
        return np.diff(self.first) - 1

    def offsets(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The offset after ``rank`` units of the texts numbered ``text``."""
        at = self.first[text] + rank
        line = np.searchsorted(self.segment, at, side="right") - 1
        guess = self.base[line] + self.rise[line] * (at - self.segment[line]) // self.run[line]
        return guess + self.residual[at]


def unit_ends(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code-point offsets of rank 0, 1, ... of each text, and where each text's ranks begin.

    ``data``: the texts' UTF-8 bytes in a row; ``bounds``: where each begins, and the end. A unit
    ends where white space follows something else, and at the end of a text.
    """
    white = _WHITE[data]
    ends = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    full = bounds[1:] > bounds[:-1]
    # A text's own start is rank 0; its end is the last rank, unless the text is empty.
    ends = np.union1d(ends, bounds[1:][full])
    owner = np.searchsorted(bounds[:-1][full], ends, side="left") - 1
    own = np.flatnonzero(full)[owner]
    units = np.bincount(own, minlength=len(full)) if len(own) else np.zeros(len(full), dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(units + 1)))
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    out = np.zeros(first[-1], dtype=np.int64)
    inside = np.ones(first[-1], dtype=bool)
    inside[first[:-1]] = False
    out[inside] = points[ends] - points[bounds[own]]
    return out, first


def fit(offsets: np.ndarray, first: np.ndarray, error: int = ERROR) -> RankIndex:
    """Lines through the ends of each stretch of ranks. A stretch that is off by more than
    ``error`` somewhere is halved; two ranks are never off, so this ends."""
    a, b = first[:-1], first[1:] - 1
    residual = np.zeros(len(offsets), dtype=np.int64)
    kept = []
    while len(a):
        size = b - a + 1
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(a)), size)
        step = np.arange(len(owner)) - begin[owner]
        rise, run = offsets[b] - offsets[a], np.maximum(b - a, 1)
        at = a[owner] + step
        off = offsets[at] - (offsets[a][owner] + rise[owner] * step // run[owner])
        good = np.maximum.reduceat(np.abs(off), begin) <= error
        mine = good[owner]
        residual[at[mine]] = off[mine]
        kept.append(np.stack([a[good], offsets[a[good]], rise[good], run[good]]))
        a, b = a[~good], b[~good]
        half = (a + b) // 2
        a, b = np.concatenate([a, half + 1]), np.concatenate([half, b])
    lines = np.concatenate(kept, axis=1) if kept else np.zeros((4, 0), dtype=np.int64)
    lines = lines[:, np.argsort(lines[0])]
    store = np.int8 if error <= 127 else np.int64
    return RankIndex(first, *lines, residual.astype(store))


def index_texts(texts: pa.Array, error: int = ERROR) -> RankIndex:
    """The rank index of an Arrow array of texts; NULL counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return fit(np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), error)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[bounds[0] : bounds[-1]] if body else np.zeros(0, np.uint8)
    return fit(*unit_ends(data, bounds - bounds[0]), error)


def cut_points(text: Column, one: Column, other: Column) -> Column:
    """``n`` (units), and the offsets after the smaller and the larger of ``one % (n + 1)`` and
    ``other % (n + 1)`` units."""

    @F.arrow_udf(_CUTS)
    def cut(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        index = index_texts(texts)
        n = index.units
        a = first.to_numpy(zero_copy_only=False) % (n + 1)
        b = second.to_numpy(zero_copy_only=False) % (n + 1)
        which = np.arange(len(n))
        low, high = index.offsets(which, np.minimum(a, b)), index.offsets(which, np.maximum(a, b))
        return pa.StructArray.from_arrays([pa.array(x) for x in (n, low, high)], ["n", "low", "high"])

    return cut(text, one, other)


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, fim_percent: int = 50, spm_percent: int = 80
) -> DataFrame:
    """``row`` (the document's columns), ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and
    ``output``.

    A document's draws come from the sha256 of ``seed:doc_id``, so they do not depend on how the
    rows are spread. A NULL text counts as empty and a NULL id as the empty text; empty texts and
    such as hold a marker stay plain; repeated rows are transformed alike. No shuffle: each text
    is indexed and cut where it lies, whole.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    told = docs.select(F.struct("*").alias("row"), text.alias("text"), *draws)
    told = told.withColumn("cut", cut_points(F.col("text"), F.col("h1"), F.col("h2")))
    text = F.col("text")
    plain = (text == "") | (F.col("h3") % 100 >= fim_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= text.contains(marker)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    low, high = F.col("cut.low").cast("int"), F.col("cut.high").cast("int")
    prefix = text.substr(F.lit(1), low)
    middle = text.substr(low + 1, high - low)
    suffix = text.substr(high + 1, F.length(text))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    told = told.withColumn("form", form)
    shuffled = F.col("form") != "plain"
    return told.select(
        "row",
        F.col("cut.n").alias("n"),
        "form",
        F.when(shuffled, F.col("cut.low")).alias("prefix_chars"),
        F.when(shuffled, F.col("cut.high") - F.col("cut.low")).alias("middle_chars"),
        F.when(~shuffled, text).when(F.col("form") == "psm", psm).otherwise(spm).alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that was transformed. It held no marker, so the first of each is the one put in."""
    size = F.length(output)
    first, second = F.when(form == "psm", SUFFIX).otherwise(PREFIX), F.lit(MIDDLE)
    at, end = F.position(first, output), F.position(second, output)
    one = output.substr(F.lit(len(PREFIX) + 1), at - len(PREFIX) - 1)
    two = output.substr(at + len(PREFIX), end - at - len(PREFIX))
    middle = output.substr(end + len(MIDDLE), size)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(one, middle, two))
        .otherwise(F.concat(two, middle, one))
    )
