"""Phrase mining: contiguous word sequences that occur more often than their parts explain.

Words are numbered by falling frequency, so the pairs that occur most lie in few square tiles of
the (first, second) plane. A task counts a tile with many pairs in a dense array by
``numpy.bincount``, the others as sorted coordinates. The frequent pairs are then numbered by
frequency themselves and take the place of the first word: phrases of three words are pairs of
(pair, word), and so on for longer ones.

Numbers are given to a bounded list of words (and of phrases of each length), the most frequent
ones; what stands outside the list is counted by its text, so no phrase is lost.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import utf8
from martloom.llm.packed import pack_ints, unpack_ints
from martloom.session import settle

LISTED = 1 << 19  # words, and phrases of a length, that have a number
SIDE, GRID = 256, 8  # a tile's side, and how many tiles a side of the dense corner has
DENSE = SIDE * SIDE // 16  # pairs at once that make a tile dense
HELD = 1 << 20  # pairs that a task holds before it counts them; it holds twice as many different ones
SLICES = 64  # of a language, ranked apart
UNKNOWN_LANG = "und"

_BREAK = b"."
_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
_PLAIN = bytes(
    ord(_BREAK) if b in _BREAKS else 0x20 if b == 0x09 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
NOTHING, UNLISTED = -1, -2  # no phrase that could be frequent; one that has no number

# Counts on their way: the sorted pairs (``body`` has the steps from first to first), or the texts
# of a language, of one task and one bucket, packed into a row.
_RUNS = "bucket long, lang string, body binary, last binary, counts binary"
_RUNS_ARROW = pa.schema(
    [("bucket", pa.int64()), ("lang", pa.string()), ("body", pa.binary()), ("last", pa.binary()), ("counts", pa.binary())]
)
_SUMS = "first long, last long, lang string, phrase binary, n long"
_SUMS_ARROW = pa.schema(
    [("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())]
)


def split_words(texts: list[bytes | None]) -> list[bytes]:
    """The words of the texts in their order, A-Z lower-cased, with ``.`` between pieces."""
    body = _BREAK.join([t or b"" for t in texts]).translate(_PLAIN)
    return body.replace(_BREAK, b" . ").split()


@dataclass
class Listing:
    """The numbered words, and for each length from 2 the numbered phrases.

    ``words``: number of a word, by language. ``complete``: whether all frequent ones of that
    length have a number. ``keys`` (sorted) and ``ranks``: number of a phrase by
    ``first << 32 | last``; ``parts``: ``(first, last)`` by number.
    """

    words: dict[str, dict[bytes, int]] = field(default_factory=dict)
    langs: list[str] = field(default_factory=list)
    texts: list[bytes] = field(default_factory=list)
    complete: list[bool] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    ranks: list[np.ndarray] = field(default_factory=list)
    parts: list[np.ndarray] = field(default_factory=list)

    def add_phrases(self, first: np.ndarray, last: np.ndarray, n: np.ndarray, complete: bool) -> None:
        order = np.lexsort((last, first, -n))
        first, last = first[order], last[order]
        key = first << 32 | last
        by_key = np.argsort(key)
        self.keys.append(key[by_key])
        self.ranks.append(by_key.astype(np.int32))
        self.parts.append(np.stack([first, last]).astype(np.int32))
        self.complete.append(complete)

    def numbers(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        known = self.words.get(lang, {_BREAK: NOTHING})
        ids = np.fromiter(map(known.get, tokens, repeat(UNLISTED)), dtype=np.int64, count=len(tokens))
        if self.complete[0]:
            ids[ids == UNLISTED] = NOTHING
        return ids

    def pairs(self, units: np.ndarray, ids: np.ndarray, size: int):
        """Of the phrases of ``size`` words: first part, last word, whether both have a number,
        and whether it must be counted by its text."""
        first, rest, last = units[:-1], units[1:], ids[size - 1 :]
        maybe = (first != NOTHING) & (rest != NOTHING)
        listed = maybe & (first >= 0) & (last >= 0)
        return first, last, listed, maybe & ~listed

    def units(self, ids: np.ndarray, size: int) -> np.ndarray:
        """The phrases of ``size`` words that begin at each word."""
        units = ids
        for k in range(2, size + 1):
            if len(units) < 2:
                return np.zeros(0, np.int64)
            first, last, listed, other = self.pairs(units, ids, k)
            key = first[listed] << 32 | last[listed]
            keys = self.keys[k - 2]
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            missing = NOTHING if self.complete[k - 1] else UNLISTED
            found = np.full(len(key), missing, np.int64)
            if len(keys):
                hit = keys[at] == key
                found[hit] = self.ranks[k - 2][at[hit]]
            units = np.full(len(first), NOTHING, np.int64)
            units[listed] = found
            units[other] = UNLISTED
        return units

    def spell(self, first: np.ndarray, last: np.ndarray, size: int) -> tuple[list[str], list[bytes]]:
        """Language and text of phrases of ``size`` words."""
        words = [last]
        for k in range(size - 1, 1, -1):
            first, w = self.parts[k - 2][0][first], self.parts[k - 2][1][first]
            words.append(w)
        words.append(first)
        columns = [[self.texts[i] for i in w.tolist()] for w in reversed(words)]
        return [self.langs[i] for i in first.tolist()], [b" ".join(p) for p in zip(*columns)]


class Tiles:
    """Counts of pairs of numbers. Pairs come in any order; a tile of the dense corner in which
    many lie is counted by address, all others by sorting."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.open: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.kept = 0

    def add(self, first: np.ndarray, last: np.ndarray) -> None:
        self.open.append((first, last))
        self.held += len(first)
        if self.held >= HELD:
            self.count()

    def count(self) -> None:
        if not self.open:
            return
        first, last = (np.concatenate(x) for x in zip(*self.open))
        self.open, self.held = [], 0
        corner = (first < SIDE * GRID) & (last < SIDE * GRID)
        tile = np.where(corner, (first // SIDE) * GRID + last // SIDE, GRID * GRID).astype(np.uint8)
        order = np.argsort(tile, kind="stable")
        first, last = first[order], last[order]
        ends = np.cumsum(np.bincount(tile, minlength=GRID * GRID + 1)).tolist()
        rest = [slice(ends[-2], ends[-1])]
        for t, (a, b) in enumerate(zip([0, *ends], ends[:-1])):
            if b - a < DENSE:
                rest.append(slice(a, b))
                continue
            cell = (first[a:b] % SIDE) * SIDE + last[a:b] % SIDE
            counts = np.bincount(cell, minlength=SIDE * SIDE)
            if t in self.dense:
                self.dense[t] += counts
            else:
                self.dense[t] = counts
        key = np.concatenate([first[s] << 32 | last[s] for s in rest])
        self.sparse.append(np.unique(key, return_counts=True))
        self.kept += len(self.sparse[-1][0])

    def full(self) -> bool:
        return self.kept >= 2 * HELD

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """All different pairs so far, sorted, as ``first << 32 | last``, and how often each came;
        begins anew."""
        self.count()
        keys, counts = [], []
        for t, cells in self.dense.items():
            at = np.flatnonzero(cells)
            first, last = t // GRID * SIDE + at // SIDE, t % GRID * SIDE + at % SIDE
            keys.append(first << 32 | last)
            counts.append(cells[at])
        keys += [k for k, _ in self.sparse]
        counts += [c for _, c in self.sparse]
        self.dense, self.sparse, self.kept = {}, [], 0
        return add_up(keys, counts)


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up by key, the keys sorted."""
    if not sum(map(len, keys)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[begin], np.add.reduceat(count, begin)


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The words of a batch's texts, language by language."""
    held: dict[str, list[bytes | None]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        held.setdefault(lang, []).append(text)
    for lang, texts in held.items():
        yield lang, split_words(texts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language with their counts, and a row without a word: how many there are."""
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, tokens in _by_lang(batch):
            own = counts.setdefault(lang, Counter())
            own.update(tokens)
            own.pop(_BREAK, None)
        if sum(map(len, counts.values())) >= HELD // 4:
            yield from _word_rows(counts)
            counts = {}
    yield from _word_rows(counts)


def _word_rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, own in counts.items():
        words, n = [None, *own], [sum(own.values()), *own.values()]
        for i in range(0, len(words), 1 << 17):
            part = words[i : i + (1 << 17)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array(part, pa.binary()), pa.array(n[i : i + (1 << 17)], pa.int64())],
                ["lang", "word", "n"],
            )


def _count_phrases(shared: Broadcast, size: int, buckets: int):
    """Each task's counts of the phrases of ``size`` words, by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listing: Listing = shared.value
        tiles, texts = Tiles(), {}
        for batch in batches:
            for lang, tokens in _by_lang(batch):
                ids = listing.numbers(lang, tokens)
                units = listing.units(ids, size - 1)
                if len(units) < 2:
                    continue
                first, last, listed, other = listing.pairs(units, ids, size)
                tiles.add(first[listed], last[listed])
                at = np.flatnonzero(other).tolist()
                if at:
                    own = texts.setdefault(lang, Counter())
                    own.update([b" ".join(tokens[i : i + size]) for i in at])
            if tiles.full():
                yield from _pair_runs(tiles, buckets)
            if sum(map(len, texts.values())) >= HELD // 4:
                yield from _text_runs(texts, buckets)
                texts = {}
        yield from _pair_runs(tiles, buckets)
        yield from _text_runs(texts, buckets)

    return count


def _pair_runs(tiles: Tiles, buckets: int) -> Iterator[pa.RecordBatch]:
    key, n = tiles.counted()
    bucket = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)
    first, last = key >> 32, key & 0xFFFFFFFF
    rows = []
    for part in _parts(bucket.astype(np.int64)):
        steps = np.diff(first[part], prepend=0)
        rows.append((int(bucket[part[0]]), None, pack_ints(steps), pack_ints(last[part]), pack_ints(n[part])))
    yield _runs(rows)


def _text_runs(texts: dict[str, Counter], buckets: int) -> Iterator[pa.RecordBatch]:
    rows = []
    for lang, own in texts.items():
        phrases, n = list(own), np.array(list(own.values()), dtype=np.int64)
        bucket = np.fromiter((zlib.crc32(p) % buckets for p in phrases), dtype=np.int64, count=len(phrases))
        for part in _parts(bucket):
            body = zstandard.ZstdCompressor(level=1).compress(_BREAK.join([phrases[i] for i in part.tolist()]))
            rows.append((int(bucket[part[0]]), lang, body, None, pack_ints(n[part])))
    yield _runs(rows)


def _parts(bucket: np.ndarray) -> list[np.ndarray]:
    """Which rows fall into each bucket, in their order."""
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUNS_ARROW)], schema=_RUNS_ARROW)


def _sum_phrases(shared: Broadcast, size: int, least: int):
    """Sums of each bucket's runs from ``least`` up, with their texts. Holds one bucket's
    different phrases."""

    def close(keys, counts, texts, listing: Listing) -> pa.RecordBatch:
        key, n = add_up(keys, counts)
        key, n = key[n >= least], n[n >= least]
        first, last = key >> 32, key & 0xFFFFFFFF
        lang, phrase = listing.spell(first, last, size)
        first, last, n = first.tolist(), last.tolist(), n.tolist()
        for own_lang, own in texts.items():
            for text, m in own.items():
                if m >= least:
                    first.append(None), last.append(None), lang.append(own_lang), phrase.append(text), n.append(m)
        columns = (first, last, lang, phrase, n)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUMS_ARROW)], schema=_SUMS_ARROW)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listing: Listing = shared.value
        now, keys, counts, texts, held = None, [], [], {}, 0
        for batch in batches:
            for bucket, lang, body, last, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now:
                    if now is not None:
                        yield close(keys, counts, texts, listing)
                    now, keys, counts, texts, held = bucket, [], [], {}, 0
                n = unpack_ints(packed)
                if lang is None:
                    keys.append(np.cumsum(unpack_ints(body)) << 32 | unpack_ints(last))
                    counts.append(n)
                    held += len(n)
                    if held >= 2 * HELD:
                        key, n = add_up(keys, counts)
                        keys, counts, held = [key], [n], 0
                else:
                    own = texts.setdefault(lang, {})
                    for text, m in zip(zstandard.ZstdDecompressor().decompress(body).split(_BREAK), n.tolist()):
                        own[text] = own.get(text, 0) + m
        if now is not None:
            yield close(keys, counts, texts, listing)

    return add


def _most_frequent(df: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """The rows whose ``n`` is at least the smallest number that at most ``limit`` rows reach, and
    whether those are all. Only how often each ``n`` occurs comes to the driver, from the top."""
    by_n = df.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("n"))
    rows, least, complete = 0, None, True
    for row in by_n.limit(limit + 1).toLocalIterator():
        rows += row["rows"]
        if rows > limit:
            complete = False
            break
        least = row["n"]
    return df.where(F.lit(False) if least is None else F.col("n") >= least), complete


def mine_phrases(
    docs: DataFrame, least: int = 10, most_words: int = 3, listed: int = LISTED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(totals, words, phrases)``: ``lang, n`` of all words; ``lang, phrase, n`` of the words,
    and of the phrases of 2 to ``most_words`` words, that occur at least ``least`` times.

    ``docs`` has ``text`` (NULL: empty) and ``lang`` (NULL: ``und``). Texts are read once for the
    words and once for each length; only different phrases of a task are shuffled. The list
    (``listed`` words and as many phrases of each length) is the one thing broadcast. A text
    without words adds nothing; repeated rows count as often as they stand.
    """
    spark = docs.sparkSession
    told = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), utf8("text").alias("text")
    )
    counted = told.mapInArrow(_count_words, "lang string, word binary, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = settle(counted.where((F.col("n") >= least) | F.col("word").isNull()))
    totals = counted.where("word IS NULL").select("lang", "n")
    words = counted.where("word IS NOT NULL")

    listing = Listing()
    top, complete = _most_frequent(words, listed)
    rows = top.toArrow()
    order = np.lexsort((np.arange(len(rows)), -rows["n"].to_numpy()))
    listing.langs = list(map(sys.intern, rows["lang"].take(pa.array(order)).to_pylist()))
    listing.texts = rows["word"].take(pa.array(order)).to_pylist()
    listing.complete.append(complete)
    for i, (lang, word) in enumerate(zip(listing.langs, listing.texts)):
        listing.words.setdefault(lang, {})[word] = i
    for own in listing.words.values():
        own[_BREAK] = NOTHING

    levels = []
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for size in range(2, most_words + 1):
        shared = spark.sparkContext.broadcast(listing)
        runs = told.mapInArrow(_count_phrases(shared, size, buckets), _RUNS)
        runs = runs.repartition("bucket").sortWithinPartitions("bucket")
        level = settle(runs.mapInArrow(_sum_phrases(shared, size, least), _SUMS))
        levels.append(level.select("lang", _text("phrase").alias("phrase"), F.lit(size).alias("size"), "n"))
        if size < most_words:
            top, complete = _most_frequent(level.where("first IS NOT NULL"), listed)
            rows = top.select("first", "last", "n").toArrow()
            listing.add_phrases(*(rows[c].to_numpy().astype(np.int64) for c in ("first", "last", "n")), complete)
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.union(level)
    return totals, words.select("lang", _text("word").alias("phrase"), "n"), phrases


def _text(column: str) -> Column:
    return F.decode(F.col(column), "UTF-8")


def score_phrases(totals: DataFrame, words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score`` of every phrase, by its lowest-scoring cut.

    Decimals of 38 digits keep ``1000000 * a * a`` and ``l * r`` exact for counts below 10^16.
    """
    parts = words.unionByName(phrases.select("lang", "phrase", "n"))
    word = F.split("phrase", " ", -1)
    cuts = phrases.select("lang", "phrase", "size", F.col("n").alias("a"), word.alias("w"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("tail"),
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    whole = lambda c: f"CAST({c} AS DECIMAL(16,0))"
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * ({whole('a')} * {whole('a')})) div ({whole('l')} * {whole('r')})")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    best = best.join(totals, "lang")
    return best.select("lang", "phrase", "size", "a", "b.l", "b.r", "n", "b.score")


def without_parts(scored: DataFrame, percent: int = 50) -> DataFrame:
    """Drop phrases of which at least ``percent`` in a hundred stand inside one longer phrase."""
    word = F.split("phrase", " ", -1)
    inside = scored.where("size > 2").select("lang", "size", F.col("a").alias("longer"), word.alias("w"))
    inside = inside.withColumn("size_in", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inside = inside.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("size_in") + 1)))
    inside = inside.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size_in")), " ").alias("phrase"), "longer")
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def rank_phrases(scored: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` phrases, best score first; ``rank`` from 1. They are among the
    first ``top`` of each of ``SLICES`` slices of the language, so no task sorts a whole one."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = Window.partitionBy("lang", "slice").orderBy(*best)
    some = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    some = some.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return ranked.where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long")).drop("slice")
