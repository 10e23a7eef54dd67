"""Benchmark decontamination: Wu-Manber multi-pattern search for benchmark word windows."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import beside, utf8, words_of
from martloom.session import settle

WINDOW = 13
# Benchmark words that one set of search tables holds; a longer benchmark takes several passes.
BLOCK_WORDS = 2_000_000
# A document is contaminated when at least 1 in this many of its words is hit.
SHARE = 20

_FOUND = "n_words long, spans array<int>, items array<string>"


class _Tables:
    """Search tables for patterns of one length.

    ``shift``: for the block (last two words of the search window) how far the window may move
    without passing an occurrence; blocks that are in no pattern allow the most. ``ends``: for a
    block that ends a pattern, its patterns by their first block.
    """

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.most = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.ends: dict[int, dict[int, list[tuple[tuple[int, ...], frozenset[str]]]]] = {}

    def add(self, pattern: tuple[int, ...], items: frozenset[str], base: int) -> None:
        for i in range(self.most):
            key = self.key(pattern, i, base)
            left = self.most - 1 - i
            self.shift[key] = min(self.shift.get(key, left), left)
        first, last = self.key(pattern, 0, base), self.key(pattern, self.most - 1, base)
        self.ends.setdefault(last, {}).setdefault(first, []).append((pattern, items))

    def key(self, ids, at: int, base: int) -> int:
        return ids[at] * base + ids[at + 1] if self.block == 2 else ids[at]

    def search(self, ids: list[int], base: int):
        """``(start, items)`` of every occurrence. Word ids below 0 are in no pattern."""
        length, block, most, shift = self.length, self.block, self.most, self.shift
        at, last = 0, len(ids) - length
        while at <= last:
            end = at + length
            if ids[end - 1] < 0:
                at = end  # no window may hold this word
                continue
            key = ids[end - 2] * base + ids[end - 1] if block == 2 else ids[end - 1]
            if block == 2 and ids[end - 2] < 0:
                at = end - 1
                continue
            move = shift.get(key, most)
            if move:
                at += move
                continue
            heads = self.ends[key]
            for pattern, items in heads.get(self.key(ids, at, base), ()):
                if tuple(ids[at:end]) == pattern:
                    yield at, items
            at += 1


class Searcher:
    """All windows of a set of benchmark items, one set of tables per window length."""

    def __init__(self, items: dict[str, list[list[bytes]]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, texts in items.items():
            for words in texts:
                size = min(window, len(words))
                for i in range(len(words) - size + 1 if size else 0):
                    owners[tuple(words[i : i + size])].add(item)
        vocabulary = dict.fromkeys(w for pattern in owners for w in pattern)
        self.ids = {w: i for i, w in enumerate(vocabulary)}
        self.base = len(self.ids) + 1
        self.tables: dict[int, _Tables] = {}
        for pattern, names in owners.items():
            tables = self.tables.setdefault(len(pattern), _Tables(len(pattern)))
            tables.add(tuple(self.ids[w] for w in pattern), frozenset(names), self.base)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged ``(start, end)`` word spans inside occurrences, and the items that occur."""
        get = self.ids.get
        ids = [get(w, -1) for w in words]
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for tables in self.tables.values():
            for start, names in tables.search(ids, self.base):
                spans.append((start, start + tables.length))
                items |= names
        return merge(spans), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[dict[str, list[list[bytes]]]]:
    """The benchmark in blocks of about ``limit`` words, streamed item by item."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("t"))
    held: dict[str, list[list[bytes]]] = defaultdict(list)
    size = 0
    for row in rows.where("item IS NOT NULL").toLocalIterator():
        words = words_of(row["t"])
        if words:
            held[row["item"]].append(words)
            size += len(words)
        if size >= limit:
            yield dict(held)
            held, size = defaultdict(list), 0
    yield dict(held)


def _search(text: Column, spans: Column, items: Column, shared) -> Column:
    @F.pandas_udf(_FOUND)
    def search(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        searcher = Searcher(shared.value[0], shared.value[1])
        for texts, old_spans, old_items in batches:
            out = []
            for text, flat, names in zip(texts, old_spans, old_items):
                words = words_of(text)
                found, new = searcher.find(words)
                if flat is not None and len(flat):
                    found = merge(found + list(zip(flat[::2], flat[1::2])))
                if names is not None:
                    new |= set(names)
                out.append((len(words), [x for span in found for x in span], sorted(new)))
            yield pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return search(text, spans, items)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``row`` (the document's columns), ``n_words``, ``spans`` (flat, merged word ranges inside
    any occurrence: start, end, start, ...), ``items`` (sorted item ids) and ``n_hit``.

    Documents are searched where they lie; the benchmark's tables are broadcast, block by block
    if it holds more than ``block_words`` words, so a pass never holds more than one block. An
    item shorter than the window is one window; an item or document without words has none;
    items with a NULL id are left out; repeated items and rows count as they stand.
    """
    spark = docs.sparkSession
    none = F.lit(None)
    found = beside(
        docs,
        found=F.struct(
            F.lit(0).cast("long").alias("n_words"),
            none.cast("array<int>").alias("spans"),
            none.cast("array<string>").alias("items"),
        ),
    )
    for i, block in enumerate(_blocks(benchmark, block_words)):
        if i:
            found = settle(found)
        shared = spark.sparkContext.broadcast((block, window))
        text = F.col("row.text").cast("string").cast("binary")
        found = found.select(
            "row", _search(text, F.col("found.spans"), F.col("found.items"), shared).alias("found")
        )
    return found.select(
        "row", "found.*", F.aggregate("found.spans", F.lit(0), lambda a, x: x - a).alias("n_hit")
    )


def digest(found: DataFrame, share: int = SHARE) -> DataFrame:
    """The documents' columns in ``row`` with the counts, the items' hash and the verdict."""
    hit = F.col("n_hit").cast("long")
    return found.select(
        "row",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def items_hash(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
