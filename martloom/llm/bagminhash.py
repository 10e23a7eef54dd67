"""Near-duplicate documents: BagMinHash signatures of word-shingle bags, bands, exact checks.

A bag's signature has ``SIGNATURE`` components. Each shingle with weight w draws points from
Poisson processes over its weight axis [0, w), cut into the pieces [0,1), [1,2), [2,4), [4,8), ...;
a point in a piece that w only partly covers counts if its place lies below w. A component is the
earliest point that fell to it, so two bags agree in a component with the probability of their
weighted Jaccard similarity. Points come in order of time, and a process ends once it is later
than every component of its document: few points per shingle are drawn, whatever the signature's
length.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import in_runs, let_go, runs, spread_tiles, utf8, words_of
from martloom.llm.components import components
from martloom.llm.url_filter import build_bloom
from martloom.operators.skew import lookup_join
from martloom.session import settle

SHINGLE = 5
THRESHOLD = 0.8
MISSED = 5e-5  # probability that a pair at the threshold shares no band
COMPONENTS = 128  # of a signature, at most
SKETCH_TILE = 512  # documents on a side of a tile in which sketches are compared
TILE = 128  # documents on a side of a tile in which bags are compared
KEPT_WORDS = 200_000

_G = 0x9E3779B97F4A7C15
_P = np.uint64(0xD6E8FEB86659FD93)


def _step(n: int) -> np.uint64:
    return np.uint64(n * _G & (1 << 64) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Plan:
    """Bands of a signature for a threshold: as many rows each as ``COMPONENTS`` allows while a
    pair at the threshold is missed in all bands with probability ``MISSED`` at most."""

    threshold: float

    def __post_init__(self):
        if not 0.2 <= self.threshold <= 1:
            raise ValueError(f"the threshold must be from 0.2 to 1: {self.threshold}")

    @property
    def rows(self) -> int:
        fitting = [r for r in range(1, 9) if r * self._bands(r) <= COMPONENTS]
        return max(fitting)

    @property
    def bands(self) -> int:
        return self._bands(self.rows)

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreeing(self) -> int:
        """Pairs whose sketches agree in fewer components are not looked up: at the threshold that
        is five standard deviations below the mean, and loses a pair with probability 3e-7."""
        t = self.threshold
        return int(self.size * t - 5 * (self.size * t * (1 - t)) ** 0.5)

    def _bands(self, rows: int) -> int:
        agree = self.threshold**rows
        return 1 if agree == 1 else math.ceil(math.log(MISSED) / math.log1p(-agree))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = out
        return out


def bag(words: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the different shingles and how often each occurs. A text of fewer words
    than a shingle, but not none, is one shingle."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own = np.array([hashes[w] for w in words], dtype=np.uint64)
    size = min(size, len(own))
    count = len(own) - size + 1
    rolled = np.full(count, size, dtype=np.uint64)
    for i in range(size):
        rolled = rolled * _P + own[i : i + count]
    return np.unique(_mix(rolled), return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], length: int) -> np.ndarray:
    """BagMinHash components (times), one row per bag; an empty bag has no finite component."""
    out = np.full((len(bags), length), np.inf)
    sizes = [len(b[0]) for b in bags]
    if not sum(sizes):
        return out
    element = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags])
    doc = np.repeat(np.arange(len(bags)), sizes)
    # One process per element and piece of its weight axis that begins below its weight.
    key, owner, low, span, limit = [], [], [], [], []
    piece, start, width = 0, 0, 1
    at = np.arange(len(element))
    while len(at):
        key.append(_mix(element[at] ^ _step(piece)))
        owner.append(doc[at])
        low.append(np.full(len(at), start))
        span.append(np.full(len(at), width))
        limit.append(weight[at])
        start, width, piece = start + width, max(1, start + width), piece + 1
        at = at[weight[at] > start]
    key, owner, low, span, limit = map(np.concatenate, (key, owner, low, span, limit))
    time, worst, flat = np.zeros(len(key)), np.full(len(bags), np.inf), out.reshape(-1)
    step = 0
    while len(key):
        draw = _mix(key + _step(3 * step + 1))
        part = _mix(key + _step(3 * step + 2))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / (span * length)
        alive = time < worst[owner]
        key, owner, low, span, limit, time, part = (
            x[alive] for x in (key, owner, low, span, limit, time, part)
        )
        if not len(key):
            break
        component = (part % np.uint64(length)).astype(np.int64)
        counts = np.ones(len(key), dtype=bool)
        wide = np.flatnonzero(low + span > limit)
        if len(wide):
            place = _mix(key[wide] + _step(3 * step + 3))
            at = low[wide] + (place % span[wide].astype(np.uint64)).astype(np.int64)
            counts[wide] = at < limit[wide]
        np.minimum.at(flat, (owner * length + component)[counts], time[counts])
        docs = np.unique(owner)
        worst[docs] = out[docs].max(axis=1)
        step += 1
    return out


def bands(signature: np.ndarray, count: int, rows: int) -> np.ndarray:
    """One hash per band and bag."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), count, rows)
    out = np.repeat(np.arange(count, dtype=np.uint64)[None, :], len(signature), axis=0)
    for i in range(rows):
        out = out * _P + bits[:, :, i]
    return _mix(out).view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """One byte per component: equal where the components are, else with probability 1/256."""
    bits = np.ascontiguousarray(signature).view(np.uint64)
    return (_mix(bits) >> np.uint64(56)).astype(np.uint8)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact weighted Jaccard similarity of two bags: shared weight over joint weight."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    joint = int(a[1].sum() + b[1].sum()) - shared
    return shared / joint if joint else 0.0


def _print(words: list[bytes]) -> bytes:
    """The same for the same words in the same order."""
    return hashlib.md5(b" ".join(words)).digest()


def _signed(docs: DataFrame, plan: Plan) -> DataFrame:
    """``doc_id, print, bands, sketch`` of every row; without an id or a word only the id."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 100):
                split = [words_of(t) for t in texts[at : at + 100]]
                ids = batch.column(0).slice(at, len(split))
                rows = [i for i, words in enumerate(split) if words and ids[i].is_valid]
                signed = signatures([bag(split[i], hashes) for i in rows], plan.size)
                found = pa.StructArray.from_arrays(
                    [
                        pa.array([_print(split[i]) for i in rows], pa.binary()),
                        pa.array(bands(signed, plan.bands, plan.rows).tolist(), pa.list_(pa.int64())),
                        pa.array([b.tobytes() for b in sketch(signed)], pa.binary()),
                    ],
                    ["print", "bands", "sketch"],
                )
                where = np.full(len(split), -1)
                where[rows] = np.arange(len(rows))
                found = found.take(pa.array(where, mask=where < 0))
                yield pa.RecordBatch.from_arrays([ids, *found.flatten()], ["doc_id", "print", "bands", "sketch"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    schema = "doc_id long, print binary, bands array<long>, sketch binary"
    return texts.mapInArrow(sign, schema)


def _print_of(text: Column) -> Column:
    """The print of a text's UTF-8 bytes; NULL where there is no word. Marked as not deterministic,
    or a filter on it would run it once more, in a second Python worker for each task, and the
    workers that this leaves take part in all later stages, each with helpers of its own."""

    @F.arrow_udf("binary")
    def prints(texts: pa.Array) -> pa.Array:
        split = map(words_of, texts.to_pylist())
        return pa.array([_print(words) if words else None for words in split], pa.binary())

    return prints.asNondeterministic()(text)


def _check(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` (texts ``text_a``, ``text_b``) that are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes = WordHashes()
        last, left = None, None  # rows of one a come one after another
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            kept = []
            for i in range(len(a)):
                if a[i] != last:
                    last, left = a[i], bag(words_of(text_a[i]), hashes)
                if similarity(left, bag(words_of(text_b[i]), hashes)) >= threshold:
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


_TILE = ["key", "tile_a", "tile_b"]


def _likely(least: int):
    """For each member of a tile that resembles another by sketch (in ``least`` components): the
    member, and the smallest it resembles there."""
    return lambda batches: _likely_in_tiles(batches, least)


def _likely_in_tiles(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for tile in runs(batches, len(_TILE)):
        node, chunk = tile["node"].to_numpy(), tile["chunk"].to_numpy()
        order = np.argsort(node)
        node, chunk = node[order], chunk[order]
        own = np.frombuffer(b"".join(tile["sketch"].to_pylist()), np.uint8).reshape(len(node), -1)[order]
        across = tile["tile_a"][0] != tile["tile_b"][0]
        found, partner = [], []
        for at in range(0, len(node), 64):
            some = own[at : at + 64]
            agree = np.zeros((len(some), len(own)), dtype=np.uint16)
            for c in range(own.shape[1]):
                agree += some[:, c, None] == own[None, :, c]
            like = agree >= least
            like[np.arange(len(some)), at + np.arange(len(some))] = False
            if across:
                like &= chunk[at : at + 64, None] != chunk[None, :]
            row = np.flatnonzero(like.any(axis=1))
            found.append(node[at + row])
            partner.append(node[like[row].argmax(axis=1)])
        found, partner = np.concatenate(found), np.concatenate(partner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), tile["key"][0].as_py())), pa.array(found), pa.array(partner)],
            ["key", "node", "partner"],
        )


def overlaps(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Shared weight of every two bags. Occurrence k of a shingle counts as an element of its own,
    so shared elements are shared weight; elements of one bag alone are left out first."""
    element = np.concatenate([np.repeat(h, n) for h, n in bags])
    nth = np.concatenate([np.arange(total) - np.repeat(np.cumsum(n) - n, n) for _, n in bags for total in [n.sum()]])
    element = _mix(element + nth.astype(np.uint64) * _P)
    doc = np.repeat(np.arange(len(bags)), [int(n.sum()) for _, n in bags])
    _, number, held = np.unique(element, return_inverse=True, return_counts=True)
    common = held[number] > 1
    doc, number = doc[common], number[common]
    order = np.argsort(number, kind="stable")
    doc, number = doc[order], np.unique(number[order], return_inverse=True)[1]
    shared = np.zeros((len(bags), len(bags)), dtype=np.float32)
    width = int(number.max()) + 1 if len(number) else 0
    for at in range(0, width, 8192):
        lo, hi = np.searchsorted(number, (at, at + 8192))
        part = np.zeros((len(bags), min(8192, width - at)), dtype=np.float32)
        part[doc[lo:hi], number[lo:hi] - at] = 1
        shared += part @ part.T
    return shared


def _links_in_tile(threshold: float):
    """Compare the documents of a tile; links that join what is not yet joined come back."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes = WordHashes()
        for tile in runs(batches, len(_TILE)):
            out = _joining(tile, hashes, threshold)
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

    return links


def _joining(tile: pa.Table, hashes: WordHashes, threshold: float) -> list[tuple[int, int]]:
    ids, groups = tile["node"].to_pylist(), tile["root"].to_pylist()
    if len(set(groups)) < 2:
        return []
    chunk = tile["chunk"].to_pylist()
    across = tile["tile_a"][0] != tile["tile_b"][0]
    bags = [bag(words_of(t), hashes) for t in tile["text"].to_pylist()]
    shared = overlaps(bags)
    size = np.array([int(n.sum()) for _, n in bags])
    near = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-3
    parent = {g: g for g in groups}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        if across and chunk[i] == chunk[j]:
            continue
        x, y = find(groups[i]), find(groups[j])
        if x != y and similarity(bags[i], bags[j]) >= threshold:
            parent[max(x, y)] = min(x, y)
            out.append((ids[i], ids[j]))
    return out


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text`` of the wanted nodes (``node, rep, print``). A Bloom filter of bounded size
    keeps most other texts from being shuffled; the join, by the words' print, is exact. Filter and
    print run in different stages, so a task has one Python worker at a time."""
    bloom = build_bloom(wanted, "rep")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    texts = texts.where(bloom.may_hold(F.col("doc_id"), docs.sparkSession))
    texts = texts.repartition("doc_id", F.xxhash64("text"))
    texts = texts.withColumn("print", _print_of(F.col("text"))).where("print IS NOT NULL")
    found = lookup_join(texts, wanted.select("node", "print"), ["print"], "inner")
    return settle(found.groupBy("node").agg(F.min("text").alias("text")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, print, class_id, kept``. ``class_id`` is the smallest
    id among the documents it is linked to, directly or through others; ``kept`` marks the class's
    first document (by id, then print). ``print`` is NULL where there is no id or no word.

    Documents are linked when they have the same words in the same order, or when their bags of
    five-word shingles have a weighted Jaccard similarity of ``threshold`` or more. The steps:

    1. Copies are folded into one node, so a group of any size is one row from there. A node
       stands for words, not for an id: rows that share an id need not be alike.
    2. Nodes that agree in a band share a bucket. Their sketches (a byte per component) are
       compared in tiles of bounded size; each that resembles another there keeps its bucket and
       the smallest it resembles. Only their texts are read again, and these pairs, at most one
       per member and tile, are compared exactly.
    3. Where a bucket's members are then not all connected, the rest of its pairs is compared
       exactly, in tiles, passing over what is already connected. So every pair of a bucket is
       compared, or known to be connected, or too unlike by sketch. A bucket of n nodes that are
       neither copies nor alike costs (n / 512)^2 tiles of sketches.

    Bands and the least agreement of sketches follow from the threshold. Texts without words, NULL
    texts and NULL ids are in no class: their class is their own id and they are kept. Equal rows
    fare alike. An empty table gives no rows.
    """
    plan = Plan(threshold)
    signed = settle(_signed(docs, plan))
    nodes = signed.where("print IS NOT NULL").groupBy("print").agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")
    )
    nodes = settle(nodes.withColumn("node", F.monotonically_increasing_id()))
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("key"), "node"
    )
    buckets = (
        keyed.groupBy("key")
        .agg(
            F.min("node").alias("first"),
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("members"),
        )
        .where("size > 1")
        .groupBy("first", "size", "members")  # the same members in several bands: once
        .agg(F.min("key").alias("key"))
    )
    member = lookup_join(keyed, buckets.select("key", "size"), ["key"], "inner")
    member = member.join(nodes.select("node", "sketch"), "node")
    tiles = spread_tiles(member, ["key"], "size", "node", SKETCH_TILE)
    tiles = in_runs(tiles.select(*_TILE, "chunk", "node", "sketch"), _TILE)
    likely = settle(tiles.mapInArrow(_likely(plan.least_agreeing), "key long, node long, partner long"))
    pairs = likely.select(
        F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")
    ).distinct()
    texts = _texts_of(docs, nodes.join(likely.select("node").distinct(), "node").select("node", "rep", "print"))
    pairs = pairs.join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    pairs = lookup_join(
        pairs, texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), ["a"], "inner"
    )
    links = settle(_check(pairs, threshold))
    joined = settle(components(links, "a", "b"))

    grouped = likely.select("key", "node").distinct().join(joined, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    # A bucket of two has no pair beyond the one already compared.
    open_buckets = (
        grouped.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
        .where("low < high AND size > 2")
        .select("key", "size")
    )
    rest = lookup_join(grouped, open_buckets, ["key"], "inner").join(texts, "node")
    tiles = spread_tiles(rest, ["key"], "size", "node", TILE)
    tiles = in_runs(tiles.select(*_TILE, "chunk", "node", "root", "text"), _TILE)
    more = tiles.mapInArrow(_links_in_tile(threshold), "a long, b long")
    roots = components(links.unionByName(more), "a", "b")
    rooted = nodes.select("node", "rep", "print").join(roots, "node", "left")
    rooted = settle(rooted.select("rep", "print", F.coalesce("root", "node").alias("root")))
    first = rooted.groupBy("root").agg(F.min(F.struct("rep", "print")).alias("first"))
    classes = lookup_join(rooted.select("print", "root"), first, ["root"], "inner").select(
        "print", F.col("first.rep").alias("class_id"), F.col("first.print").alias("first")
    )
    found = lookup_join(signed.select("doc_id", "print"), classes, ["print"], "left")
    kept = (F.col("print") == F.col("first")) & (F.col("doc_id") == F.col("class_id"))
    return found.select(
        "doc_id", "print", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce(kept, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that have a near duplicate with a smaller id: of each class one
    row stays. Documents in no class stay, so do all rows without an id. All columns are kept.

    Only ids are shuffled, and the rows that a Bloom filter of bounded size holds for rows to go
    or for ids on several rows; of the latter the words decide, so no unlike row goes with them.
    """
    judged = near_duplicates(docs, threshold).where("doc_id IS NOT NULL")
    judged = settle(judged.groupBy("doc_id", "print", "kept").agg(F.count("*").alias("n")))
    fate = judged.groupBy("doc_id").agg(F.sum("n").alias("n"), F.bool_or("kept").alias("stays"))
    fate = settle(fate.where("n > 1 OR NOT stays").select("doc_id", "stays"))
    held = build_bloom(fate, "doc_id").may_hold(F.col("_id"), docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.struct("*").alias("_row"))
    told = lookup_join(rows.where(held), fate.withColumnRenamed("doc_id", "_id"), ["_id"])
    single = told.where("stays IS NULL")
    parts = [rows.where(~held), single]
    if not fate.where("stays").isEmpty():
        several = settle(told.where("stays").select("_id", "_row"))
        several = several.withColumn("print", _print_of(F.col("_row.text").cast("string").cast("binary")))
        kept = judged.where("kept AND print IS NOT NULL").select(F.col("doc_id").alias("_id"), "print")
        chosen = (
            lookup_join(several.where("print IS NOT NULL"), kept, ["_id", "print"], "inner")
            .groupBy("_id", "print")
            .agg(F.min_by("_row", "_row.text").alias("_row"))
        )
        parts += [several.where("print IS NULL"), chosen]
    out = parts[0].select("_row.*")
    for part in parts[1:]:
        out = out.unionByName(part.select("_row.*"))
    return out
