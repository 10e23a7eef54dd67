"""Class-based n-gram scoring: exchange clustering of words, class transitions, word emissions.

The probability of a token is P(its class | the class before) x P(word | its class). Classes come
in two steps. Units are clustered by exchange: each of the most frequent words alone, all other
words by their ending; their tables stay bounded, at most ``HEAD + ENDINGS + 1`` units. Then every
other word of the training texts, however rare, gets the class under which its neighbours are
likeliest. Only words never seen in training take the class of their ending.

Texts are read in blocks: a block numbers its different words and holds its texts as numbers, so
that each of its words is looked up once. Word counts and classes are not bounded: they stay a table,
dealt into buckets by word; the words of a block travel there packed, one row a bucket, and what was
found travels back to the block. Only the most frequent words are broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import ASCII_LOWER, in_runs, runs, utf8
from martloom.llm.packed import pack_ints, pack_words, unpack_ints, unpack_words
from martloom.session import settle

HEAD = 4096  # words that are units of their own
ENDINGS = 512  # units of the other words, by a hash of their last three bytes
CLASSES = 100  # the last one is for the end of a text alone
ROUNDS = 6  # exchange rounds
DICTIONARY = 1 << 17  # most frequent words, broadcast with their counts
DICTIONARY_BYTES = 256  # longer words are never broadcast
BLOCK_TOKENS = 1 << 21  # a block ends with the batch that brings it to as many tokens
BLOCK_BYTES = 16 << 20  # or to as many bytes of text
BUCKETS = 64  # buckets of words at least
BUCKET_BYTES = 8 << 20  # bytes of training text for each further bucket
BUCKET_WORDS = 1 << 15  # words of the vocabulary for each further bucket, when texts are scored
CHOSEN = 5_000  # rows of words whose classes are chosen at a time
FLUSH = 200_000  # words that a task packs at a time
FLUSH_TOKENS = 4_000_000  # tokens after which a task sums up its pairs
DISCOUNT = 0.75  # taken off each word outside the head, for the unknown ones of its class
LEAN = 2.0  # occurrences with its ending's neighbours that each word outside the head starts with
PRIOR = 5.0  # weight of the class distribution in each row of transitions
UNITS = HEAD + ENDINGS + 1
END = UNITS - 1


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased; NULL counts as empty."""
    return (text or b"").translate(ASCII_LOWER).split()


def ending(word: bytes) -> int:
    return HEAD + zlib.crc32(word[-3:]) % ENDINGS


def _units(words: list[bytes], head: dict[bytes, int]) -> np.ndarray:
    """The unit of each word of a block, whose first one is the end."""
    get = head.get
    out = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
    rest = np.flatnonzero(out < 0)
    out[rest] = [ending(words[i]) for i in rest.tolist()]
    out[0] = END
    return out


def tokens_of_all(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens_of`` of each text: all words in a row, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = lists.values  # with empty ones before and after
    real = pc.greater(pc.binary_length(words), 0)
    upto = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    return words.filter(real), np.diff(upto[lists.offsets.to_numpy()])


_WORDS = T.ArrayType(
    T.StructType(
        [
            T.StructField("bucket", T.IntegerType()),
            T.StructField("body", T.BinaryType()),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
        ]
    )
)


def blocks(
    docs: DataFrame, buckets: int, words: list[bytes] = (), tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Column ``text`` (UTF-8 bytes) as numbers, one row per block of whole texts:

    * ``stream``: the number of each token, 0 for an end; one end stands before the first text;
    * ``common``: the places in ``words`` of the block's numbers from 1 on that have one;
    * ``words``: the numbers after those, for each bucket that has any, with their counts here.
      Without ``words`` the end is among them, as the first word of bucket 0;
    * ``doc_id``: the texts' ids, if ``docs`` has such a column.
    """
    named = "doc_id" in docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(words)
    fields = [
        T.StructField("block", T.LongType()),
        T.StructField("stream", T.BinaryType()),
        T.StructField("common", T.BinaryType()),
        T.StructField("words", _WORDS),
    ]
    if named:
        fields.append(T.StructField("doc_id", T.ArrayType(docs.schema["doc_id"].dataType)))
    kind = pa.list_(
        pa.struct([("bucket", pa.int32()), *[(n, pa.binary()) for n in ("body", "sizes", "counts")]])
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(shared.value)}
        block = TaskContext.get().partitionId() << 32
        words, texts, ids, count, size = [], [], [], 0, 0
        for batch in batches:
            own, n = tokens_of_all(batch.column(0))
            words.append(own)
            texts.append(n)
            if named:
                ids.append(batch.column(1))
            count += len(own) + len(n)
            size += batch.column(0).nbytes
            if count >= tokens or size >= BLOCK_BYTES:
                yield row(block, place, words, texts, ids)
                block += 1
                words, texts, ids, count, size = [], [], [], 0, 0
        if count:
            yield row(block, place, words, texts, ids)

    def row(block, place, words, texts, ids) -> pa.RecordBatch:
        words = pa.chunked_array(words).combine_chunks().dictionary_encode()
        ends = np.append(0, np.cumsum(np.concatenate(texts) + 1))
        stream = np.zeros(ends[-1] + 1, dtype=np.int64)
        inside = np.ones(len(stream), dtype=bool)
        inside[ends] = False
        stream[inside] = words.indices.to_numpy() + 1
        own = [b"", *words.dictionary.cast(pa.binary()).to_pylist()]
        del words
        bucket = np.fromiter(map(zlib.crc32, own), np.int64, len(own)) % buckets
        common = np.zeros(0, dtype=np.int64)
        if place:
            get = place.get
            common = np.fromiter((get(w, -1) for w in own), np.int64, len(own))
            bucket[common >= 0] = -1
            common = common[common >= 0]
        if named:
            bucket[0] = -1
        order = np.argsort(bucket, kind="stable")
        number_of = np.empty(len(own), dtype=np.int64)
        number_of[order] = np.arange(len(own))
        stream = number_of[stream]
        n = np.bincount(stream, minlength=len(own))
        n[0] -= 1  # the end before the first text
        own = [own[i] for i in order.tolist()]
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        dealt = []
        for b, (i, j) in enumerate(zip(ends, ends[1:])):
            if i < j:
                body, sizes = pack_words(own[i:j])
                counts = None if named else pack_ints(n[i:j])
                dealt.append({"bucket": b, "body": body, "sizes": sizes, "counts": counts})
        columns = [
            pa.array([block], pa.int64()),
            pa.array([pack_ints(stream)], pa.binary()),
            pa.array([pack_ints(common) if len(common) else None], pa.binary()),
            pa.array([dealt], kind),
        ]
        if named:
            flat = pa.concat_arrays(ids)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    texts = docs.select("text", "doc_id") if named else docs.select("text")
    return texts.mapInArrow(number, T.StructType(fields))


def _asked(numbered: DataFrame) -> DataFrame:
    """The words of the blocks, one row for each bucket of a block."""
    return numbered.select("block", F.explode("words").alias("own")).select("block", "own.*")


def _own(row: dict) -> list[bytes]:
    """All words of a block."""
    return [w for own in row["words"] for w in unpack_words(own["body"], own["sizes"])]


def word_counts(numbered: DataFrame) -> DataFrame:
    """``(word, c)`` over all blocks; the word '' counts the texts, and so their ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in runs(batches, 1):
            held: dict[bytes, int] = {}
            get = held.get
            for row in bucket.to_pylist():
                words = unpack_words(row["body"], row["sizes"])
                for word, n in zip(words, unpack_ints(row["counts"]).tolist()):
                    held[word] = get(word, 0) + n
            yield _counted(held)

    rows = _asked(numbered).select("bucket", "body", "sizes", "counts")
    return in_runs(rows, ["bucket"]).mapInArrow(count, "word string, c long")


def _counted(held: dict[bytes, int]) -> pa.RecordBatch:
    words = pa.array(list(held), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "c"])


def _dictionary(counts: DataFrame, size: int) -> tuple[pd.DataFrame, int]:
    """The most frequent words with their counts, and the least count among them. The limit is
    found from how many words have each count, so that all words of a count are in or out and
    never more than ``size`` rows are collected."""
    short = counts.where(f"word <> '' AND octet_length(word) <= {DICTIONARY_BYTES}")
    step = F.when(F.col("c") < 65536, F.col("c")).otherwise(
        F.pow(F.lit(2.0), F.floor(F.log2(F.col("c")))).cast("long")
    )
    held = short.groupBy(step.alias("step")).agg(F.count("*").alias("n")).toPandas()
    held = held.sort_values("step", ascending=False)
    fits = held[held["n"].cumsum() <= size]
    least = int(fits["step"].min()) if len(fits) else 1 << 62
    top = short.where(F.col("c") >= least).toPandas()
    top["word"] = [w.encode() for w in top["word"]]
    return top.sort_values(["c", "word"], ascending=[False, True], ignore_index=True), least


def unit_neighbours(numbered: DataFrame, head: dict[bytes, int]) -> DataFrame:
    """One row per unit: the units after it and before it with counts, from all blocks. A text
    begins and ends at the end unit. At most ``UNITS`` rows of at most ``UNITS`` neighbours."""
    shared = numbered.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(_units(_own(row), shared.value)[unpack_ints(row["stream"])])
                size += len(held[-1])
                if size >= FLUSH_TOKENS:
                    yield _pairs(held)
                    held, size = [], 0
        if held:
            yield _pairs(held)

    pairs = (
        numbered.select("stream", "words")
        .mapInArrow(count, "pair int, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .select(
            F.floor(F.col("pair") / UNITS).cast("int").alias("a"),
            (F.col("pair") % UNITS).alias("b"),
            "n",
        )
    )
    pairs = settle(pairs)
    sides = pairs.select(F.col("a").alias("unit"), F.col("b").alias("other"), "n", F.lit(1).alias("s"))
    sides = sides.unionByName(
        pairs.select(F.col("b").alias("unit"), F.col("a").alias("other"), "n", F.lit(0).alias("s"))
    )
    packed = sides.groupBy("unit", "s").agg(
        F.array_sort(F.collect_list(F.struct("other", "n"))).alias("near")
    )
    after, before = (
        packed.where(f"s = {s}").select("unit", F.col("near").alias(name))
        for s, name in ((1, "after"), (0, "before"))
    )
    # Frequent and rare units in every file, so that the tasks of a round are alike.
    return settle(after.join(before, "unit", "full").repartition(12))


def _pairs(held: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate([own[:-1] * UNITS + own[1:] for own in held])
    pair, n = np.unique(flat, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(pair, pa.int32()), pa.array(n, pa.int64())], ["pair", "n"]
    )


def _near(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Neighbour units and their counts of each row of an Arrow list column."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.values
    other = values.field("other").to_numpy(zero_copy_only=False)
    n = values.field("n").to_numpy(zero_copy_only=False).astype(np.float64)
    out, at = [], flat.offsets.to_numpy()
    valid = flat.is_valid().to_pylist()
    for i, ok in enumerate(valid):
        a, b = (at[i], at[i + 1]) if ok else (0, 0)
        out.append((other[a:b], n[a:b]))
    return out


def transitions(near: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs. Each task sums its units up to one small matrix."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((CLASSES, CLASSES))
        for batch in batches:
            for unit, (other, n) in zip(batch.column(0).to_pylist(), _near(batch.column(1))):
                held[classes[unit]] += np.bincount(classes[other], n, CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["held"])

    out = np.zeros((CLASSES, CLASSES))
    for row in near.select("unit", "after").mapInArrow(count, "held binary").collect():
        out += np.frombuffer(row["held"]).reshape(CLASSES, CLASSES)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of the class sequence, up to what does not depend on the classes."""
    return float(
        _xlogx(pairs).sum() - _xlogx(pairs.sum(axis=0)).sum() - _xlogx(pairs.sum(axis=1)).sum()
    )


def best_class(
    pairs: np.ndarray, old: int, after: np.ndarray, before: np.ndarray, own: float
) -> tuple[int, float]:
    """Where a unit of class ``old`` raises the likelihood most, and by how much.

    ``after`` and ``before`` are its neighbours' counts per class without itself, ``own`` how
    often it follows itself. ``pairs`` is left as the counts without the unit.
    """
    pairs[old] -= after
    pairs[:, old] -= before
    pairs[old, old] -= own
    # Wherever it goes, its neighbours' classes keep the tokens beside it.
    rows, columns = pairs.sum(axis=1) + before, pairs.sum(axis=0) + after
    base = _xlogx(pairs)
    gain = (_xlogx(pairs + after) - base).sum(axis=1)
    gain += (_xlogx(pairs + before[:, None]) - base).sum(axis=0)
    at = np.diag(pairs)
    gain -= _xlogx(at + after) + _xlogx(at + before) - 2 * np.diag(base)
    gain += _xlogx(at + after + before + own) - np.diag(base)
    gain -= _xlogx(rows + after.sum() + own) - _xlogx(rows)
    gain -= _xlogx(columns + before.sum() + own) - _xlogx(columns)
    new = int(np.argmax(gain[:-1]))  # the last class is the end's alone
    return new, float(gain[new] - gain[old])


def exchange(near: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and their pair counts.

    In each round every task moves its own units one after another to the class that raises the
    likelihood most, on its own copy of the class counts; then the counts are taken anew. The
    best assignment seen is kept, so moves that clash do no harm.
    """
    classes = np.arange(UNITS) % (CLASSES - 1)
    classes[END] = CLASSES - 1
    pairs = transitions(near, classes)
    best, best_classes, best_pairs = likelihood(pairs), classes, pairs
    for _ in range(rounds):
        start, counts = classes, pairs

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, held, moved = start.copy(), counts.copy(), []
            for batch in batches:
                rows = zip(batch.column(0).to_pylist(), _near(batch.column(1)), _near(batch.column(2)))
                for unit, (right, n), (left, m) in rows:
                    if unit == END:
                        continue
                    itself = float(n[right == unit].sum())
                    after = np.bincount(own[right], n * (right != unit), CLASSES)
                    before = np.bincount(own[left], m * (left != unit), CLASSES)
                    new, gain = best_class(held, own[unit], after, before, itself)
                    if gain > 1e-9:
                        own[unit] = new
                        moved.append((unit, new))
                    held[own[unit]] += after
                    held[:, own[unit]] += before
                    held[own[unit], own[unit]] += itself
            unit, new = zip(*moved) if moved else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit, pa.int32()), pa.array(new, pa.int32())], ["unit", "new"]
            )

        moves = near.select("unit", "after", "before").mapInArrow(move, "unit int, new int").collect()
        if not moves:
            break
        classes = start.copy()
        for row in moves:
            classes[row["unit"]] = row["new"]
        pairs = transitions(near, classes)
        now = likelihood(pairs)
        if now > best:
            best, best_classes, best_pairs = now, classes, pairs
    return best_classes, best_pairs


def _neighbour_likelihoods(pairs: np.ndarray) -> np.ndarray:
    """Log-likelihood, for each class of a word, of a neighbour's class after it (first rows) and
    before it (last rows), by the smoothed class pairs."""
    held = pairs + PRIOR * np.outer(pairs.sum(axis=1) + 0.5, pairs.sum(axis=0) + 0.5) / (
        (pairs.sum() + 0.5 * CLASSES) * CLASSES
    )
    after = np.log(held / held.sum(axis=1, keepdims=True)).T
    before = np.log(held / held.sum(axis=0, keepdims=True))
    return np.concatenate((after, before))


def _ending_neighbours(near: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Of each ending, the share of each class after it and before it (zeros for one not seen)."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for (right, n), (left, m) in zip(_near(batch.column(1)), _near(batch.column(2))):
                after = np.bincount(classes[right], n, CLASSES) / max(n.sum(), 1)
                before = np.bincount(classes[left], m, CLASSES) / max(m.sum(), 1)
                held.append(np.concatenate((after, before)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(held, pa.binary())], ["unit", "held"]
            )

    out = np.zeros((ENDINGS, 2 * CLASSES))
    endings = near.where(f"unit >= {HEAD} AND unit < {END}").select("unit", "after", "before")
    for r in endings.mapInArrow(share, "unit int, held binary").collect():
        out[r["unit"] - HEAD] = np.frombuffer(r["held"])
    return out


def word_neighbours(numbered: DataFrame, head: dict[bytes, int], classes: np.ndarray) -> DataFrame:
    """``word, codes, counts`` of the words outside the head: how often a neighbour's class (a
    byte; plus ``CLASSES`` if it stands before) was met. Neighbours outside the head count by their
    ending. A word has a row for each block, with at most ``2 * CLASSES`` codes."""
    shared = numbered.sparkSession.sparkContext.broadcast((head, classes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, classes = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                words, stream = _own(row), unpack_ints(row["stream"])
                unit = _units(words, head)
                outside = (unit >= HEAD) & (unit < END)
                near = classes[unit][stream]
                tail = np.flatnonzero(outside[stream])
                at = (np.cumsum(outside) - 1)[stream[tail]] * (2 * CLASSES)
                yield _coded(
                    [words[i] for i in np.flatnonzero(outside).tolist()],
                    np.concatenate((at + near[tail + 1], at + CLASSES + near[tail - 1])),
                )

    rows = numbered.select("stream", "words")
    return rows.mapInArrow(count, "word string, codes binary, counts binary")


def _coded(words: list[bytes], met: np.ndarray) -> pa.RecordBatch:
    flat, n = np.unique(met, return_counts=True)
    ends = np.searchsorted(flat, np.arange(len(words) + 1) * 2 * CLASSES)

    def packed(values: np.ndarray) -> pa.Array:
        offsets = pa.py_buffer((ends * values.itemsize).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(values)])

    return pa.RecordBatch.from_arrays(
        [
            pa.array(words, pa.binary()).cast(pa.string()),
            packed((flat % (2 * CLASSES)).astype(np.uint8)),
            packed(n.astype("<u4")),
        ],
        ["word", "codes", "counts"],
    )


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``CHOSEN``, except for the last one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHOSEN:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def word_classes(rows: DataFrame, likely: np.ndarray, endings: np.ndarray) -> DataFrame:
    """``word, c, class`` from the rows of ``word_neighbours``: each word's occurrences, and the
    class under which its neighbours, and ``LEAN`` more of its ending's, are likeliest.

    Rows are sorted by word and summed as they pass, so a task holds some batches and one sum.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(2 * CLASSES)
        for batch in _larger(batches):
            size = batch.num_rows
            words = batch.column(0)
            first = np.ones(size, dtype=bool)
            first[1:] = pc.not_equal(words.slice(1), words.slice(0, size - 1)).to_numpy(False)
            group = np.cumsum(first) - 1
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
            n = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4")
            group = np.repeat(group, pc.binary_length(batch.column(1)).to_numpy())
            width = 2 * CLASSES
            met = np.bincount(group * width + code, n, int(first.sum()) * width).reshape(-1, width)
            names = words.take(pa.array(np.flatnonzero(first))).cast(pa.binary()).to_pylist()
            if names[0] == last:
                met[0] += held
            elif last is not None:
                names, met = [last, *names], np.concatenate((held[None], met))
            last, held = names.pop(), met[-1]
            if names:
                yield chosen(names, met[:-1])
        if last is not None:
            yield chosen([last], held[None])

    def chosen(names: list[bytes], met: np.ndarray) -> pa.RecordBatch:
        own = [ending(w) - HEAD for w in names]
        fit = (met + LEAN * endings[own]) @ likely
        best = np.argmax(fit[:, :-1], axis=1)  # the last class is the end's alone
        count = met[:, :CLASSES].sum(axis=1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.binary()).cast(pa.string()),
                pa.array(count.astype(np.int64)),
                pa.array(best.astype(np.int32)),
                pa.array(own, pa.int32()),
            ],
            ["word", "c", "class", "ending"],
        )

    rows = rows.repartition("word").sortWithinPartitions("word")
    return rows.mapInArrow(choose, "word string, c long, class int, ending int")


def _bucketed(lexicon: DataFrame, buckets: int) -> DataFrame:
    """``word, c, class`` packed, one row for each bucket of a task's words, as block -1."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        c, k = [], []
        for batch in batches:
            words += batch.column(0).cast(pa.binary()).to_pylist()
            c.append(batch.column(1).to_numpy())
            k.append(batch.column(2).to_numpy())
            if len(words) >= FLUSH:
                yield dealt(words, np.concatenate(c), np.concatenate(k))
                words, c, k = [], [], []
        if words:
            yield dealt(words, np.concatenate(c), np.concatenate(k))

    def dealt(words: list[bytes], c: np.ndarray, k: np.ndarray) -> pa.RecordBatch:
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        words = [words[i] for i in order.tolist()]
        c, k = c[order], k[order]
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        rows = [
            (b, *pack_words(words[i:j]), pack_ints(c[i:j]), pack_ints(k[i:j]))
            for b, (i, j) in enumerate(zip(ends, ends[1:]))
            if i < j
        ]
        own, *packed = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), *[pa.array(p, pa.binary()) for p in packed]],
            ["bucket", "body", "sizes", "counts", "codes"],
        )

    rows = lexicon.select("word", "c", "class").mapInArrow(
        pack, "bucket int, body binary, sizes binary, counts binary, codes binary"
    )
    return rows.withColumn("block", F.lit(-1).cast("long"))


def looked_up(numbered: DataFrame, lexicon: DataFrame, buckets: int, given: dict[bytes, int]) -> DataFrame:
    """The blocks' words in the lexicon: ``block, bucket, counts, codes``, both in the order of the
    block's words there. A code is the class of a word of the lexicon or of ``given``, and
    ``CLASSES`` plus its ending for any other; those have no count. A task holds one bucket of the
    lexicon."""
    shared = numbered.sparkSession.sparkContext.broadcast(given)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, last = shared.value, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != last:
                    last, place, c, k = row["bucket"], {}, [], []
                words = unpack_words(row["body"], row["sizes"])
                if row["block"] < 0:
                    place.update(zip(words, range(len(place), len(place) + len(words))))
                    c.append(unpack_ints(row["counts"]))
                    k.append(unpack_ints(row["codes"]))
                    continue
                if len(c) != 1:
                    c = [np.concatenate([*c, np.zeros(0, dtype=np.int64)])]
                    k = [np.concatenate([*k, np.zeros(0, dtype=np.int64)])]
                get = place.get
                at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                counts, codes = np.append(c[0], 0)[at], np.append(k[0], 0)[at]
                for i in np.flatnonzero(at < 0).tolist():
                    code = given.get(words[i])
                    codes[i] = CLASSES + ending(words[i]) - HEAD if code is None else code
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([last], pa.int32()),
                        pa.array([pack_ints(counts)], pa.binary()),
                        pa.array([pack_ints(codes)], pa.binary()),
                    ],
                    ["block", "bucket", "counts", "codes"],
                )

    asked = _asked(numbered).drop("counts")
    rows = _bucketed(lexicon, buckets).unionByName(asked, allowMissingColumns=True)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "block")
    return rows.mapInArrow(find, "block long, bucket int, counts binary, codes binary")


def _with_found(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """Each block beside what was found for its words, for ``_found``. A task holds the blocks
    that came from one task, so no more than a part of the input that was read at once."""
    own = numbered.withColumn("bucket", F.lit(-1))
    task = F.shiftright("block", 32).cast("int")
    tasks = numbered.agg(F.max(task)).first()[0]
    rows = own.unionByName(found, allowMissingColumns=True)
    return rows.repartitionById((tasks or 0) + 1, task).sortWithinPartitions("block")


def _found(block: pa.Table) -> tuple[dict, list[dict]]:
    """A block's own row, and what its buckets gave in the order of its numbers."""
    first, *rest = sorted(block.to_pylist(), key=lambda row: row["bucket"])
    return first, rest


def class_pairs(numbered: DataFrame, lexicon: DataFrame, buckets: int, given: dict[bytes, int]) -> np.ndarray:
    """How often a class follows a class in the blocks, each word in its own class: that of the
    lexicon, or of ``given`` for the words of the head and the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for block in runs(batches, 1):
            own, found = _found(block)
            path = np.concatenate([unpack_ints(r["codes"]) for r in found])[unpack_ints(own["stream"])]
            held += np.bincount(path[:-1] * CLASSES + path[1:], minlength=len(held))
        pair = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair, pa.int32()), pa.array(held[pair], pa.int64())], ["pair", "n"]
        )

    found = looked_up(numbered, lexicon, buckets, given).drop("counts")
    rows = _with_found(numbered.select("block", "stream"), found).mapInArrow(count, "pair int, n long")
    out = np.zeros(CLASSES * CLASSES)
    # At most CLASSES ** 2 rows.
    for r in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


@dataclass(frozen=True)
class BrownModel:
    """What scoring needs. ``rare`` (``word, c, class``) holds the training words outside the
    dictionary; the rest is bounded."""

    rare: DataFrame
    train_tokens: int
    vocabulary: int
    train_texts: int
    words: list[bytes]  # the dictionary
    word_counts: np.ndarray
    classes: np.ndarray  # of its words
    emit: np.ndarray  # log10 P(word | class) of its words
    pairs: np.ndarray  # how often a class follows a class
    step: np.ndarray  # log10 P(class | class before)
    taken: np.ndarray  # per class: taken off the count of each word outside the head
    norm: np.ndarray  # per class: log10 of its mass
    ending_classes: np.ndarray  # classes of words never seen, by ending
    unknown: np.ndarray  # log10 P(a word never seen, of this ending | its class)

    @property
    def base_norm(self) -> float:
        return math.log10(self.train_tokens + 0.5 * (self.vocabulary + 1))


def fit(texts: DataFrame, head: int = HEAD, dictionary: int = DICTIONARY) -> BrownModel:
    """Fit on the column ``text`` (UTF-8 bytes). The ``head`` (at most ``HEAD``) most frequent words
    are clustered each alone, ``dictionary`` words are broadcast. No texts at all give uniform
    distributions."""
    ends = F.sum(F.when(F.col("word") == "", F.col("c")))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, size // BUCKET_BYTES)
    numbered = settle(blocks(texts.select("text"), buckets))
    counts = settle(word_counts(numbered))
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), ends.alias("ends")).first()
    top, least = _dictionary(counts, dictionary)
    words, known = top["word"].tolist(), top["c"].to_numpy(dtype=np.int64)
    alone = {w: i for i, w in enumerate(words[: min(head, HEAD)])}
    near = unit_neighbours(numbered, alone)
    units, pairs = exchange(near)

    met = word_neighbours(numbered, alone, units)
    lexicon = settle(word_classes(met, _neighbour_likelihoods(pairs), _ending_neighbours(near, units)))
    common = (F.col("c") >= least) & (F.octet_length("word") <= DICTIONARY_BYTES)
    rare = lexicon.where(~common).select("word", "c", "class")
    class_of = {r["word"].encode(): r["class"] for r in lexicon.where(common).select("word", "class").toLocalIterator()}
    classes = np.array(
        [units[i] if i < len(alone) else class_of[w] for i, w in enumerate(words)], dtype=np.int64
    )
    given = {b"": CLASSES - 1} | {w: int(units[i]) for w, i in alone.items()}
    pairs = class_pairs(numbered, lexicon, buckets, given)

    # Mass taken off a class's words goes to the endings of that class, by their different words.
    own = lexicon.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    tokens, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in own:
        tokens[r["class"]], types[r["class"]] = r["c"], r["v"]
    tokens += np.bincount(classes[: len(alone)], known[: len(alone)], CLASSES)
    share = np.full(ENDINGS, 0.5)
    for r in lexicon.groupBy("ending").agg(F.count("*").alias("v")).collect():
        share[r["ending"]] += r["v"]
    ending_classes = units[HEAD:END]
    open_ = np.bincount(ending_classes, minlength=CLASSES)
    taken = np.where(open_ > 0, DISCOUNT, 0.0)
    left = taken * types + 0.5 * open_
    mass = np.maximum(tokens + 0.5 * open_, 1e-300)
    unknown = share / np.bincount(ending_classes, share, CLASSES)[ending_classes]
    unknown = np.log10(unknown * left[ending_classes] / mass[ending_classes])
    count = known - np.where(np.arange(len(words)) < len(alone), 0.0, taken[classes])

    follow = pairs.sum(axis=0)
    prior = (follow + 0.5) / (follow.sum() + 0.5 * CLASSES)
    step = np.log10((pairs + PRIOR * prior) / (pairs.sum(axis=1, keepdims=True) + PRIOR))
    return BrownModel(
        rare=rare,
        train_tokens=int(total["n"] or 0),
        vocabulary=int(total["v"]),
        train_texts=int(total["ends"] or 0),
        words=words,
        word_counts=known,
        classes=classes,
        emit=np.log10(count) - np.log10(mass)[classes],
        pairs=pairs,
        step=step,
        taken=taken,
        norm=np.log10(mass),
        ending_classes=ending_classes,
        unknown=unknown,
    )


def score(docs: DataFrame, model: BrownModel) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``, one row per document.

    Both scores are log10 probabilities over the same events: each known word, the end, and
    "a word never seen", which the class model further splits by ending. A block's words of the
    dictionary are known where its texts lie; the others are packed and meet their counts and
    classes in their bucket, and the block's texts are scored when these are back. NULL and empty
    texts consist of the end alone; repeated rows and NULL ids are scored like any other row; an
    empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    buckets = max(BUCKETS, model.vocabulary // BUCKET_WORDS)
    numbered = settle(blocks(docs.select("doc_id", utf8("text").alias("text")), buckets, model.words))
    found = looked_up(numbered, model.rare, buckets, {})
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
    # Of the end, then of the dictionary's words.
    first = (
        np.append(CLASSES - 1, model.classes),
        np.append(0.0, np.log10(model.word_counts + 0.5)),
        np.append(0.0, model.emit),
    )
    shared = spark.sparkContext.broadcast(
        (*first, model.step, model.taken, model.norm, model.ending_classes, model.unknown)
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bases, emit, step, taken, norm, ending_classes, unknown = shared.value
        for block in runs(batches, 1):
            own, found = _found(block)
            none = np.zeros(0, dtype=np.int64)
            common = np.append(0, unpack_ints(own["common"]) + 1 if own["common"] else none)
            c = np.concatenate([none, *[unpack_ints(r["counts"]) for r in found]])
            code = np.concatenate([none, *[unpack_ints(r["codes"]) for r in found]])
            seen = c > 0
            tail = np.where(seen, 0, code - CLASSES)  # the ending of a word never seen
            k = np.where(seen, code, ending_classes[tail])
            emitted = np.where(seen, np.log10(np.where(seen, c - taken[k], 1.0)) - norm[k], unknown[tail])

            stream = unpack_ints(own["stream"])
            path = np.append(classes[common], k)[stream]
            value = step[path[:-1], path[1:]]
            stream = stream[1:]
            value += np.append(emit[common], emitted)[stream]
            ends = np.flatnonzero(stream == 0) + 1
            starts = np.append(0, ends[:-1])
            known = np.append(np.arange(len(common)) > 0, seen).astype(np.int64)
            base = np.append(bases[common], np.log10(c + 0.5))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").combine_chunks().flatten(),
                    pa.array(ends - starts),
                    pa.array(np.add.reduceat(known[stream], starts)),
                    pa.array(np.add.reduceat(base[stream], starts)),
                    pa.array(np.add.reduceat(value, starts)),
                ],
                names=[f.name for f in fields],
            )

    own = numbered.select("block", "stream", "common", "doc_id")
    rows = _with_found(own, found).mapInArrow(scored, T.StructType(fields))
    end = math.log10(model.train_texts + 0.5)
    return rows.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + (1 if model.train_texts else 0)).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + end - F.col("n_tokens") * model.base_norm).alias("base_score"),
        "score",
    )
