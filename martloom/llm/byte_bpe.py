"""Byte-level BPE over a whole corpus: every distinct word is encoded once, decoding is a join.

1. Tasks cut texts into pre-tokens, block by block (a stretch of a task's documents). A document
   becomes the numbers of its pre-tokens, by position, in its block's own word list. Numbers and
   word lists are written to the shared folder, bucketed by block.
2. The word lists are shuffled by word. All lists that hold a word meet in one task, which encodes
   it once and sends its ids back beside each block and number.
3. They join the number streams of their block, which lie there by bucket and are not shuffled,
   and ids are put in place by position.

What moves is a block's distinct words, never the texts. A word stands in a block's list once, so
the commonest word is no hot key. Lists travel as packed rows, one for each block and word bucket.
"""

from __future__ import annotations

import base64
import functools
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martloom.llm.packed import pack_ints, pack_words, unpack_ints, unpack_words
from martloom.session import shared_dir

BLOCK_CHARS = 32_000_000  # text of a block, but for its last document
STREAM_CHARS = 2_000_000  # text of one stream of numbers, but for its last document


@functools.lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Numbers(dict):
    """Numbers words as they are met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _cut(pattern: str, buckets: int, block_chars: int, stream_chars: int, out: pa.Schema):
    """Batches of ``(row, text)`` to the blocks' word lists (kind 0, a row for each bucket of
    words) and number streams (kind 1)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findall = regex.compile(pattern).findall
        block = TaskContext.get().partitionId() << 32
        numbers, chars = _Numbers(), 0

        def words() -> Iterator[pa.RecordBatch]:
            own = [w.encode() for w in numbers]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in own), dtype=np.int64, count=len(own))
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                body, sizes = pack_words([own[i] for i in part.tolist()])
                yield _batch(
                    out, block=block, kind=0, bucket=int(bucket[part[0]]),
                    numbers=pack_ints(np.diff(part, prepend=0)), body=body, sizes=sizes,
                )

        def stream(rows: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            sizes = pack_ints(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
            listed = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            return _batch(out, block=block, kind=1, numbers=pack_ints(flat), sizes=sizes, rows=listed)

        for batch in batches:
            rows, begin, held, found = batch.column(0), 0, 0, []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found.append(np.array(list(map(numbers.__getitem__, findall(text))), dtype=np.int64))
                held, chars = held + len(text), chars + len(text)
                if held >= stream_chars or chars >= block_chars:
                    yield stream(rows.slice(begin, i + 1 - begin), found)
                    begin, held, found = i + 1, 0, []
                if chars >= block_chars:
                    yield from words()
                    numbers, chars, block = _Numbers(), 0, block + 1
            if found:
                yield stream(rows.slice(begin), found)
        if numbers:
            yield from words()

    return cut


def _batch(schema: pa.Schema, **values) -> pa.RecordBatch:
    """A batch of one row; a name left out is NULL."""
    arrays = []
    for field in schema:
        value = values.get(field.name)
        value = value if isinstance(value, pa.Array) else pa.array([value], field.type)
        arrays.append(value.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _encode_words(path: str, pattern: str):
    """Word lists, bucket by bucket, to ids; a bucket's words are remembered until the next."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        piece = coder._encode_single_piece
        now, known = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != now:
                    now, known = row["bucket"], {}
                own = []
                for word in unpack_words(row["body"], row["sizes"]):
                    if (ids := known.get(word)) is None:
                        ids = known[word] = piece(word)
                    own.append(ids)
                flat = np.array([i for ids in own for i in ids], dtype=np.int64)
                sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x]) for x in (row["block"], row["numbers"], pack_ints(flat), pack_ints(sizes))],
                    ["block", "numbers", "ids", "sizes"],
                )

    return encode


class _WordIds:
    """The ids of a block's words, by number."""

    def __init__(self, lists: list[dict]):
        number = [np.cumsum(unpack_ints(r["numbers"])) for r in lists]
        size = [unpack_ints(r["sizes"]) for r in lists]
        self.flat = np.concatenate([unpack_ints(r["ids"]).astype("<u4") for r in lists] or [np.zeros(0, "<u4")])
        number, size = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (number, size))
        self.start, self.size = np.zeros((2, len(number)), np.int64)
        self.start[number] = np.cumsum(size) - size
        self.size[number] = size

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in their order, and how many there are up to each word."""
        size = self.size[numbers]
        upto = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.start[numbers] - upto[:-1], size) + np.arange(upto[-1])
        return self.flat[at], upto


def _bounds(ids: pa.Array) -> np.ndarray:
    return np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)


def _values(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    body = ids.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[bounds[0] : bounds[-1]] if body else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), "<u4")


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array of the bytes of ``data`` cut at ``bounds``."""
    ends = pa.py_buffer(bounds.astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, ends, pa.py_buffer(data.tobytes())])


def _assemble(out: pa.Schema):
    """A block's number streams and its words' ids to documents with their ids."""

    def assemble(streams: pa.Table, lists: pa.Table) -> pa.Table:
        table = _WordIds(lists.to_pylist())
        made = []
        for batch in streams.to_batches():
            packed, sizes = batch.column("numbers").to_pylist(), batch.column("sizes").to_pylist()
            for i in range(batch.num_rows):
                flat, upto = table.ids(unpack_ints(packed[i]))
                ends = upto[np.concatenate(([0], np.cumsum(unpack_ints(sizes[i]))))]
                rows = batch.column("rows").slice(i, 1).flatten()
                made.append(
                    pa.RecordBatch.from_arrays([rows, pa.array(np.diff(ends)), _binary(flat, 4 * ends)], schema=out)
                )
        return pa.Table.from_batches(made, schema=out)

    return assemble


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    keep: Sequence[str] | None = None,
    block_chars: int = BLOCK_CHARS,
    stream_chars: int = STREAM_CHARS,
) -> DataFrame:
    """``row`` (the columns ``keep``, by default all), ``n_tokens`` and ``ids``: the text's token
    ids as little-endian unsigned 32-bit numbers.

    Each match of ``pattern`` is encoded by the ranks in ``path`` by itself, without special
    tokens. A NULL text counts as empty and has no ids; repeated rows and ids stand as they are.
    A task holds one block: its word list, numbers and ids, or one document if that is longer.
    """
    spark = docs.sparkSession
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = docs.select(F.struct(*columns).alias("row"), text.alias("text"))
    row = told.schema["row"].dataType
    cut = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("kind", T.IntegerType()),
            T.StructField("bucket", T.LongType()),
            T.StructField("numbers", T.BinaryType()),
            T.StructField("body", T.BinaryType()),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("rows", T.ArrayType(row)),
        ]
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = told.mapInArrow(_cut(pattern, 2 * partitions, block_chars, stream_chars, to_arrow_schema(cut)), cut)
    parts = _by_block(spark, parts, partitions)
    lists = parts.where("kind = 0").select("block", "bucket", "numbers", "body", "sizes")
    lists = (
        lists.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encode_words(path, pattern), "block long, numbers binary, ids binary, sizes binary")
    )
    out = T.StructType(
        [T.StructField("row", row), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    streams = parts.where("kind = 1").select("block", "numbers", "sizes", "rows")
    together = streams.groupBy("block").cogroup(lists.groupBy("block"))
    return together.applyInArrow(_assemble(to_arrow_schema(out)), out)


def _by_block(spark: SparkSession, parts: DataFrame, buckets: int) -> DataFrame:
    """``parts`` in the shared folder, bucketed by block, so that later groupings by block find
    them in place. A task has few blocks and so writes few files."""
    name = f"blocks_{uuid.uuid4().hex}"
    parts.write.bucketBy(buckets, "block").option("path", shared_dir(spark)).saveAsTable(name)
    return spark.table(name)


def decode(ids: Column, path: str) -> Column:
    """The bytes of each token id, joined from the token table (at most 2^32 rows of the rank
    file, tens of thousands in practice), in order. NULL stays NULL; an unknown id is an error."""

    @F.arrow_udf("binary")
    def join(column: pa.Array) -> pa.Array:
        table = _token_table(path)
        bounds = _bounds(column)
        found = table.take(pa.array(_values(column, bounds)))
        if found.null_count:
            raise ValueError("an id that is in no token")
        at = _bounds(found)
        ends = at[(bounds - bounds[0]) // 4] - at[0]
        body = found.buffers()[2]
        out = pa.Array.from_buffers(
            pa.binary(), len(column), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), body or pa.py_buffer(b"")]
        )
        if column.null_count:
            out = pc.if_else(column.is_valid(), out, pa.scalar(None, pa.binary()))
        return out

    return join(ids)


@functools.lru_cache(maxsize=2)
def _token_table(path: str) -> pa.Array:
    """Token bytes at the place of their id."""
    ranks = read_ranks(path)
    tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.binary())
