"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import tune

# Rows and bytes per Arrow batch: documents can be long, so a batch holds few of them.
BATCH_ROWS = 500
BATCH_BYTES = "8m"

# Python workers serve task after task: what a task frees goes back to the system instead of
# staying with a worker that waits.
ALLOCATOR = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(2 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
}

_HOME = str(Path(__file__).resolve().parents[2])

# Bytes of a word after lower-casing A-Z: digits, letters, everything outside ASCII.
_WORD = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ready(spark: SparkSession) -> SparkSession:
    """What the operators count on: AQE, small Arrow batches, and Python workers that look for
    this package where the driver has it (a cluster without it there needs ``--py-files``)."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    environment = spark.sparkContext.environment
    for name, value in ALLOCATOR.items():
        environment.setdefault(name, value)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_HOME, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_WORD).split() if text else []


_kept: dict[tuple, Any] = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """A large helper that a worker process keeps from task to task. Workers serve one operator
    after another, so one that is asked for takes the place of the one before."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Free what ``kept`` holds, and Arrow's unused memory."""
    _kept.clear()
    pa.default_memory_pool().release_unused()


def utf8(column: str) -> Column:
    """A text column as its UTF-8 bytes."""
    return F.col(f"`{column}`").cast("string").cast("binary")


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))) % folds


def beside(df: DataFrame, **results: Column) -> DataFrame:
    """``row``, all columns of ``df`` in a struct, beside the named results: no name can clash."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in results.items()])


def spread_tiles(members: DataFrame, key: list[str], size: str, member: str, side: int) -> DataFrame:
    """Send the members of each group to square tiles, so that every pair of members meets in
    exactly one tile and no tile holds more than about ``2 * side`` of them.

    ``size`` is the group's number of members. Adds ``chunk``, ``tile_a`` and ``tile_b``
    (``tile_a <= tile_b``); where they differ, only pairs across the two chunks count.
    """
    chunks = F.ceil(F.col(size) / F.lit(side)).cast("int")
    with_chunk = members.withColumn("_chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64(member, F.lit(17)), F.col("_chunks")).cast("int")
    )
    other = with_chunk.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return (
        other.withColumn("tile_a", F.least("chunk", "_other"))
        .withColumn("tile_b", F.greatest("chunk", "_other"))
        .drop("_other", "_chunks")
    )


def in_runs(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows with equal keys together and in a row, for ``runs``: many small groups to a task,
    without a call per group."""
    return df.repartition(*key).sortWithinPartitions(*key)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of a sorted stream whose first ``keys`` columns are the key. Holds one batch
    and the group that is still open."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        values = list(zip(*columns))
        table = pa.Table.from_batches([batch])
        start = 0
        for i in range(1, len(values) + 1):
            if i < len(values) and values[i] == values[start]:
                continue
            if held and values[start] != last:
                yield pa.concat_tables(held)
                held = []
            last = values[start]
            held.append(table.slice(start, i - start))
            start = i
    if held:
        yield pa.concat_tables(held)
