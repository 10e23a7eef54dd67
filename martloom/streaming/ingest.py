"""Incremental file ingest: each micro-batch is a keyed replace of a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martloom.operators.change import replace_by_name
from martloom.sources.file_table import FileTable
from martloom.sources.files import is_missing
from martloom.sources.loads import load_keyed
from martloom.sources.publish import VersionedTable
from martloom.sources.tables import replace_keys_in_partitions, write_partitioned


def _run(reader, source: str, checkpoint: str, apply) -> None:
    running = (
        reader.parquet(source)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def _reader(spark: SparkSession, schema: T.StructType, files_per_batch: int | None):
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", str(files_per_batch)) if files_per_batch else reader


def ingest_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: VersionedTable,
    keys: list[str],
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Load the files that arrived since the last call and return the table's version.

    The checkpoint remembers which files were loaded. A batch that is run again after a failure
    replaces its own keys, so it changes nothing for rows with a key. A trigger takes all waiting
    files, in batches of ``files_per_batch`` if given.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            current = table.read() if table.exists() else batch.limit(0)
            table.publish(replace_by_name(current, batch, keys))

    _run(_reader(spark, schema, files_per_batch), source, checkpoint, apply)
    return table.version()


def ingest_partitioned(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    by: list[str],
    keys: list[str],
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """The same into a partitioned dataset: a batch reads and rewrites only the partitions it
    touches, for tables too large to rewrite."""

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            try:
                spark.read.schema(schema).parquet(path)
            except AnalysisException as problem:
                if not is_missing(problem):
                    raise
                write_partitioned(batch, path, by, mode="overwrite")
            else:
                replace_keys_in_partitions(spark, batch, path, by, keys)

    _run(_reader(spark, schema, files_per_batch), source, checkpoint, apply)


def ingest_once(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: FileTable,
    keys: list[str],
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int | None:
    """Load the files that arrived since the last call into a file table, each batch once.

    The version that a batch makes records its number, so a batch that is run again after a
    failure (with or without its version written) adds nothing, rows with NULL keys among them. A
    batch rewrites only the files that may hold its keys.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not table.exists():
            table.commit(add=batch, batch=(checkpoint, number))
        else:
            load_keyed(table, batch, keys, check_types=False, batch=(checkpoint, number))

    _run(_reader(spark, schema, files_per_batch), source, checkpoint, apply)
    return table.version()
