"""Sinks and table maintenance: file writes, catalog tables, sizes, compaction, loads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators import change
from martloom.operators.dedup import merge_keep_last
from martloom.operators.increments import day_outcomes
from martloom.operators.skew import with_keys
from martloom.operators.validate import compatible
from martloom.session import settle
from martloom.sources.files import list_files, remove_folder
from martloom.sources.publish import VersionedTable

# The accepted if-exists choices and the writer mode behind each.
IF_EXISTS = {
    "fail": "errorifexists", "error": "errorifexists", "replace": "overwrite", "append": "append",
}


def write_parquet(
    df: DataFrame, path: str, codec: str = "snappy", overwrite: bool = False
) -> None:
    mode = "overwrite" if overwrite else "append"
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "append", codec: str = "snappy"
) -> None:
    """Hive-partitioned write; rows with a NULL partition value are kept.

    The rebalance hint brings a partition value's rows together to avoid small files, and lets
    AQE split a value that is too large for one task.
    """
    unknown = [c for c in by if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown partition columns {unknown}")
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("compression", codec)
        .partitionBy(*by)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` touches."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def touched_range(rows: DataFrame, by: Sequence[str]) -> Column:
    """A predicate on the partition columns that covers the partitions of ``rows``, for pruning a
    read of them: the smallest and largest value of each column, one row on the driver however
    many partitions there are. The caller's exact join decides inside that range."""
    row = rows.agg(
        *[F.min(c).alias(f"low_{i}") for i, c in enumerate(by)],
        *[F.max(c).alias(f"high_{i}") for i, c in enumerate(by)],
        *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(f"null_{i}") for i, c in enumerate(by)],
    ).first()
    covered = F.lit(True)
    for i, c in enumerate(by):
        inside = F.lit(False)
        if row[f"low_{i}"] is not None:
            inside = F.col(c).between(F.lit(row[f"low_{i}"]), F.lit(row[f"high_{i}"]))
        covered &= inside | F.col(c).isNull() if row[f"null_{i}"] else inside
    return covered


def _in_partitions(rows: DataFrame, partitions: DataFrame, by: Sequence[str]) -> DataFrame:
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in by]
    return rows.alias("r").join(partitions.alias("p"), same, "left_semi")


def merge_partitions(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    by: Sequence[str],
    keys: Sequence[str],
    seq: Sequence[str],
) -> None:
    """Merge rows into a partitioned dataset, last row per key, touched partitions only.

    The merged rows settle in the shared folder before they replace the files they came from.
    """
    existing = spark.read.schema(incoming.schema).parquet(path).where(touched_range(incoming, by))
    merged = merge_keep_last(existing, incoming, keys, seq, partition_by=by)
    replace_partitions(settle(merged), path, by)


def replace_keys_in_partitions(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    by: Sequence[str],
    keys: Sequence[str],
    keys_stay: bool = False,
) -> None:
    """Keyed replace inside a partitioned dataset: only touched partitions are read and rewritten.

    A key may come in for another partition than the one that holds it; both are then rewritten,
    and a partition left without rows is removed. Finding such keys reads the key columns of the
    whole dataset. ``keys_stay`` promises that no key moves (a day, a store) and saves that read.
    """
    dataset = spark.read.schema(incoming.schema).parquet(path)
    partitions = incoming.select(*by).distinct()
    if not keys_stay:
        held = with_keys(dataset.select(*dict.fromkeys([*by, *keys])), incoming, keys)
        partitions = settle(partitions.union(held.select(*by)).distinct())
    files = dataset.withColumn("_file", F.col("_metadata.file_path"))
    inside = _in_partitions(files.where(touched_range(partitions, by)), partitions, by)
    changed = settle(change.replace_by_name(inside.drop("_file"), incoming, keys))
    folder = F.regexp_replace("_file", "/[^/]*$", "").alias("folder")
    before, after = inside.select(*by, folder).distinct(), changed.select(*by).distinct()
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in by]
    emptied = before.alias("b").join(after.alias("a"), same, "left_anti").select("folder").distinct()
    emptied = [r.folder for r in emptied.toLocalIterator()]  # some of the partitions of this load
    replace_partitions(changed, path, by)
    for name in emptied:
        remove_folder(spark, name)


def insert_into(df: DataFrame, table: str, if_exists: str = "append") -> None:
    """Insert into a catalog table: fail, error, replace or append."""
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {sorted(IF_EXISTS)}")
    df.write.mode(IF_EXISTS[if_exists]).format("parquet").saveAsTable(table)


def export(
    spark: SparkSession,
    query_or_df: str | DataFrame,
    location: str,
    fmt: str = "parquet",
    codec: str | None = None,
    options: Mapping[str, Any] | None = None,
) -> None:
    """Write a query, table or DataFrame as parquet, csv or json."""
    if isinstance(query_or_df, DataFrame):
        df = query_or_df
    elif query_or_df.lstrip().lower().startswith(("select", "with")):
        df = spark.sql(query_or_df)
    else:
        df = spark.table(query_or_df)
    writer = df.write.mode("overwrite").format(fmt).options(**dict(options or {}))
    (writer.option("compression", codec) if codec else writer).save(location)


def import_files(
    spark: SparkSession,
    location: str,
    table: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
    if_exists: str = "append",
) -> None:
    """Load files into a catalog table."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    insert_into((reader.schema(schema) if schema else reader).load(location), table, if_exists)


def create_like(spark: SparkSession, source: str, name: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} LIKE {source} USING parquet")


def create_from(df: DataFrame, name: str) -> None:
    """An empty catalog table with the layout of ``df``."""
    df.limit(0).write.mode("ignore").format("parquet").saveAsTable(name)


def compact(spark: SparkSession, table: VersionedTable, files: int, by: Sequence[str] = ()) -> int:
    """Publish the same rows in ``files`` files."""
    return table.publish(table.read().repartition(files, *by))


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    tail = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{tail}")


def table_size(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows (from Parquet footers), bytes and files of a Parquet dataset."""
    zero = F.lit(0).cast("bigint")
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    files = list_files(spark, path, ".parquet").agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    return (
        rows.select("rows", zero.alias("bytes"), zero.alias("files"))
        .unionByName(files.select(zero.alias("rows"), "bytes", "files"))
        .agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.sum("files").alias("files"))
    )


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """Lower-cased column names and types of a catalog table in ordinal order."""
    fields = spark.table(table).schema.fields
    rows = [(i + 1, f.name.lower(), f.dataType.simpleString()) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def load_table(
    table: VersionedTable,
    staging: DataFrame,
    keys: str | Sequence[str],
    business_keys: str | Sequence[str] | None = None,
    match: str = "name",
    check_types: bool = True,
    include_counts: bool = True,
    **options: str,
) -> dict[str, Any]:
    """Validate, group-replace, keyed-replace and publish staging into a versioned table, written
    with the writer's ``options``.

    One publish at the end, so readers see all of the change or none. Empty staging succeeds
    without a change; the result says what happened.
    """
    if staging.isEmpty():
        return {"success": True, "message": "no rows to load", "counts": None}
    target = table.read()
    if check_types:
        problems = compatible(staging.schema, target.schema)
        if problems:
            return {"success": False, "message": "; ".join(problems), "counts": None}
    counts = None
    if include_counts:
        base = change.delete_groups(target, staging, business_keys) if business_keys else target
        counts = change.change_counts(base, staging, keys).first().asDict()
    version = table.publish(change.load(target, staging, keys, business_keys, match), **options)
    return {"success": True, "message": f"published version {version}", "counts": counts}


def load_many(
    spark: SparkSession,
    table: VersionedTable,
    paths: Iterable[str],
    keys: str | Sequence[str],
    business_keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Load files one by one; a bad file is recorded and does not stop the rest.

    The loop is over file names (each load is a distributed job); the result has a row per file.
    """
    outcome = []
    for path in paths:
        try:
            done = load_table(table, spark.read.parquet(path), keys, business_keys)
            counts = done["counts"] or {}
            error = None if done["success"] else done["message"]
            outcome.append((path, done["success"], counts.get("inserted_count", 0), error))
        except Exception as problem:  # noqa: BLE001 - recorded per file
            outcome.append((path, False, 0, str(problem).splitlines()[0]))
    return spark.createDataFrame(outcome, "path string, ok boolean, inserted bigint, error string")


def load_days(
    table: VersionedTable,
    staging: DataFrame,
    day: Column,
    keys: Sequence[str],
    checks: Mapping[str, Column],
) -> DataFrame:
    """Load the good days of a drop and leave the others out; one row per day says which.

    All days are judged in one pass and the good ones published together, so the cost does not
    grow with their number. A drop that cannot be read fails as a whole.
    """
    outcomes = settle(day_outcomes(staging, day, checks))
    good = outcomes.where("ok").select(F.col("day").alias("_good"))
    rows = staging.withColumn("_day", day).join(good, F.col("_day") == F.col("_good"), "left_semi")
    if not good.isEmpty():
        table.publish(change.replace_by_name(table.read(), rows.drop("_day"), keys))
    return outcomes


def load_totals(outcome: DataFrame) -> DataFrame:
    """Files loaded, files failed and rows inserted of a ``load_many`` result."""
    return outcome.agg(
        F.count_if("ok").alias("loaded_files"),
        F.count_if(~F.col("ok")).alias("failed_files"),
        F.sum("inserted").alias("inserted_rows"),
    )
