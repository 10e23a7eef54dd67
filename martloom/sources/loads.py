"""Loads into file tables: keyed and group replace, partition replace and merge, many files at once.

Each load looks up the files that may hold what it changes, rewrites those and keeps the others;
one record of the table's log makes all of it current.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import change
from martloom.operators.dedup import merge_keep_last
from martloom.operators.skew import all_not_null, in_groups, lookup_join
from martloom.operators.validate import compatible
from martloom.session import settle
from martloom.sources.file_table import FileTable

FOOTERS = 16  # files whose layout is looked at at the same time


def load_keyed(
    table: FileTable,
    staging: DataFrame,
    keys: str | Sequence[str],
    business_keys: str | Sequence[str] | None = None,
    match: str = "name",
    check_types: bool = True,
    batch: tuple[str, int] | None = None,
) -> dict[str, Any]:
    """Validate, group-replace, keyed-replace and publish staging into a file table.

    ``keys`` and ``business_keys`` must be indexes of the table. Empty staging succeeds without a
    change. A ``batch`` (stream, number) that the table already has is not loaded again. The
    result says what happened, with the counts and how many files were rewritten.
    """
    if batch is not None and table.has_batch(*batch):
        return {"success": True, "message": f"batch {batch[1]} is loaded already", "counts": None, "rewritten": 0}
    keys = [keys] if isinstance(keys, str) else list(keys)
    groups = [business_keys] if isinstance(business_keys, str) else list(business_keys or [])
    now = table.snapshot()
    empty = table.spark.createDataFrame([], now.schema)
    if check_types and (problems := compatible(staging.schema, now.schema)):
        return {"success": False, "message": "; ".join(problems), "counts": None, "rewritten": 0}
    typed = change.by_name(staging, empty, keys) if match == "name" else change.by_position(staging, empty)
    rows = settle(typed)
    if rows.isEmpty():
        return {"success": True, "message": "no rows to load", "counts": None, "rewritten": 0}
    hit = set(table.files_with(rows, keys, now=now))
    if groups:
        hit |= set(table.files_with(rows, groups, now=now))
    touched = table.read(sorted(hit), now)
    base = change.delete_groups(touched, rows, groups) if groups else touched
    counts = change.change_counts(base, rows, keys).first().asDict()
    loaded = change.replace_by_name(base, rows, keys)
    version = table.commit(add=loaded, remove=sorted(hit), batch=batch, after=now)
    return {"success": True, "message": f"published version {version}", "counts": counts, "rewritten": len(hit)}


def replace_in_table(table: FileTable, df: DataFrame, by: Sequence[str]) -> int:
    """Replace the partitions (values of the index ``by``, NULL among them) that ``df`` touches.
    Rows of other partitions that share a file with them are written again."""
    now = table.snapshot()
    rows = settle(df)
    hit = table.files_with(rows, by, null_safe=True, now=now)
    others = in_groups(table.read(hit, now), rows, by, inside=False)
    return table.commit(add=others.unionByName(rows), remove=hit, after=now)


def merge_in_table(
    table: FileTable, incoming: DataFrame, by: Sequence[str], keys: Sequence[str], seq: Sequence[str]
) -> int:
    """Merge rows into the partitions they touch, last row per key (``seq``) kept; readers see all
    touched partitions change at once."""
    now = table.snapshot()
    rows = settle(incoming)
    hit = table.files_with(rows, by, null_safe=True, now=now)
    touched = table.read(hit, now)
    others = in_groups(touched, rows, by, inside=False)
    merged = merge_keep_last(touched, rows, keys, seq, partition_by=by)
    return table.commit(add=others.unionByName(merged.select(*others.columns)), remove=hit, after=now)


def load_many_files(
    table: FileTable,
    paths: Sequence[str],
    keys: str | Sequence[str],
    business_keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Load files as if one after the other, with one rewrite of the table; a row per file.

    A file that is missing, or whose layout does not fit, is recorded and does not stop the rest.
    Only layouts are looked at file by file, several at a time; the good files are read together.
    A row stays unless a later file holds its key or its business key: then that file's load would
    have replaced it.
    """
    spark: SparkSession = table.spark
    keys = [keys] if isinstance(keys, str) else list(keys)
    groups = [business_keys] if isinstance(business_keys, str) else list(business_keys or [])
    now = table.snapshot()
    empty = spark.createDataFrame([], now.schema)

    def look(path: str):
        try:
            df = spark.read.parquet(path)
            problems = compatible(df.schema, now.schema)
            return (None, "; ".join(problems)) if problems else (change.by_name(df, empty, keys), None)
        except (AnalysisException, ValueError) as problem:
            return None, str(problem).splitlines()[0]

    with ThreadPoolExecutor(FOOTERS) as pool:
        looked = list(pool.map(look, paths))
    good = [(i, df) for i, (df, _) in enumerate(looked) if df is not None]
    outcome = spark.createDataFrame(
        [(i, p, error is None, error) for i, (p, (_, error)) in enumerate(zip(paths, looked))],
        "nr int, path string, ok boolean, error string",
    )
    if not good:
        return outcome.select("path", "ok", F.lit(0).cast("bigint").alias("inserted"), "error")
    drops = settle(reduce(DataFrame.unionByName, [df.withColumn("_nr", F.lit(i)) for i, df in good]))
    inserted = drops.groupBy(F.col("_nr").alias("nr")).agg(F.count(F.lit(1)).alias("n"))
    staged = drops
    for columns in [keys, groups] if groups else [keys]:
        # A group's rows are combined before the shuffle, so a hot key costs one row per task.
        last = drops.where(all_not_null(columns)).groupBy(*columns).agg(F.max("_nr").alias("_last"))
        staged = lookup_join(staged, last, columns).where("_last IS NULL OR _last = _nr").drop("_last")
    load_keyed(table, staged.drop("_nr"), keys, groups or None, check_types=False)
    told = outcome.join(inserted, "nr", "left")
    return told.select("path", "ok", F.coalesce("n", F.lit(0).cast("bigint")).alias("inserted"), "error")
