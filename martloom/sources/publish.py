"""Versioned tables: every publish writes a new version, then a one-row marker that switches to it.

Readers see the old version until the marker exists, so a table may be rebuilt from itself and a
failed job leaves it unchanged. One writer per table: a second writer of the same version number
fails when it switches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources.files import is_missing


@dataclass(frozen=True)
class Version:
    """A published version: its number and the folder that holds its files."""

    number: int
    folder: str


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str

    def _markers(self) -> list:
        """All markers, newest first: one small row per version."""
        try:
            markers = self.spark.read.schema("number bigint, folder string, unit string").parquet(
                f"{self.path}/_markers_/*"
            )
        except AnalysisException as problem:
            if is_missing(problem):
                return []
            raise
        return markers.orderBy(F.desc("number")).collect()

    def current(self) -> Version | None:
        """The published version, or None when nothing was published yet. A version that belongs
        to a unit counts once the unit is done."""
        for row in self._markers():
            if row.unit is None or _is_done(self.spark, row.unit):
                return Version(row.number, row.folder)
        return None

    def version(self) -> int | None:
        current = self.current()
        return current.number if current else None

    def exists(self) -> bool:
        return self.current() is not None

    def read(self) -> DataFrame:
        current = self.current()
        if current is None:
            raise FileNotFoundError(f"nothing published under {self.path}")
        return self.spark.read.parquet(f"{self.path}/{current.folder}")

    def write(
        self, df: DataFrame | Sequence[DataFrame], partition_by: tuple[str, ...] = (), **options: str
    ) -> Version:
        """Write the next version without switching to it. The folder is new for every attempt,
        so what a failed job left behind is never in the way. A version may come in parts with equal
        columns, written one after another."""
        number = max((row.number for row in self._markers()), default=0) + 1
        written = Version(number, f"v{number}-{uuid.uuid4().hex}")
        for part in [df] if isinstance(df, DataFrame) else df:
            writer = part.write.mode("append").options(**options)
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(f"{self.path}/{written.folder}")
        return written

    def switch(self, written: Version, unit: str | None = None) -> None:
        """Make a written version the current one, at once or when ``unit`` is done; fails if its
        number was published already."""
        marker = self.spark.range(1).select(
            F.lit(written.number).cast("bigint").alias("number"),
            F.lit(written.folder).alias("folder"),
            F.lit(unit).cast("string").alias("unit"),
        )
        marker.coalesce(1).write.mode("errorifexists").parquet(
            f"{self.path}/_markers_/{written.number}"
        )

    def publish(
        self, df: DataFrame | Sequence[DataFrame], partition_by: tuple[str, ...] = (), **options: str
    ) -> int:
        written = self.write(df, partition_by, **options)
        self.switch(written)
        return written.number


def _is_done(spark: SparkSession, unit: str) -> bool:
    try:
        return not spark.read.schema("done boolean").parquet(unit).isEmpty()
    except AnalysisException as problem:
        if is_missing(problem):
            return False
        raise


def publish_together(changes: list[tuple[VersionedTable, DataFrame]]) -> list[int]:
    """Publish several tables as one unit: all are written and marked first, and one record, below
    the first table, then makes all of them current. A failure before it changes none."""
    written = [(table, table.write(df)) for table, df in changes]
    if not written:
        return []
    first = written[0][0]
    unit = f"{first.path}/_units_/{uuid.uuid4().hex}"
    for table, version in written:
        table.switch(version, unit)
    first.spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.parquet(unit)
    return [version.number for _, version in written]
