"""Run ledger on shared storage: every start, completion or update is one appended event row."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.ledger import run_state
from martloom.sources.files import is_missing, remove_folder

EVENTS = (
    "run_id string, step_name string, event_time timestamp_ntz, event_seq bigint, status string, "
    "record_count bigint, error string, pipeline_name string, client_id string, data_type string, "
    "parameters string, output_location string"
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class RunLog:
    """Writer and reader of the ledger below ``path``."""

    spark: SparkSession
    path: str

    def _append(self, run_id: str, status: str, at: datetime | None, **fields: Any) -> None:
        at = at or _now()
        values = {
            "run_id": run_id, "status": status, "event_time": at,
            "event_seq": int(at.replace(tzinfo=timezone.utc).timestamp() * 1000000), **fields,
        }
        names = [part.split()[0] for part in EVENTS.split(", ")]
        row = [tuple(values.get(n) for n in names)]
        self.spark.createDataFrame(row, EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def start_run(
        self, pipeline_name: str, client_id: str, data_type: str,
        parameters: Mapping[str, Any] | None = None, at: datetime | None = None,
    ) -> str:
        run_id = str(uuid.uuid4())
        self._append(
            run_id, "running", at, pipeline_name=pipeline_name, client_id=client_id,
            data_type=data_type, parameters=json.dumps(parameters) if parameters else None,
        )
        return run_id

    def start_step(self, run_id: str, step_name: str, at: datetime | None = None) -> None:
        self._append(run_id, "running", at, step_name=step_name)

    def complete(
        self, run_id: str, status: str = "success", step_name: str | None = None,
        record_count: int | None = None, error: str | None = None,
        output_location: str | None = None, at: datetime | None = None,
    ) -> None:
        """Complete or update a run, or one of its steps."""
        self._append(
            run_id, status, at, step_name=step_name, record_count=record_count, error=error,
            output_location=output_location,
        )

    @contextmanager
    def step(self, run_id: str, step_name: str) -> Iterator[dict[str, Any]]:
        """Track a step: its outcome is recorded, an error is recorded and raised again."""
        outcome: dict[str, Any] = {}
        self.start_step(run_id, step_name)
        try:
            yield outcome
        except Exception as problem:
            self.complete(run_id, "failed", step_name, error=str(problem).splitlines()[0])
            raise
        self.complete(run_id, "success", step_name, **outcome)

    def events(self) -> DataFrame:
        """All events: those of the last fold, and the files that came after it."""
        folder, folded = self._folded()
        fresh = [f for f in self._files() if f not in folded]
        parts = ([f"{self.path}/{folder}"] if folder else []) + fresh
        if not parts:
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).parquet(*parts)

    def fold(self) -> int:
        """Write all events so far as a few files, so that reading does not open one file for each
        event. A record that names the folded files then stands for them; events that come
        meanwhile are not among them and stay. Returns how many files were folded.

        Folds are numbered, and a number's record is written once: of two folds at a time the
        later one fails and changes nothing. The folded files are removed after the record.
        """
        folder, before = self._folded()
        files = self._files()
        fresh = [f for f in files if f not in before]
        if not fresh:
            return 0
        number = int(folder.rsplit("/", 1)[1].split("-")[0]) + 1 if folder else 1
        target = f"_folds_/{number:010d}-{uuid.uuid4().hex}"
        self.events().sort("run_id", "event_seq").coalesce(1 + len(fresh) // 100_000).write.parquet(f"{self.path}/{target}")
        record = self.spark.createDataFrame([(target, f) for f in files], "folder string, file string")
        record.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/_folded_/{number:010d}")
        for file in files:
            remove_folder(self.spark, file)
        return len(fresh)

    def _files(self) -> list[str]:
        """The files of events that were appended."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
        try:
            return sorted(r["path"] for r in listed.load(self.path).select("path").toLocalIterator())
        except AnalysisException as problem:
            if is_missing(problem):
                return []
            raise

    def _folded(self) -> tuple[str | None, set[str]]:
        """The folder of the last fold and the files it stands for."""
        try:
            records = self.spark.read.schema("folder string, file string").parquet(f"{self.path}/_folded_/*")
            last = records.agg(F.max("folder")).first()[0]
        except AnalysisException as problem:
            if is_missing(problem):
                return None, set()
            raise
        return last, {r["file"] for r in records.where(F.col("folder") == last).toLocalIterator()}

    def runs(self) -> DataFrame:
        """Current state of every run."""
        return run_state(self.events().where("step_name is null").drop("step_name"))

    def steps(self) -> DataFrame:
        """Current state of every step."""
        return run_state(self.events().where("step_name is not null"), ["run_id", "step_name"])
