from datetime import datetime

import pytest

from martloom.operators.ledger import run_metrics
from martloom.sources.run_log import RunLog


def test_runs_and_steps_fold_to_their_last_state(spark, folder):
    log = RunLog(spark, f"{folder}/log")
    run = log.start_run("sales", "c1", "orders", {"day": 1}, at=datetime(2024, 1, 1))
    with log.step(run, "extract") as outcome:
        outcome["record_count"] = 7
    with pytest.raises(ZeroDivisionError):
        with log.step(run, "load"):
            1 / 0
    log.complete(run, "failed", error="load broke", at=datetime(2024, 1, 1, 0, 5))
    state = log.runs().first()
    assert (state.status, state.error, state.start_time) == ("failed", "load broke", datetime(2024, 1, 1))
    assert state.end_time == datetime(2024, 1, 1, 0, 5)
    assert (state.pipeline_name, state.client_id, state.parameters) == ("sales", "c1", '{"day": 1}')
    metrics = run_metrics(log.runs(), datetime(2024, 1, 2)).first()
    assert (metrics.failure_count, metrics.avg_duration_seconds) == (1, 300.0)
    steps = {r.step_name: (r.status, r.record_count, r.error) for r in log.steps().collect()}
    assert steps == {"extract": ("success", 7, None), "load": ("failed", None, "division by zero")}


def test_only_one_process_may_do_without_a_shared_folder():
    from martloom.session import is_local

    assert is_local("local") and is_local("local[8]")
    assert not any(map(is_local, ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h")))


def test_folded_events_read_like_the_events(spark, folder):
    log = RunLog(spark, f"{folder}/log")
    assert log.fold() == 0 and log.events().count() == 0
    for i in range(5):
        run = log.start_run("sales", "c1", "orders", at=datetime(2024, 1, 1, i))
        log.complete(run, "success", record_count=i, at=datetime(2024, 1, 1, i, 9))
    want = sorted(map(tuple, log.runs().collect()), key=str)
    assert log.fold() == 10 and log.fold() == 0
    assert len(log._files()) == 0 and sorted(map(tuple, log.runs().collect()), key=str) == want
    log.complete(run, "failed", error="late", at=datetime(2024, 1, 2))
    assert log.runs().where("status = 'failed'").count() == 1 and log.events().count() == 11
    assert log.fold() == 1 and log.events().count() == 11
    assert len(log.events().inputFiles()) == 1


def test_a_fold_that_broke_off_counts_no_event_twice(spark, folder, monkeypatch):
    """The record is written, the folded files are still there."""
    log = RunLog(spark, f"{folder}/log")
    for i in range(3):
        log.start_run("sales", "c1", "orders", at=datetime(2024, 1, 1, i))
    monkeypatch.setattr("martloom.sources.run_log.remove_folder", lambda *a: None)
    assert log.fold() == 3
    assert len(log._files()) == 3 and log.events().count() == 3 and log.fold() == 0
    log.start_run("sales", "c1", "orders", at=datetime(2024, 1, 2))
    assert log.events().count() == 4 and log.fold() == 1 and log.events().count() == 4
