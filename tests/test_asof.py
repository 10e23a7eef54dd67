import random
from datetime import date, timedelta

import pytest

from martloom.operators.asof import join_nearest_snapshot, nearest_snapshot

BASE = date(2024, 1, 1)
SNAP = "k string, d date, u int, cost int"


def brute(probe_key, probe_day, snaps):
    mine = [s for s in snaps if s[0] == probe_key and s[0] is not None and s[1] is not None]
    if not mine or probe_day is None:
        return None
    before = [s for s in mine if s[1] <= probe_day]
    day = max(s[1] for s in before) if before else min(s[1] for s in mine)
    tied = [s for s in mine if s[1] == day]
    best = max(tied, key=lambda s: (s[2] is None, s[2] or 0, s[3] is None, s[3] or 0))
    return (best[1], best[3])


@pytest.mark.parametrize("slot", ["week", "month", "year"])
def test_equals_brute_force(spark, slot):
    pick = random.Random(7)
    keys = ["a", "b", "c", "empty", None]
    snaps = [
        (pick.choice(["a", "b", "c", None]),
         None if pick.random() < 0.05 else BASE + timedelta(days=pick.randrange(400)),
         pick.choice([None, 1, 2, 3]), pick.choice([None, 5, 6, 7]))
        for _ in range(60)
    ]
    probes = [
        (i, pick.choice(keys),
         None if pick.random() < 0.05 else BASE + timedelta(days=pick.randrange(-200, 700)))
        for i in range(500)
    ]
    facts = spark.createDataFrame(probes, "id int, k string, day date")
    costs = spark.createDataFrame(snaps, SNAP)
    got = join_nearest_snapshot(facts, costs, ["k"], "day", "d", "u", ["cost"], "snap_day", slot)
    found = {r.id: (r.snap_day, r.cost) if r.snap_day else None for r in got.collect()}
    assert len(found) == got.count() == 500
    assert found == {i: brute(k, day, snaps) for i, k, day in probes}


def test_found_snapshot_without_cost_wins(spark, rows):
    costs = spark.createDataFrame([("a", BASE, 1, 5), ("a", BASE + timedelta(days=9), 1, None)], SNAP)
    facts = spark.createDataFrame([("a", BASE + timedelta(days=20))], "k string, day date")
    assert rows(nearest_snapshot(facts, costs, ["k"], "day", "d", "u", ["cost"])) == [
        ("a", BASE + timedelta(days=20), None, BASE + timedelta(days=9))
    ]


def test_no_snapshots_at_all(spark, rows):
    facts = spark.createDataFrame([("a", BASE)], "k string, day date")
    costs = spark.createDataFrame([], SNAP)
    got = join_nearest_snapshot(facts, costs, ["k"], "day", "d", "u", ["cost"])
    assert rows(got) == [("a", BASE, None)]


def test_intervals_are_shuffled_and_not_broadcast(spark, rows):
    """However small the planner takes the snapshots for: each interval is repeated once per slot."""
    costs = spark.createDataFrame([("a", BASE, 1, 5), ("a", BASE + timedelta(days=900), 1, 6)], SNAP)
    facts = spark.createDataFrame([("a", BASE + timedelta(days=400)), ("b", BASE)], "k string, day date")
    got = join_nearest_snapshot(facts, costs, ["k"], "day", "d", "u", ["cost"])
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [("a", BASE + timedelta(days=400), 5), ("b", BASE, None)]
