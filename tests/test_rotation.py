from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from slipstream.operators.rotation import FEATURES, rotation_features

SCHEMA = (
    "id long, Tail_Number string, FlightDate date, DepHour int, DepDelay double, ArrDelay double, "
    "ArrDel15 int, AirTime double"
)
DAY0 = dt.date(2023, 1, 1)


def leg(i, tail, day, hour, dep=0.0, arr=0.0, late=0, air=60.0):
    return (i, tail, DAY0 + dt.timedelta(days=day), hour, dep, arr, late, air)


def features(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = rotation_features(df, ["id"], **options)
    return {r.id: tuple(r[f] for f in FEATURES) for r in out.collect()}


def expected(rows):
    """Leg by leg, with plain loops."""
    tails = defaultdict(list)
    out = {}
    for r in rows:
        if r[1] is None:
            out[r[0]] = (0.0, 0.0, 0, 0.0, 4.0, 0, 0)
        else:
            tails[r[1]].append(r)
    for legs in tails.values():
        legs.sort(key=lambda r: (r[2], 12 if r[3] is None else r[3], r[0]))
        prev, streak, today, count, debt = None, 0, None, 0, 0.0
        for r in legs:
            i, _, day, hour, dep, arr, late, air = r
            at = (day - DAY0).days * 24 + (12 if hour is None else hour)
            if day != today:
                today, count, debt = day, 0, 0.0
            gap = None if prev is None else at - prev[2]
            idle = gap if gap is not None and 0 <= gap <= 16 else 4.0
            out[i] = (
                0.0 if prev is None or prev[0] is None else prev[0],
                min(max(0.0 if prev is None or prev[1] is None else prev[1], -30.0), 300.0),
                min(count, 10), min(max(debt, -30.0), 300.0), idle, int(idle < 1), min(streak, 10),
            )
            arrived = at + ((dep or 0.0) + (90.0 if air is None else air)) / 60
            prev = (dep, arr, arrived)
            streak = streak + 1 if late == 1 else 0
            count, debt = count + 1, debt + (dep or 0.0)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i] == pytest.approx(w), i


def test_edges_by_hand(spark):
    rows = [
        leg(1, "A", 0, 8, 10.0, 20.0, 1, 50.0),       # first leg of the tail
        leg(2, "A", 0, 9, None, None, 0, None),       # gap 0; cancelled: no delays
        leg(3, "A", 0, 9, 700.0, 400.0, 1, 60.0),     # same hour, after leg 2 by id
        leg(4, "A", 1, 0, 5.0, 5.0, 1, 30.0),         # streak crosses midnight
        leg(5, "A", 3, 0, 5.0, 5.0, 0, 30.0),         # gap above 16 hours
    ]
    got = features(spark, rows)
    assert got[1] == (0.0, 0.0, 0, 0.0, 4.0, 0, 0)
    assert got[2] == (10.0, 20.0, 1, 10.0, 0.0, 1, 1)
    assert got[3] == (0.0, 0.0, 2, 10.0, 4.0, 0, 0)   # negative gap
    assert got[4] == (700.0, 300.0, 0, 0.0, pytest.approx(15 - 760 / 60), 0, 1)
    assert got[5] == (5.0, 5.0, 0, 0.0, 4.0, 0, 2)


@pytest.mark.parametrize("minutes, idle, quick", [(60.0, 1.0, 0), (61.0, 59 / 60, 1)])
def test_quick_turn_below_one_hour(spark, minutes, idle, quick):
    got = features(spark, [leg(1, "A", 0, 8, air=minutes), leg(2, "A", 0, 10)])
    assert (got[2][4], got[2][5]) == (pytest.approx(idle), quick)


def test_gap_of_exactly_sixteen_hours_counts(spark):
    got = features(spark, [leg(1, "A", 0, 0, air=60.0), leg(2, "A", 0, 17)])
    assert got[2][4] == 16.0


def random_legs(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all legs belong to one vehicle, and it has many legs in the same hour.
        tail = "HOT" if i % 3 == 0 else rng.choice(["A", "B", "C", None])
        rows.append(leg(
            i, tail, rng.randrange(4), rng.choice([None, 3, 3, 9, 15, 22]),
            rng.choice([None, -10.0, 0.0, 40.0, 90.0]), rng.choice([None, 5.0, 200.0, 500.0]),
            int(rng.random() < 0.8), rng.choice([None, 30.0, 120.0]),
        ))
    return rows


def test_matches_loops(spark):
    rows = random_legs(400)
    same(features(spark, rows), expected(rows))


@pytest.mark.parametrize("task_rows", [3, 20, 100])
def test_cut_vehicles_give_the_same(spark, task_rows):
    rows = random_legs(400)
    same(features(spark, rows, task_rows=task_rows), expected(rows))


def test_long_streak_over_many_pieces(spark):
    rows = [leg(i, "HOT", i // 20, i % 20, late=int(i not in (0, 55))) for i in range(120)]
    same(features(spark, rows, task_rows=4), expected(rows))


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_partition_independent(spark, partitions):
    rows = random_legs(150, seed=9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    out = rotation_features(df, ["id"])
    same({r.id: tuple(r[f] for f in FEATURES) for r in out.collect()}, expected(rows))


def test_one_exchange_serves_all_windows(spark, small):
    from conftest import executed_plan_of
    from slipstream.sources import adapters as ad

    plan = executed_plan_of(rotation_features(ad.legs(spark, small), ad.LEG_TIE_BREAK))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "SinglePartition" not in plan and "Python" not in plan
