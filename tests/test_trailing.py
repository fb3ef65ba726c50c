from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slipstream.operators.trailing import trailing_mean_at, trailing_mean_delay

SCHEMA = "id long, Origin string, FlightDate date, DepHour int, DepDelay double"
DAY0 = dt.date(2023, 1, 1)


def rows_at_random(n=250, seed=3):
    rng = random.Random(seed)
    return [
        (
            i, rng.choice("HK"), DAY0 + dt.timedelta(days=rng.randrange(2)),
            # A third of all flights leave in one hour; hour 0 of day 1 follows hour 23 of day 0.
            rng.choice([7, 7, 7, 8, 10, 22, 23, 0]), rng.choice([None, None, 0.0, 12.0, 55.0]),
        )
        for i in range(n)
    ]


def expected(rows, mode, origin=None):
    out = {}
    for r in rows:
        at = (r[2] - DAY0).days * 24 + r[3]
        seen = []
        for q in rows:
            q_at = (q[2] - DAY0).days * 24 + q[3]
            inside = q_at == at - 1 or (q_at == at and (
                mode == "peers" or (mode == "running" and q[0] <= r[0])))
            if inside and q[4] is not None and (origin is None or q[1] == origin):
                seen.append(q[4])
        out[r[0]] = sum(seen) / len(seen) if seen else 0.0
    return out


def run(spark, rows, mode, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = trailing_mean_delay(df, mode, ["id"], **options)
    return {r.id: r.rolling_avg_dep_delay for r in out.collect()}


@pytest.mark.parametrize("mode", ["peers", "running", "strict"])
def test_matches_loops(spark, mode):
    rows = rows_at_random()
    assert run(spark, rows, mode) == pytest.approx(expected(rows, mode))


@pytest.mark.parametrize("task_rows", [2, 11, 60])
def test_cut_hours_give_the_same(spark, task_rows):
    rows = rows_at_random()
    got = run(spark, rows, "running", task_rows=task_rows)
    assert got == pytest.approx(expected(rows, "running"))


def test_only_counted_flights_enter_the_mean(spark):
    rows = rows_at_random()
    got = run(spark, rows, "peers", counted=F.col("Origin") == "H")
    assert got == pytest.approx(expected(rows, "peers", "H"))


def test_hour_of_nulls_and_empty_hour_give_zero(spark):
    rows = [(1, "H", DAY0, 5, None), (2, "H", DAY0, 9, 30.0)]
    assert run(spark, rows, "peers") == {1: 0.0, 2: 30.0}
    assert run(spark, rows, "strict") == {1: 0.0, 2: 0.0}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        run(spark, rows_at_random(3), "nearest")


def test_flights_are_not_shuffled(spark, small):
    from conftest import executed_plan_of
    from slipstream.sources import adapters as ad

    plan = executed_plan_of(trailing_mean_delay(ad.legs(spark, small), "peers"))
    assert "Exchange" not in plan.replace("BroadcastExchange", "")
    assert "Window" not in plan and "BroadcastHashJoin" in plan


TIMED = "id long, k string, at timestamp_ntz, DepDelay double, _trail_n long"
SPAN = dt.timedelta(minutes=20)


def timed_rows(n=160, seed=11):
    rng = random.Random(seed)
    start = dt.datetime(2023, 12, 31, 23, 30)
    return [
        (
            # Repeated rows, null times and keys, and times one microsecond beside the window's edge.
            i // 2 if i < 20 else i, rng.choice(["hot", "hot", "b", None]),
            None if rng.random() < 0.05 else start + dt.timedelta(
                minutes=rng.randrange(0, 120, 5), microseconds=rng.randrange(-1, 2)),
            rng.choice([None, 0.1, 0.2, 1e9, -3.25, float("nan"), float("inf")]), -i,
        )
        for i in range(n)
    ]


def timed_means(rows, mode, keyed):
    out = []
    for r in rows:
        seen = [
            q[3] for q in rows
            if r[2] is not None and q[2] is not None and r[2] - SPAN < q[2] <= r[2]
            and (mode == "peers" or q[2] < r[2]) and (not keyed or q[1] == r[1])
            and q[3] is not None and abs(q[3]) < 1e12
        ]
        exact = sum(round(v * 1_000_000) for v in seen)
        out.append((r[0], r[4], exact / 1_000_000 / len(seen) if seen else 0.0))
    return sorted(out)


@pytest.mark.parametrize("task_rows", [3, 40, 10_000])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("mode", ["peers", "strict"])
def test_any_time_matches_loops(spark, mode, keyed, task_rows):
    rows = timed_rows()
    out = trailing_mean_at(
        spark.createDataFrame(rows, TIMED).repartition(5), "at", SPAN, ["k"] if keyed else [], mode,
        task_rows=task_rows,
    )
    assert out.columns == ["id", "k", "at", "DepDelay", "_trail_n", "rolling_avg_dep_delay"]
    got = sorted((r.id, r["_trail_n"], r.rolling_avg_dep_delay) for r in out.collect())
    want = timed_means(rows, mode, keyed)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-12)


def test_any_time_of_counted_rows_and_empty_table(spark):
    rows = [(1, "a", dt.datetime(2024, 1, 1, 5), 10.0, 0), (2, "b", dt.datetime(2024, 1, 1, 5, 1), 30.0, 0)]
    frame = spark.createDataFrame(rows, TIMED)
    out = trailing_mean_at(frame, "at", SPAN, counted=F.col("k") == "a", output="m")
    assert {r.id: r.m for r in out.collect()} == {1: 10.0, 2: 10.0}
    assert trailing_mean_at(frame.limit(0), "at").count() == 0
    with pytest.raises(ValueError):
        trailing_mean_at(frame, "at", mode="running")
