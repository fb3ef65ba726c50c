"""Repeated draws of the what-if scenarios, run by run."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.operators import whatif
from slipstream.registry import all_queries

SCHEMA = (
    "scenario_id long, route string, additional_daily_flights int, schedule_change string, "
    "simulation_runs int"
)


def prepared(spark, *rows):
    return whatif.prepare_scenarios(spark.createDataFrame(list(rows), SCHEMA))


def keyed_normals(*key):
    digits = hashlib.md5(":".join(map(str, key)).encode()).hexdigest()
    u1, u2 = ((int(digits[at:at + 13], 16) + 0.5) / 2**52 for at in (0, 16))
    r = math.sqrt(-2 * math.log(u1))
    return r * math.cos(2 * math.pi * u2), r * math.sin(2 * math.pi * u2)


def by_hand(scenario, route, k, strategy, runs, seed=42):
    _, distance, otp, lf, flights, _ = next(r for r in fv.ROUTES if r[0] == route)
    rank = [s[0] for s in fv.STRATEGIES].index(strategy)
    _, capture, multiplier, _ = fv.STRATEGIES[rank]
    freq = (flights + k) / flights
    mean = min(max(lf * (1 + 0.30 * (freq - 1)) / freq * capture, 0.20), 0.97)
    out = []
    for run in range(runs):
        z = [v for pair in (0, 1) for v in keyed_normals(seed, scenario, rank, run, pair)]
        demand, price, cost = 1 + 0.05 * z[0], 1 + 0.04 * z[1], 1 + 0.03 * z[2]
        new = min(max(mean * demand, 0.2), 0.98)
        old = min(max((lf - 0.005 * abs(k)) * demand, 0.2), 0.98)
        mixed = min(max((flights * old + k * new) / (flights + k), 0.2), 0.98)
        punctual = min(max(otp - k * 0.003 - (multiplier - 1) * 0.025 + 0.012 * z[3], 0.4), 0.99)
        miles = 178 * distance * 365
        revenue = k * miles * (0.1025 * new * price - 0.092 * cost) + flights * miles * 0.1025 * (old - lf) * price
        out.append((mixed, punctual, revenue))
    return np.array(out)


@pytest.mark.parametrize("k, strategy", [(1, "all_day"), (-1, "off_peak"), (3, "peak_only")])
def test_every_run_by_hand(spark, k, strategy):
    base = prepared(spark, (7, "FLL-ATL", k, strategy, 40))
    rows = whatif.simulate(base).orderBy("run").collect()
    got = np.array([(r.lf, r.otp, r.revenue) for r in rows])
    assert got == pytest.approx(by_hand(7, "FLL-ATL", k, strategy, 40))
    (s,) = whatif.summarise(whatif.simulate(base), max_runs=40).collect()
    assert s.p10_lf == pytest.approx(np.percentile(got[:, 0], 10))
    assert s.p90_revenue == pytest.approx(np.percentile(got[:, 2], 90))
    (slow,) = whatif.summarise(whatif.simulate(base), task_rows=7).collect()
    assert (slow.p10_lf, slow.p90_lf, slow.p10_revenue, slow.p90_revenue) == pytest.approx(
        (s.p10_lf, s.p90_lf, s.p10_revenue, s.p90_revenue))


def test_runs_do_not_depend_on_partitions_and_blocks(spark, monkeypatch):
    base = prepared(spark, (1, "FLL-ATL", 1, "all_day", 25), (2, "FLL-ATL", 1, "off_peak", 10))
    want = sorted(tuple(r) for r in whatif.simulate(base).collect())
    assert len(want) == 35
    monkeypatch.setattr(whatif, "BLOCK", 10)
    assert sorted(tuple(r) for r in whatif.simulate(base.repartition(17)).collect()) == want


def test_draws_are_standard_normal(spark):
    a, b = whatif.normal_pair(1, 0, "scenario", "strategy", "id")
    ids = spark.range(200_000).selectExpr("id", "id % 9 as scenario", "int(id % 3) as strategy")
    r = ids.select(a.alias("a"), b.alias("b")).agg(
        F.avg("a"), F.stddev("a"), F.avg("b"), F.stddev("b"), F.corr("a", "b")).first()
    assert (r[0], r[2], r[4]) == pytest.approx((0, 0, 0), abs=0.01)
    assert (r[1], r[3]) == pytest.approx((1, 1), abs=0.01)


def test_entries_draw_every_run_of_every_scenario(spark, small):
    bins = all_queries()[0]["x2_a17_outcome_histogram"](spark, small).groupBy(*whatif.KEY).agg(F.sum("n").alias("n")).collect()
    found = {(r.scenario_id, r.schedule_change) for r in bins}
    assert found and all(r.n == fv.DEFAULT_RUNS for r in bins)
    rows = all_queries()[0]["x3_a12_outcome_summary"](spark, small).collect()
    assert {(r.scenario_id, r.schedule_change) for r in rows} == found
    # Shares of whole runs.
    assert all(round(r.p_revenue_positive * fv.DEFAULT_RUNS, 6).is_integer() for r in rows)
