from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.operators import whatif

SCHEMA = (
    "scenario_id long, route string, additional_daily_flights int, schedule_change string, "
    "simulation_runs int"
)


def prepared(spark, *rows):
    return whatif.prepare_scenarios(spark.createDataFrame(list(rows), SCHEMA))


def by_hand(route, k, strategy, runs=400_000, seed=5):
    """The same quantities from many independent draws, with the limits inside each draw."""
    _, distance, otp, lf, flights, _ = next(r for r in fv.ROUTES if r[0] == route)
    _, capture, multiplier, _ = next(s for s in fv.STRATEGIES if s[0] == strategy)
    draw = np.random.default_rng(seed)
    freq = (flights + k) / flights
    mean = min(max(lf * (1 + 0.30 * (freq - 1)) / freq * capture, 0.20), 0.97)
    demand, price, cost = (1 + s * draw.standard_normal(runs) for s in (0.05, 0.04, 0.03))
    new = np.clip(mean * demand, 0.2, 0.98)
    old = np.clip((lf - 0.005 * abs(k)) * demand, 0.2, 0.98)
    miles = 178 * distance * 365
    revenue = (
        k * miles * (0.1025 * new * price - 0.092 * cost) + flights * miles * 0.1025 * (old - lf) * price
    )
    mixed = np.clip((flights * old + k * new) / (flights + k), 0.2, 0.98)
    return mixed, otp - k * 0.003 - (multiplier - 1) * 0.025, revenue


@pytest.mark.parametrize("k, strategy", [(1, "all_day"), (-1, "off_peak"), (3, "off_peak")])
def test_outcomes_agree_with_many_draws(spark, k, strategy):
    (got,) = whatif.outcomes(prepared(spark, (7, "FLL-ATL", k, strategy, 40))).collect()
    lf, otp, revenue = by_hand("FLL-ATL", k, strategy)
    spread = revenue.std()
    assert got.mean_otp == pytest.approx(otp)
    assert (got.mean_lf, got.p10_lf, got.p90_lf) == pytest.approx(
        (lf.mean(), *np.percentile(lf, [10, 90])), abs=0.004)
    assert got.mean_revenue == pytest.approx(revenue.mean(), abs=0.05 * spread)
    assert (got.p10_revenue, got.p90_revenue) == pytest.approx(
        tuple(np.percentile(revenue, [10, 90])), abs=0.08 * spread)
    assert got.p_revenue_positive == pytest.approx((revenue > 0).mean(), abs=0.02)


def test_outcomes_have_no_spread_and_no_rows(spark):
    (still,) = whatif.outcomes(prepared(spark, (1, "FLL-ATL", 0, "all_day", 10))).collect()
    assert (still.mean_revenue, still.p_revenue_positive) == (pytest.approx(0, abs=1e-6), pytest.approx(0.5, abs=0.01))
    assert whatif.outcomes(prepared(spark, (1, "FLL-XYZ", 1, "all_day", 10))).count() == 0


def test_normal_share(spark):
    z = [-3.0, -1.2815515655446004, -0.1, 0.0, 0.5, 1.6448536269514722, 4.0]
    df = spark.createDataFrame([(v,) for v in z], "z double")
    got = [r[0] for r in df.select(whatif.normal_cdf(F.col("z"))).collect()]
    assert got == pytest.approx([(1 + math.erf(v / math.sqrt(2))) / 2 for v in z], abs=2e-7)


def test_defaults_labels_and_rejects(spark):
    df = spark.createDataFrame(
        [(1, "FLL-ATL", 1), (2, "FLL-XYZ", 1), (3, "FLL-MIA", -10), (4, "FLL-MIA", -2)],
        "scenario_id long, route string, additional_daily_flights int")
    rows = {r.scenario_id: r for r in whatif.prepare_scenarios(df).collect()}
    assert rows[1].label == "FLL-ATL: +1 daily flight(s), All-Day (Spread)"
    assert rows[1].simulation_runs == 10000
    assert {i: r.reject_reason for i, r in rows.items()} == {
        1: None, 2: "unknown route", 3: "no flights left", 4: "no flights left"}
    bad = prepared(spark, (5, "FLL-ATL", 1, "night", 10)).first()
    assert (bad.reject_reason, bad.label) == ("unknown schedule_change", None)


def test_comparison_and_narrative(spark):
    df = spark.createDataFrame(
        [(1, "FLL-ATL", 1), (2, "FLL-LAS", 2)],
        "scenario_id long, route string, additional_daily_flights int")
    table = whatif.compare(df).cache()
    rows = table.collect()
    assert len(rows) == 6
    for r in rows:
        assert r["LF_P10_%"] <= r["Projected_LF_%"] <= r["LF_P90_%"]
        assert r["Rev_P10_M$"] <= r["Annual_Revenue_Delta_M$"] <= r["Rev_P90_M$"]
        assert r.Recommendation.startswith(r.Verdict + ": +")
    lf = {(r.scenario_id, r.Schedule): r["Projected_LF_%"] for r in rows}
    assert lf[1, "peak_only"] > lf[1, "all_day"] > lf[1, "off_peak"]
    # Published results for this scenario.
    atl = {r.Schedule: r for r in rows if r.scenario_id == 1}
    assert atl["all_day"].LF_Change_pp == pytest.approx(-1.7, abs=0.5)
    assert atl["off_peak"].LF_Change_pp == pytest.approx(-4.8, abs=0.5)
    assert atl["all_day"].Verdict == "NOT RECOMMENDED"
    best = {r.scenario_id: r for r in whatif.best_strategy(table).collect()}
    assert best[1].Schedule == "peak_only"
    text = {r.scenario_id: r.narrative for r in whatif.narrative(table).collect()}
    lines = text[2].split("\n")
    assert lines[0] == "=== Scenario Analysis: FLL-LAS +2 Daily Flight(s) ==="
    assert [x.split("]")[0] for x in lines[7:10]] == ["  [ALL_DAY   ", "  [PEAK_ONLY ", "  [OFF_PEAK  "]
    assert lines[-1].strip() == best[2].Recommendation


def test_verdict_edges(spark):
    df = spark.createDataFrame([(1.0, -2.9), (1.0, -3.0), (0.0, 5.0)], "rev double, pp double")
    got = [r[0] for r in df.select(whatif.verdict(F.col("rev"), F.col("pp"))).collect()]
    assert got == ["RECOMMENDED", "PROCEED WITH CAUTION", "NOT RECOMMENDED"]


def test_histogram(spark):
    df = spark.createDataFrame(
        [("a", v) for v in (0.0, 1.0, 2.5, 9.9, 10.0)] + [("b", 3.0), ("b", None)],
        "k string, x double")
    got = {(r.k, r.bin): (r.bin_low, r.n) for r in whatif.histogram(df, "x", 5, ["k"]).collect()}
    assert got == {("a", 1): (0.0, 2), ("a", 2): (2.0, 1), ("a", 5): (8.0, 2), ("b", 1): (3.0, 1)}
