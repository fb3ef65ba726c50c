from __future__ import annotations

import math

import numpy as np
import pytest

from slipstream.operators import forecast as fc

SCHEMA = "Route string, Year int, Month int, Passengers long, Seats long"


def series(route, months, value=lambda i: 14000 + 2000 * math.sin(2 * math.pi * (i % 12) / 12)):
    return [(route, 2022 + i // 12, i % 12 + 1, int(value(i)), 31500) for i in range(months)]


def capacity(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], SCHEMA)


def test_short_series_are_skipped_and_reported(spark):
    df = capacity(spark, series("A", 11), series("B", 12), series("C", 36))
    assert {r.route for r in fc.monthly_panel(df).select("route").distinct().collect()} == {"B", "C"}
    assert [tuple(r) for r in fc.short_series(df).collect()] == [("A", 11)]


def test_rows_of_one_month_are_added_up(spark):
    df = capacity(spark, series("A", 12), series("A", 12))
    rows = fc.monthly_panel(df).orderBy("t").collect()
    assert [r.t for r in rows] == list(range(12))
    assert rows[0].x == 2 * 14000 and rows[0].seats == 63000


def reference_decomposition(x):
    n = len(x)
    weights = np.r_[0.5, np.ones(11), 0.5] / 12
    trend = np.full(n, np.nan)
    for i in range(6, n - 6):
        trend[i] = weights @ x[i - 6:i + 7]
    detrended = x - trend
    first, last = 6, n - 7
    head = np.arange(first, min(first + 12, last))
    tail = np.arange(max(first, last - 12), last)
    k, b = np.polyfit(head, trend[head], 1)
    k2, b2 = np.polyfit(tail, trend[tail], 1)
    trend[:6] = k * np.arange(6) + b
    trend[n - 6:] = k2 * np.arange(n - 6, n) + b2
    means = np.array([np.nanmean(detrended[m::12]) for m in range(12)])
    means -= means.mean()
    return trend, means[np.arange(n) % 12]


@pytest.mark.parametrize("months", [24, 25, 30, 47])
def test_decomposition(spark, months):
    rng = np.random.default_rng(1)
    noise = rng.normal(0, 300, months)
    rows = series("A", months, lambda i: 10000 + 40 * i + 1500 * math.cos(i / 2) + noise[i])
    out = fc.decompose(fc.monthly_panel(capacity(spark, rows))).orderBy("t").collect()
    x = np.array([float(r[3]) for r in rows])
    trend, seasonal = reference_decomposition(x)
    assert [r.trend for r in out] == pytest.approx(list(trend))
    assert [r.seasonal for r in out] == pytest.approx(list(seasonal))
    assert [r.resid for r in out] == pytest.approx(list(x - trend - seasonal), abs=1e-6)


def test_decomposition_needs_two_years(spark):
    assert fc.decompose(fc.monthly_panel(capacity(spark, series("A", 23)))).count() == 0


def smooth(x, a, b, g):
    """Level, trend, season and errors after a series; None stands for an unknown month."""
    known = [v for v in x[:12] if v is not None]
    level = sum(known) / len(known)
    later = [v for v in x[12:24] if v is not None]
    trend = (sum(later) / len(later) - level) / 12 if len(x) >= 24 and later else 0.0
    season = [0.0 if v is None else v - level for v in x[:12]]
    errors = []
    for v in x:
        s = season.pop(0)
        if v is None:
            level, season = level + trend, [*season, s]
            continue
        errors.append(v - (level + trend + s))
        new = a * (v - s) + (1 - a) * (level + trend)
        season.append(g * (v - level - trend) + (1 - g) * s)
        level, trend = new, b * (new - level) + (1 - b) * trend
    return level, trend, season, np.array(errors)


def squared(x, *settings):
    return float((smooth(x, *settings)[3] ** 2).sum())


def gappy(months, gaps):
    rng = np.random.default_rng(4)
    noise = rng.normal(0, 200, months)
    rows = series("A", months, lambda i: 9000 + 30 * i + 900 * math.sin(i / 1.9) + noise[i])
    return [r for i, r in enumerate(rows) if i not in gaps], [None if i in gaps else float(r[3]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("months, gaps", [(15, ()), (36, ()), (40, (3, 4, 17, 30))])
def test_holt_winters_fold_and_grid(spark, months, gaps):
    rows, x = gappy(months, gaps)
    fits = {
        (a, b, g): squared(x, a, b, g) for a in fc.DEFAULT_GRID["alpha"]
        for b in fc.DEFAULT_GRID["beta"] for g in fc.DEFAULT_GRID["gamma"]
    }
    best = min(fits, key=lambda k: (fits[k], k))
    level, trend, season, errors = smooth(x, *best)
    fitted = fc.fit_holt_winters(fc.monthly_panel(capacity(spark, rows)), search=False)
    r = fitted.first()
    assert (r.alpha, r.beta, r.gamma) == best
    assert (r.level, r.trend, r.sigma) == pytest.approx((level, trend, float(np.std(errors))))
    assert list(r.season) == pytest.approx(season)
    path = [p.f for p in fc.holt_winters_path(fitted, 14).orderBy("h").collect()]
    assert path == pytest.approx([level + h * trend + season[(h - 1) % 12] for h in range(1, 15)])


@pytest.mark.parametrize("months, gaps", [(36, ()), (40, (3, 4, 17, 30))])
def test_search_leaves_the_grid(spark, months, gaps):
    rows, x = gappy(months, gaps)
    r = fc.fit_holt_winters(fc.monthly_panel(capacity(spark, rows))).first()
    grid = [
        squared(x, a, b, g) for a in fc.DEFAULT_GRID["alpha"]
        for b in fc.DEFAULT_GRID["beta"] for g in fc.DEFAULT_GRID["gamma"]
    ]
    assert r.sse == pytest.approx(squared(x, r.alpha, r.beta, r.gamma)) and r.sse < min(grid)
    assert all(fc.LOWEST <= v <= fc.HIGHEST for v in (r.alpha, r.beta, r.gamma))
    # No point of a fine grid over the whole range is much better.
    steps = np.r_[0.0001, np.linspace(0.05, 0.95, 10), 0.9999]
    assert r.sse <= 1.02 * min(squared(x, a, b, g) for a in steps for b in steps for g in steps)


def test_panel_follows_the_calendar(spark):
    rows = series("A", 30) + [("B", 2020, 12, 5, 10)] + series("B", 13)
    kept = [r for r in rows if (r[0], r[1], r[2]) not in {("A", 2022, 3), ("A", 2023, 12)}]
    found = fc.monthly_panel(capacity(spark, kept)).orderBy("route", "t").collect()
    a, b = ([r for r in found if r.route == k] for k in "AB")
    assert [r.t for r in a] == list(range(30)) and [r.t for r in a if r.x is None] == [2, 23]
    assert a[2].month == 3 and str(a[2].period) == "2022-03-01" and a[2].seats is None
    # A year of unknown months between the first one and the others.
    assert len(b) == 26 and {r.n for r in b} == {26} and sum(r.x is None for r in b) == 12


def test_decomposition_with_gaps(spark):
    rows = series("A", 40, lambda i: 10000 + 50 * i + 800 * math.sin(2 * math.pi * i / 12))
    gaps = {1, 14, 15, 33}
    out = fc.decompose(fc.monthly_panel(capacity(spark, [r for i, r in enumerate(rows) if i not in gaps]))).orderBy("t").collect()
    x = np.array([float(r[3]) for r in rows])
    known = [i for i in range(40) if i not in gaps]
    filled = np.interp(np.arange(40), known, x[known])
    weights = np.r_[0.5, np.ones(11), 0.5] / 12
    trend = [float(weights @ filled[i - 6:i + 7]) for i in range(6, 34)]
    assert [r.trend for r in out[6:34]] == pytest.approx(trend)
    raw = {m: [x[i] - trend[i - 6] for i in range(6, 34) if i % 12 == m and i not in gaps] for m in range(12)}
    means = {m: sum(v) / len(v) for m, v in raw.items()}
    centre = sum(means.values()) / 12
    assert [r.seasonal for r in out] == pytest.approx([means[i % 12] - centre for i in range(40)])
    assert [i for i, r in enumerate(out) if r.resid is None] == sorted(gaps)


@pytest.mark.parametrize("model", ["holt_winters", "trend_season"])
def test_forecast_table(spark, model):
    df = capacity(spark, series("A", 36), series("B", 36, lambda i: 3), series("C", 14))
    out = fc.forecast(df, 3, model).collect()
    assert len(out) == 9
    for r in out:
        assert 0 <= r.lower_95 <= r.lower_80 <= r.forecast_passengers <= r.upper_80 <= r.upper_95
    a = sorted((r for r in out if r.route == "A"), key=lambda r: r.period)
    assert [str(r.period) for r in a] == ["2025-01-01", "2025-02-01", "2025-03-01"]
    assert len({r.forecast_lf for r in a}) == 1
    assert a[0].forecast_passengers == pytest.approx(14000, rel=0.02)


def test_unknown_model(spark):
    with pytest.raises(ValueError):
        fc.forecast(capacity(spark, series("A", 12)), 3, "guess")


def test_panel_needs_no_python_and_no_single_partition(spark):
    from conftest import executed_plan_of

    df = capacity(spark, series("A", 36))
    plan = executed_plan_of(fc.decompose(fc.monthly_panel(df)))
    assert "SinglePartition" not in plan and "ArrowEval" not in plan
