from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.operators import features

BASE = (
    "id long, FlightDate date, Route string, Origin string, Dest string, DepHour int, "
    "DepDelay double, ArrDelay double, ArrDel15 int, Cancelled int, Tail_Number string, "
    "AirTime double, Distance int"
)


def flights(spark, *rows):
    return spark.createDataFrame([
        (i, day, route, "FLL", route[-3:], hour, 1.0, 1.0, 0, 0, "T", 60.0, 444)
        for i, (day, route, hour) in enumerate(rows)
    ], BASE)


@pytest.mark.parametrize("day, holiday, window", [
    ("2023-07-04", 1, 1), ("2023-07-03", 0, 1), ("2023-07-06", 0, 1), ("2023-07-07", 0, 0),
    ("2023-07-02", 0, 0), ("2023-06-15", 0, 0),
])
def test_holidays(spark, day, holiday, window):
    (r,) = features.add_calendar_features(
        flights(spark, (dt.date.fromisoformat(day), "FLL-ATL", 8))).collect()
    assert (r.is_holiday, r.is_holiday_window) == (holiday, window)


def test_overlapping_windows_do_not_multiply_rows(spark):
    df = flights(spark, (dt.date(2023, 1, 2), "FLL-ATL", 8), (dt.date(2023, 1, 3), "FLL-ATL", 8))
    out = features.add_calendar_features(df, holidays=["2023-01-02", "2023-01-03"]).collect()
    assert [r.is_holiday for r in out] == [1, 1]


@pytest.mark.parametrize("hour, flags", [
    (6, (1, 0, 0, 0)), (7, (0, 1, 0, 0)), (9, (0, 1, 0, 0)), (10, (0, 0, 0, 0)),
    (13, (0, 0, 1, 0)), (17, (0, 0, 1, 0)), (18, (0, 0, 0, 1)), (23, (0, 0, 0, 1)),
])
def test_time_of_day(spark, hour, flags):
    (r,) = features.add_calendar_features(
        flights(spark, (dt.date(2024, 8, 10), "FLL-ATL", hour))).collect()
    assert (r.is_early_morning, r.is_peak_morning, r.is_afternoon, r.is_evening) == flags
    assert (r.is_weekend, r.is_summer, r.is_hurricane_season, r.is_winter) == (1, 1, 1, 0)
    assert r.hour_sin == pytest.approx(math.sin(2 * math.pi * hour / 24))
    assert r.month_cos == pytest.approx(math.cos(2 * math.pi * 7 / 12))
    assert r.dow_sin == pytest.approx(math.sin(2 * math.pi * 5 / 7))


def test_routes(spark):
    df = flights(*[spark], *[(dt.date(2024, 1, 1), r, 8) for r in ("FLL-ATL", "FLL-LAX", "ATL-FLL")])
    a, b, c = features.add_route_features(df).orderBy("id").collect()
    assert (a.route_distance, a.route_otp_baseline, a.is_high_congestion_dest) == (581.0, 0.74, 1)
    assert (b.is_long_haul, b.distance_normalised) == (1, 1.0)
    # Return legs are not in the table: own distance and the default baseline.
    assert (c.route_distance, c.route_otp_baseline, c.is_high_congestion_dest) == (444.0, 0.75, 0)
    assert c.distance_normalised == pytest.approx(444 / 2342)


def test_weather_defaults_and_fallback(spark):
    df = spark.createDataFrame(
        [(1, 0.02, 2.9, 26.0, "VCTS"), (2, None, None, None, None)],
        "id long, p01i double, vsby double, gust double, wxcodes string")
    a, b = features.add_weather_features(df).orderBy("id").collect()
    # 4 + 2.5 + 1.5 + 2, no rain-rate term
    assert (a.weather_severity, a.wind_speed, a.high_wind_flag) == (10.0, 0.0, 0)
    assert (b.weather_severity, b.thunderstorm_flag, b.low_visibility_flag) == (0.0, 0, 0)
    bare = features.add_weather_features(df.select("id")).first()
    assert (bare.weather_severity, bare.precipitation_flag) == (0.0, 0)
    kept = features.add_weather_features(
        df.select("id", F.lit(None).cast("double").alias("weather_severity"),
                  F.lit(21.0).alias("sknt"))).first()
    assert (kept.weather_severity, kept.high_wind_flag) == (0.0, 1)


@pytest.mark.parametrize("on", [True, False])
def test_all_columns(spark, on):
    df = flights(spark, (dt.date(2024, 1, 1), "FLL-ATL", 8), (dt.date(2024, 1, 1), "FLL-ATL", 9))
    out = features.build_features(
        df, ["id"], propagation=on, tail_lag=on, rotation_chain=on)
    assert set(features.feature_columns()) <= set(out.columns)
    assert out.count() == 2
    if not on:
        r = out.first()
        assert r.prev_tail_dep_delay == r.tail_delay_streak == r.rolling_avg_dep_delay == 0.0


def test_feature_list():
    assert len(fv.FEATURES) == len(set(fv.FEATURES)) == 43
