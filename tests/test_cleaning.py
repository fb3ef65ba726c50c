from __future__ import annotations

import datetime as dt

import pytest

from slipstream.functions.columns import clamp, right_closed_bin, rounded, season
from slipstream.operators.cleaning import clean_capacity, clean_flights, clean_weather
from slipstream.operators.weather_join import join_weather

FLIGHT = (
    "FlightDate date, Route string, Origin string, Dest string, CRSDepTime string, "
    "DepDelay string, ArrDelay string, ArrDel15 string, Cancelled string, AirTime string, "
    "Distance int"
)
D = dt.date


def flight(**changes):
    row = {
        "FlightDate": D(2023, 6, 15), "Route": "H-A", "Origin": "H", "Dest": "A",
        "CRSDepTime": "800", "DepDelay": "15", "ArrDelay": "12", "ArrDel15": "0",
        "Cancelled": "0", "AirTime": "90", "Distance": 581,
    }
    return tuple({**row, **changes}.values())


def cleaned(spark, *rows):
    return clean_flights(spark.createDataFrame(list(rows), FLIGHT)).collect()


def test_calendar_and_hour(spark):
    (r,) = cleaned(spark, flight())
    assert (r.Year, r.Month, r.Quarter, r.DayOfWeek, r.DayOfYear, r.DepHour) == (2023, 6, 2, 3, 166, 8)


@pytest.mark.parametrize("hhmm, hour", [("5", 0), ("2359", 23), ("2400", 23), (None, 0), ("x", 0)])
def test_hour_edges(spark, hhmm, hour):
    assert cleaned(spark, flight(CRSDepTime=hhmm))[0].DepHour == hour


def test_delays_are_clamped_and_null_is_kept(spark):
    a, b, c = cleaned(
        spark, flight(DepDelay="700", ArrDelay="-50"),
        flight(DepDelay="n/a", ArrDelay=None), flight(DepDelay="NaN", ArrDelay="600"),
    )
    assert (a.DepDelay, a.ArrDelay) == (600.0, -30.0)
    assert (b.DepDelay, b.ArrDelay) == (None, None)
    assert (c.DepDelay, c.ArrDelay) == (None, 600.0)


@pytest.mark.parametrize("key", ["FlightDate", "Route", "Origin", "Dest"])
def test_rows_without_keys_are_dropped(spark, key):
    assert len(cleaned(spark, flight(), flight(**{key: None}))) == 1


def test_missing_flags_become_zero(spark):
    (r,) = cleaned(spark, flight(ArrDel15=None, Cancelled=None))
    assert (r.ArrDel15, r.Cancelled) == (0, 0)


def test_capacity(spark):
    df = spark.createDataFrame(
        [("A", 2023, 1, "1.2"), ("B", 2023, 1, "bad"), (None, 2023, 1, "0.5"), ("C", 2023, None, "1")],
        "Route string, Year int, Month int, LoadFactor string",
    )
    assert {r.Route: r.LoadFactor for r in clean_capacity(df).collect()} == {"A": 1.0, "B": None}


WEATHER = (
    "valid timestamp_ntz, station string, tmpf string, sknt string, p01i string, vsby string, "
    "gust string, wxcodes string"
)


def hour(h, **changes):
    row = {
        "valid": dt.datetime(2023, 6, 15, h), "station": "H", "tmpf": "80", "sknt": "5",
        "p01i": "0", "vsby": "10", "gust": None, "wxcodes": "",
    }
    return tuple({**row, **changes}.values())


def test_weather_fill_and_clamp_order(spark):
    df = spark.createDataFrame([
        hour(0, sknt="-7", p01i=None, vsby=None, wxcodes=None),
        hour(1, sknt=None, p01i="99", vsby="-4", tmpf="500", gust="26", wxcodes="+TSRA"),
    ], WEATHER)
    a, b = clean_weather(df).orderBy("valid").collect()
    assert (a.sknt, a.p01i, a.vsby, a.gust, a.weather_severity) == (7.0, 0.0, 10.0, None, 0.0)
    assert (b.sknt, b.p01i, b.vsby, b.tmpf) == (0.0, 10.0, 0.0, 120.0)
    # 4 + 2.5 + 1.5 + 2 + 1 is limited to 10
    assert b.weather_severity == 10.0
    assert (b.thunderstorm_flag, b.precipitation_flag, b.low_visibility_flag, b.wind_gust_flag) == (
        1, 1, 1, 1)


def test_rain_rate_adds_up_to_one_point(spark):
    df = spark.createDataFrame([hour(0, p01i="0.25"), hour(1, p01i="0.01")], WEATHER)
    a, b = clean_weather(df).orderBy("valid").collect()
    assert a.weather_severity == pytest.approx(2.0)
    assert (b.precipitation_flag, round(b.weather_severity, 9)) == (0, 0.02)


def test_join_keeps_every_flight_once(spark):
    flights = clean_flights(spark.createDataFrame(
        [flight(), flight(FlightDate=D(2023, 12, 20)), flight(CRSDepTime="900")], FLIGHT))
    # Two observations of one hour: the later one counts.
    later = (dt.datetime(2023, 6, 15, 8, 40), "H", "80", "5", "0", "1", None, "TSRA")
    weather = clean_weather(spark.createDataFrame([hour(8, vsby="2"), later], WEATHER))
    out = join_weather(flights, weather).collect()
    assert len(out) == 3
    match = [r for r in out if r.vsby == 1.0]
    assert len(match) == 1 and match[0].thunderstorm_flag == 1
    missing = [r for r in out if r.vsby == 10.0]
    assert [(r.weather_severity, r.p01i, r.thunderstorm_flag, r.tmpf) for r in missing] == [
        (0.0, 0.0, 0, None)] * 2


def test_column_helpers(spark):
    df = spark.createDataFrame([(0.285, 12), (1.005, 3), (None, 8), (-0.0, 11)], "x double, m int")
    rows = df.select(
        rounded("x", 2).alias("r"), clamp("x", 0.3, 1.0).alias("c"),
        season("m", ("w", "s", "u", "f")).alias("s"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (0.29, 0.3, "w"), (1.01, 1.0, "s"), (None, None, "u"), (0.0, 0.3, "f")]


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 0.51, 2.0, 10.0, 11.0, None)], "x double")
    got = [r[0] for r in df.select(
        right_closed_bin("x", (-0.1, 0.5, 2.0, 10.1), ("a", "b", "c"))).collect()]
    assert got == ["a", "a", "b", "b", "c", None, None]


def test_weather_join_does_not_shuffle_flights(spark, small):
    from conftest import executed_plan_of
    from slipstream.sources import adapters as ad

    plan = executed_plan_of(join_weather(ad.legs(spark, small), ad.weather(spark, small)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Python" not in plan
