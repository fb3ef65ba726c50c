"""Flights with the weather of their departure hour."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.operators.asof import as_of_join
from slipstream.operators.ordered import TASK_ROWS
from slipstream.operators.staging import stage

WEATHER_COLUMNS = (
    "tmpf", "dwpf", "drct", "sknt", "p01i", "vsby", "gust", "skyc1", "wxcodes",
    "thunderstorm_flag", "precipitation_flag", "low_visibility_flag", "wind_gust_flag",
    "weather_severity",
)
DEFAULTS = {
    "weather_severity": 0.0, "thunderstorm_flag": 0, "precipitation_flag": 0,
    "low_visibility_flag": 0, "wind_gust_flag": 0, "p01i": 0.0, "vsby": 10.0,
}


def hourly_weather(weather: DataFrame) -> DataFrame:
    """One row per (date, hour): the latest observation of the hour.

    Observations of one time are ordered by station and then by their values, nulls lowest.
    """
    kept = [c for c in WEATHER_COLUMNS if c in weather.columns]
    order = [c for c in ("valid", "station") if c in weather.columns]
    latest = F.max_by(F.struct(*kept), F.struct(*order, *[c for c in kept if c not in order]))
    return (
        weather.groupBy(F.to_date("valid").alias("wx_date"), F.hour("valid").alias("wx_hour"))
        .agg(latest.alias("wx"))
        .select("wx_date", "wx_hour", "wx.*")
    )


def join_weather(
    flights: DataFrame, weather: DataFrame, date: str = "FlightDate", hour: str = "DepHour"
) -> DataFrame:
    """Left join on exact date and hour; every flight is kept once, missing weather is defaulted.

    The hourly table has at most one row per hour of the calendar. It is written first, so the
    optimizer knows its size: it is broadcast when small, and otherwise the join shuffles with
    run-time skew handling.
    """
    hourly = stage(hourly_weather(weather))
    joined = flights.join(
        hourly,
        (flights[date] == hourly["wx_date"]) & (flights[hour] == hourly["wx_hour"]),
        "left",
    ).drop("wx_date", "wx_hour")
    return joined.fillna({c: v for c, v in DEFAULTS.items() if c in joined.columns})


def join_weather_as_of(
    flights: DataFrame,
    weather: DataFrame,
    at: str,
    tolerance: dt.timedelta = dt.timedelta(hours=1),
    station: str = "Origin",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Left join with the station's latest observation up to the departure, if within ``tolerance``.

    ``station`` is the column of the flights that names the weather station. Every flight is kept once;
    missing weather is defaulted as in ``join_weather``. ``valid`` is the time of the observation used.
    """
    kept = [c for c in WEATHER_COLUMNS if c in weather.columns]
    observed = weather.select(F.col("station").alias(station), "valid", *kept)
    joined = as_of_join(flights, observed, at, "valid", [station], tolerance, task_rows=task_rows)
    return joined.fillna({c: v for c, v in DEFAULTS.items() if c in kept})
