"""Validation and typing of raw flights, capacity and weather rows.

Projections and filters only: nothing here shuffles, and Catalyst prunes and pushes through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import clamp, flag, number

FLIGHT_KEYS = ("FlightDate", "Route", "Origin", "Dest")
FLIGHT_MEASURES = (
    "DepDelay", "ArrDelay", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay", "AirTime",
)


def calendar_parts(date: str) -> dict[str, Column]:
    """Year to quarter of a date; Monday is day 0 of the week."""
    return {
        "Year": F.year(date), "Month": F.month(date), "DayOfWeek": F.weekday(date),
        "DayOfYear": F.dayofyear(date), "Quarter": F.quarter(date),
    }


def limited(value: str, low: float, high: float) -> Column:
    """``clamp`` of SQL text that is cheap to repeat."""
    return F.expr(
        f"case when {value} is not null then least(greatest({value}, {low}D), {high}D) end"
    )


def typed(column: str, kind: str) -> str:
    """SQL text of a measure as double; text that is no number and NaN become null."""
    if kind in ("int", "bigint", "smallint", "tinyint"):
        return f"double({column})"
    return f"nullif(try_cast({column} as double), double('NaN'))"


def clean_flights(flights: DataFrame) -> DataFrame:
    """Drop rows without keys, type the measures, clamp delays, add calendar columns."""
    kinds = dict(flights.dtypes)
    made = {c: F.expr(typed(c, kinds[c])) for c in FLIGHT_MEASURES if c in kinds}
    for delay in ("DepDelay", "ArrDelay"):
        made[delay] = limited(typed(delay, kinds[delay]), *fv.DELAY_MINUTES)
    for marker in ("ArrDel15", "Cancelled"):
        made[marker] = F.expr(f"int(coalesce({typed(marker, kinds[marker])}, 0.0D))")
    if kinds.get("Distance", "int") != "int":
        made["Distance"] = F.expr(f"int({typed('Distance', kinds['Distance'])})")
    made["FlightDate"] = F.col("FlightDate").cast("date")
    low, high = fv.HOUR_OF_DAY
    hhmm = f"coalesce({typed('CRSDepTime', kinds['CRSDepTime'])}, 0.0D)"
    made["DepHour"] = F.expr(f"least(greatest(int(floor({hhmm} / 100)), {low}), {high})")
    return (
        flights.dropna(subset=list(FLIGHT_KEYS))
        .withColumns(made)
        .withColumns(calendar_parts("FlightDate"))
    )


def clean_capacity(capacity: DataFrame) -> DataFrame:
    """Drop rows without keys and limit the load factor to [0, 1]."""
    return capacity.dropna(subset=["Route", "Year", "Month"]).withColumn(
        "LoadFactor", clamp(number("LoadFactor"), *fv.LOAD_FACTOR)
    )


def weather_flags() -> dict[str, Column]:
    """Condition flags of one observation; a missing measurement raises none."""
    return {
        "thunderstorm_flag": flag(F.col("wxcodes").contains("TS")),
        "precipitation_flag": flag(F.col("p01i") > 0.01),
        "low_visibility_flag": flag(F.col("vsby") < 3.0),
        "wind_gust_flag": flag(F.col("gust") > 25.0),
    }


def flag_severity() -> Column:
    """Severity points of the four condition flags, before the limit to 0..10."""
    return (
        F.col("thunderstorm_flag") * F.lit(4.0)
        + F.col("low_visibility_flag") * F.lit(2.5)
        + F.col("precipitation_flag") * F.lit(1.5)
        + F.col("wind_gust_flag") * F.lit(2.0)
    )


def clean_weather(weather: DataFrame) -> DataFrame:
    """Type and limit hourly observations, add condition flags and a severity of 0..10.

    Fill and limit come in a different order per column: rain and wind are filled with 0,
    visibility is limited first and then filled with 10, gusts stay missing.
    """
    rain_rate = F.least(F.col("p01i") / F.lit(0.5), F.lit(1.0))
    return (
        weather.dropna(subset=["valid"])
        .withColumns({
            "tmpf": clamp(number("tmpf"), *fv.TEMPERATURE_F),
            "sknt": F.coalesce(F.abs(number("sknt")), F.lit(0.0)),
            "p01i": clamp(F.coalesce(number("p01i"), F.lit(0.0)), *fv.HOURLY_RAIN_IN),
            "vsby": F.coalesce(clamp(number("vsby"), *fv.VISIBILITY_MI), F.lit(10.0)),
            "gust": number("gust"),
        })
        .withColumns(weather_flags())
        .withColumn("weather_severity", clamp(flag_severity() + rain_rate, 0.0, 10.0))
    )
