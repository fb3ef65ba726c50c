"""The 43 model features of a flight."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import clamp, cyclic, flag, literal_table
from slipstream.operators import rotation
from slipstream.operators.cleaning import flag_severity
from slipstream.operators.trailing import trailing_mean_delay


def holiday_table(
    spark: SparkSession, holidays: Sequence[str] = fv.HOLIDAYS, window=fv.HOLIDAY_WINDOW_DAYS
) -> DataFrame:
    """One row per date that is a holiday or lies in a holiday's travel window."""
    dates = literal_table(spark, ["holiday"], [(dt.date.fromisoformat(h),) for h in holidays])
    days = F.sequence(F.lit(window[0]), F.lit(window[1]))
    return (
        dates.select("holiday", F.explode(days).alias("shift"))
        .groupBy(F.date_add("holiday", F.col("shift")).alias("holiday_date"))
        .agg(F.max(flag(F.col("shift") == 0)).alias("is_holiday"))
    )


def add_calendar_features(
    flights: DataFrame,
    day: str = "FlightDate",
    hour: str = "DepHour",
    holidays: Sequence[str] = fv.HOLIDAYS,
) -> DataFrame:
    """Calendar parts, holiday markers, time-of-day and season flags, cyclic encodings."""
    date = F.col(day).cast("date")
    parts = flights.withColumns({
        "hour_of_day": clamp(hour, *fv.HOUR_OF_DAY).cast("int"),
        "day_of_week": F.weekday(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "day_of_year": F.dayofyear(date),
    })
    h, dow, month = F.col("hour_of_day"), F.col("day_of_week"), F.col("month")
    hour_sin, hour_cos = cyclic(h, 24)
    month_sin, month_cos = cyclic(month - 1, 12)
    dow_sin, dow_cos = cyclic(dow, 7)
    # A few rows per holiday given: the list is a parameter of the plan, so broadcasting is safe.
    near = F.broadcast(holiday_table(flights.sparkSession, holidays))
    return (
        parts.join(near, F.col(day).cast("date") == near["holiday_date"], "left")
        .withColumns({
            "is_holiday": F.coalesce(F.col("is_holiday"), F.lit(0)),
            "is_holiday_window": flag(F.col("holiday_date").isNotNull()),
            "is_weekend": flag(dow >= 5),
            "is_monday": flag(dow == 0),
            "is_friday": flag(dow == 4),
            "is_early_morning": flag(h < 7),
            "is_peak_morning": flag(h.between(7, 9)),
            "is_afternoon": flag(h.between(13, 17)),
            "is_evening": flag(h >= 18),
            "is_summer": flag(month.isin(6, 7, 8)),
            "is_hurricane_season": flag(month.isin(8, 9, 10)),
            "is_winter": flag(month.isin(12, 1, 2)),
            "hour_sin": hour_sin, "hour_cos": hour_cos,
            "month_sin": month_sin, "month_cos": month_cos,
            "dow_sin": dow_sin, "dow_cos": dow_cos,
        })
        .drop("holiday_date")
    )


def route_table(spark: SparkSession) -> DataFrame:
    names = ["route", "distance", "base_otp", "base_lf", "daily_flights", "annual_pax"]
    return literal_table(spark, names, fv.ROUTES)


def add_route_features(
    flights: DataFrame,
    routes: DataFrame | None = None,
    congested: Sequence[str] = fv.CONGESTED_DESTINATIONS,
    route: str = "Route",
    dest: str = "Dest",
) -> DataFrame:
    """Distance, punctuality baseline and route flags.

    ``routes`` has columns route, distance, base_otp. The built-in table of ten routes is
    broadcast; a table passed in is joined as the optimizer sees fit for its size.
    """
    lookup = F.broadcast(route_table(flights.sparkSession)) if routes is None else routes
    lookup = lookup.select(
        F.col("route").alias("_route"), F.col("distance").alias("_distance"),
        F.col("base_otp").alias("_base_otp"),
    )
    own = F.col("Distance") if "Distance" in flights.columns else F.lit(0)
    longest = (
        F.lit(float(max(r[1] for r in fv.ROUTES))) if routes is None
        else routes.select(F.max("distance").cast("double")).scalar()
    )
    return (
        flights.join(lookup, flights[route] == lookup["_route"], "left")
        .withColumn("route_distance", F.coalesce(F.col("_distance"), own).cast("double"))
        .withColumns({
            "route_otp_baseline": F.coalesce(F.col("_base_otp"), F.lit(fv.DEFAULT_ROUTE_OTP)),
            "is_high_congestion_dest": flag(F.col(dest).isin(*congested)),
            "is_long_haul": flag(F.col("route_distance") >= fv.LONG_HAUL_MILES),
            "is_short_haul": flag(F.col("route_distance") < fv.SHORT_HAUL_MILES),
            "distance_normalised": F.col("route_distance") / longest,
        })
        .drop("_route", "_distance", "_base_otp")
    )


def add_weather_features(flights: DataFrame) -> DataFrame:
    """Complete the weather columns: raw measurements win, then given flags, then zero."""
    have = set(flights.columns)
    measured = {
        "precipitation_flag": ("p01i", F.col("p01i") > 0.01),
        "low_visibility_flag": ("vsby", F.col("vsby") < 3.0),
        "wind_gust_flag": ("gust", F.col("gust") > 25.0),
        "thunderstorm_flag": ("wxcodes", F.col("wxcodes").contains("TS")),
    }
    flags = {}
    for name, (source, condition) in measured.items():
        if source in have:
            flags[name] = flag(condition)
        elif name in have:
            flags[name] = F.coalesce(F.col(name).cast("int"), F.lit(0))
        else:
            flags[name] = F.lit(0)
    wind = F.coalesce(F.col("sknt"), F.lit(0.0)) if "sknt" in have else F.lit(0.0)
    severity = (
        F.coalesce(F.col("weather_severity"), F.lit(0.0)) if "weather_severity" in have
        else clamp(flag_severity(), 0.0, 10.0)
    )
    return flights.withColumns(flags).withColumns(
        {"weather_severity": severity, "wind_speed": wind, "high_wind_flag": flag(wind > 20.0)}
    )


def build_features(
    flights: DataFrame,
    tie_break: Sequence[str],
    propagation: bool = True,
    tail_lag: bool = True,
    rotation_chain: bool = True,
    mode: str = "peers",
    routes: DataFrame | None = None,
    holidays: Sequence[str] = fv.HOLIDAYS,
    task_rows: int = rotation.TASK_ROWS,
) -> DataFrame:
    """All feature columns; a group that is switched off is constant 0.

    The features that need other flights come first, so that the exchange on the vehicle carries
    the input columns only; everything else is computed behind it without a further exchange.
    """
    out = flights
    if propagation:
        out = trailing_mean_delay(out, mode=mode, tie_break=tie_break, task_rows=task_rows)
    else:
        out = out.withColumn("rolling_avg_dep_delay", F.lit(0.0))
    if tail_lag or rotation_chain:
        out = rotation.rotation_features(out, tie_break, task_rows=task_rows)
    out = add_calendar_features(out, holidays=holidays)
    out = add_weather_features(add_route_features(out, routes))
    off = [
        name for name in rotation.FEATURES
        if not (tail_lag if name == "prev_tail_dep_delay" else rotation_chain)
    ]
    return out.withColumns({name: F.lit(0.0) for name in off}) if off else out


def feature_columns() -> list[str]:
    return list(fv.FEATURES)
