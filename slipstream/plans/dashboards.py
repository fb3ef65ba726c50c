"""Aggregates behind the dashboard pages, the exploration reports and the model diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.functions.aggregates import OPERATED, count_where, percent_of_rows
from slipstream.functions.columns import right_closed_bin, rounded
from slipstream.operators.ordered import percentiles
from slipstream.plans.views import CAUSES

ON_TIME = "ArrDel15 = 0"
# Share of operated flights, in percent, that were on time; over rows that include cancelled ones.
OTP_PERCENT = f"avg(case when {OPERATED} then double({ON_TIME}) end) * 100.0D"
MONTHS = tuple(range(1, 13))
SEVERITY_BINS = (
    (-0.1, 0.5, 2.0, 4.0, 6.0, 10.1), ("Clear", "Light", "Moderate", "Significant", "Severe"),
)
SEVERITY_BINS_COARSE = ((-0.1, 0.5, 2.0, 4.0, 10.1), ("Clear", "Light", "Moderate", "Severe"))
CAUSE_LABELS = {
    "CarrierDelay": "Carrier", "WeatherDelay": "Weather", "NASDelay": "NAS / ATC",
    "SecurityDelay": "Security", "LateAircraftDelay": "Late Aircraft",
}


def operated(flights: DataFrame, routes: Sequence[str] | None = None) -> DataFrame:
    """Flights that took place, optionally of some routes only."""
    out = flights.where(OPERATED)
    return out if routes is None else out.where(F.col("Route").isin(*routes))


def delayed_only(flights: DataFrame) -> DataFrame:
    return operated(flights).where(F.col("ArrDel15") == 1)


def kpi_row(flights: DataFrame, capacity: DataFrame) -> DataFrame:
    """One row of headline figures from flights and capacity."""
    seats = capacity.agg(
        (F.avg("LoadFactor") * 100.0).alias("avg_load_factor_pct"),
        F.sum("Passengers").alias("total_passengers"),
    )
    return flights.agg(
        F.expr(OTP_PERCENT).alias("otp_pct"),
        F.expr(f"avg(case when {OPERATED} then ArrDelay end)").alias("avg_arr_delay"),
        (F.avg("Cancelled") * 100.0).alias("cancel_rate_pct"),
        F.count_distinct("Route").alias("routes"),
    ).select(
        "*",
        seats.select("avg_load_factor_pct").scalar().alias("avg_load_factor_pct"),
        seats.select("total_passengers").scalar().alias("total_passengers"),
    )


def monthly_punctuality(flights: DataFrame) -> DataFrame:
    return operated(flights).groupBy("Year", "Month").agg(
        F.count("ArrDel15").alias("total"), count_where(ON_TIME).alias("ontime"),
        F.avg("ArrDelay").alias("avg_delay"), percent_of_rows(ON_TIME).alias("otp_pct"),
    ).withColumn("period", F.make_date("Year", "Month", F.lit(1))).orderBy("Year", "Month")


def route_summary(flights: DataFrame) -> DataFrame:
    """Operated flights per route; none of them is cancelled, so that column is always 0."""
    return operated(flights).groupBy("Route").agg(
        F.count("ArrDel15").alias("operated_flights"),
        rounded(percent_of_rows(ON_TIME), 1).alias("otp_pct"),
        rounded(F.avg("ArrDelay"), 1).alias("avg_delay_min"),
        F.sum("Cancelled").alias("cancelled"),
    ).orderBy(F.col("otp_pct").desc_nulls_last(), "Route")


def punctuality_grid(flights: DataFrame, row: str, names: Sequence[str] | None = None) -> DataFrame:
    """Punctuality in percent, one row per ``row`` and one column per month."""
    labels = list(names or [f"m{m:02d}" for m in MONTHS])
    cells = operated(flights).groupBy(row).pivot("Month", list(MONTHS)).agg(
        percent_of_rows(ON_TIME)
    )
    return cells.toDF(row, *labels)


def cause_means(flights: DataFrame) -> DataFrame:
    """Mean minutes per cause over late flights, per route."""
    return delayed_only(flights).groupBy("Route").agg(
        *[F.avg(c).alias(f"avg_{name}") for name, c in CAUSES.items()]
    )


def cause_totals(flights: DataFrame) -> DataFrame:
    """Total minutes per cause over late flights, one row per cause."""
    totals = delayed_only(flights).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(label) for c, label in CAUSE_LABELS.items()]
    )
    return totals.unpivot([], list(CAUSE_LABELS.values()), "cause", "minutes")


def route_detail(flights: DataFrame, capacity: DataFrame) -> DataFrame:
    """Per route: punctuality, delays with the 75th percentile, two causes, mean load factor."""
    flown = operated(flights)
    main = flown.groupBy("Route").agg(
        F.count("ArrDel15").alias("operated"),
        rounded(percent_of_rows(ON_TIME), 1).alias("otp_pct"),
        rounded(F.avg("ArrDelay"), 1).alias("avg_delay"),
        F.avg("CarrierDelay").alias("avg_carrier"), F.avg("WeatherDelay").alias("avg_weather"),
    )
    # Arrival delays are whole minutes within a fixed range: few distinct values per route.
    p75 = percentiles(flown, ["Route"], "ArrDelay", {"_p75": 0.75}, few_values=True)
    load = capacity.groupBy("Route").agg(rounded(F.avg("LoadFactor") * 100.0, 1).alias("avg_lf_pct"))
    return (
        main.join(p75, "Route", "left").join(load, "Route", "left")
        .select(
            "Route", "operated", "otp_pct", "avg_delay", rounded("_p75", 1).alias("p75_delay"),
            "avg_carrier", "avg_weather", "avg_lf_pct",
        )
    )


def route_volume(flights: DataFrame) -> DataFrame:
    return flights.groupBy("Route").agg(
        F.count("ArrDel15").alias("total_flights"),
        count_where(OPERATED).alias("operated"), F.sum("Cancelled").alias("cancelled"),
    ).orderBy("total_flights", "Route")


def _by_severity(flights: DataFrame, bins, *measures: Column) -> DataFrame:
    severity = F.coalesce(F.col("weather_severity"), F.lit(0.0))
    return operated(flights).groupBy(right_closed_bin(severity, *bins).alias("severity_bin")).agg(
        *measures
    )


def punctuality_by_severity(flights: DataFrame) -> DataFrame:
    return _by_severity(
        flights, SEVERITY_BINS,
        percent_of_rows(ON_TIME).alias("otp_pct"), F.avg("ArrDelay").alias("avg_delay"),
        F.count("ArrDel15").alias("n"),
    )


def delay_rate_by_severity(flights: DataFrame) -> DataFrame:
    return _by_severity(
        flights, SEVERITY_BINS_COARSE,
        (F.avg("ArrDel15") * 100.0).alias("delay_rate"), F.count("ArrDel15").alias("n"),
    )


def load_factor_stats(capacity: DataFrame) -> DataFrame:
    return capacity.groupBy("Route").agg(
        F.avg("LoadFactor").alias("mean_lf"), F.stddev_samp("LoadFactor").alias("std_lf"),
        F.min("LoadFactor").alias("min_lf"), F.max("LoadFactor").alias("max_lf"),
    )


def load_factor_boxes(capacity: DataFrame) -> DataFrame:
    """Five-number summary per route; a route has one load factor per month."""
    points = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return percentiles(capacity, ["Route"], "LoadFactor", points, few_values=True)


def exploration_summary(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count("*").alias("total_flights"), count_where(OPERATED).alias("operated_flights"),
        F.sum("Cancelled").alias("cancelled_flights"),
        F.expr(OTP_PERCENT).alias("otp_pct"),
        F.expr(f"avg(case when {OPERATED} then ArrDelay end)").alias("avg_arr_delay"),
        F.count_distinct("Route").alias("routes"),
        F.min("FlightDate").alias("first_date"), F.max("FlightDate").alias("last_date"),
    )


def delay_rate_by_hour(flights: DataFrame, hour: str = "DepHour") -> DataFrame:
    return operated(flights).groupBy(F.col(hour).alias("hour_of_day")).agg(
        (F.avg("ArrDel15") * 100.0).alias("delay_rate")
    )


def error_profile(predicted: DataFrame, measures: Sequence[str], label: str = "label") -> DataFrame:
    """Per kind of outcome: rows and the mean of some features."""
    actual, guess = F.col(label), F.col("prediction")
    kind = (
        F.when((actual == 0) & (guess == 1), "False Positive")
        .when((actual == 1) & (guess == 0), "False Negative")
        .when((actual == 1) & (guess == 1), "True Positive").otherwise("True Negative")
    )
    return predicted.groupBy(kind.alias("error_type")).agg(
        F.count("*").alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in measures]
    )


def load_check(flights: DataFrame) -> DataFrame:
    return flights.agg(F.count("*").alias("flights"), F.count_distinct("Route").alias("routes"))


def flights_per_route(flights: DataFrame) -> DataFrame:
    return flights.groupBy("Route").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "Route")
