"""The five analytical views over flights and capacity.

Each is one aggregation: rows are combined before the shuffle, so a route that holds a third of
all flights costs its reducer one row per map task. Views are not sorted; reports sort at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.functions.aggregates import (
    LATE, OPERATED, PUNCTUAL, count_where, mean_where, punctuality, sum_where,
)
from slipstream.functions.columns import ratio, rounded, year_month

CAUSES = {
    "carrier": "CarrierDelay", "weather": "WeatherDelay", "nas": "NASDelay",
    "security": "SecurityDelay", "late_ac": "LateAircraftDelay",
}


def _cancel_rate() -> Column:
    return rounded(ratio(F.sum("Cancelled"), F.count("*")), 4)


def _mean(c: str, condition: str = OPERATED) -> Column:
    return rounded(mean_where(c, condition), 2)


def route_performance(flights: DataFrame) -> DataFrame:
    """Punctuality, cancellations and mean delays per route and month."""
    means = {
        "avg_arr_delay_min": "ArrDelay", "avg_dep_delay_min": "DepDelay",
        "avg_carrier_delay": "CarrierDelay", "avg_weather_delay": "WeatherDelay",
        "avg_nas_delay": "NASDelay", "avg_late_ac_delay": "LateAircraftDelay",
    }
    return flights.groupBy("Route", "Origin", "Dest", "Year", "Month", "Distance").agg(
        F.count("*").alias("total_flights"),
        F.sum("Cancelled").alias("cancelled_flights"),
        _cancel_rate().alias("cancel_rate"),
        count_where(OPERATED).alias("operated_flights"),
        count_where(LATE).alias("delayed_flights"),
        rounded(punctuality(), 4).alias("otp_rate"),
        *[_mean(source).alias(name) for name, source in means.items()],
    )


def monthly_otp_summary(flights: DataFrame) -> DataFrame:
    """Network-wide month.

    Two steps on purpose: flights are added up per (month, route) first, so the number of routes
    is a plain count and no row is expanded for the distinct count.
    """
    per_route = flights.groupBy("Year", "Month", "Route").agg(
        F.count("*").alias("total"),
        F.sum("Cancelled").alias("cancelled"),
        count_where(OPERATED).alias("operated"),
        count_where(PUNCTUAL).alias("punctual"),
        *[
            F.expr(f"{f}(case when {OPERATED} then {c} end)").alias(f"{f}_{c}")
            for c in ("ArrDelay", "DepDelay") for f in ("sum", "count")
        ],
    )

    def mean(c: str) -> Column:
        return rounded(ratio(F.sum(f"sum_{c}"), F.sum(f"count_{c}")), 2)

    return per_route.groupBy("Year", "Month").agg(
        year_month("Year", "Month").alias("YearMonth"),
        F.sum("total").alias("total_flights"),
        F.sum("cancelled").alias("cancelled_flights"),
        rounded(ratio(F.sum("cancelled"), F.sum("total")), 4).alias("cancel_rate"),
        rounded(ratio(F.sum("punctual"), F.sum("operated")), 4).alias("network_otp"),
        mean("ArrDelay").alias("avg_arr_delay"),
        mean("DepDelay").alias("avg_dep_delay"),
        F.count("Route").alias("routes_operated"),
    )


def delay_cause_decomposition(flights: DataFrame) -> DataFrame:
    """Mean minutes per cause over late flights, and the share of four causes in all minutes.

    Security minutes are part of the whole but get no share, so shares need not add up to one.
    """
    minutes = " + ".join(f"coalesce({c}, 0.0D)" for c in CAUSES.values())
    whole = sum_where(minutes, LATE)
    return flights.groupBy("Route", "Year", "Month").agg(
        *[_mean(c, LATE).alias(f"avg_{name}_delay") for name, c in CAUSES.items()],
        count_where(LATE).alias("delayed_count"),
        *[
            rounded(ratio(sum_where(c, LATE), whole), 4).alias(f"{name}_delay_pct")
            for name, c in CAUSES.items() if name != "security"
        ],
    )


def capacity_utilization(capacity: DataFrame, performance: DataFrame) -> DataFrame:
    """Monthly capacity with the punctuality of its route and month, where flights exist."""
    keys = ["Route", "Year", "Month"]
    measures = [
        "otp_rate", "avg_arr_delay_min", "cancel_rate", "delayed_flights", "operated_flights"
    ]
    own = [
        "YearMonth", "DepScheduled", "DepPerformed", "Seats", "Passengers", "LoadFactor"
    ]
    return (
        capacity.select(*keys, *own)
        .join(performance.select(*keys, *measures), keys, "left")
        .select(*keys, *own, *measures)
    )


def weather_impact(flights: DataFrame) -> DataFrame:
    """Weather and punctuality per route and month. The flag counts are counts of flights."""
    return flights.groupBy("Route", "Year", "Month").agg(
        rounded(F.avg("weather_severity"), 2).alias("avg_weather_severity"),
        _mean("ArrDelay").alias("avg_arr_delay"),
        rounded(punctuality(), 4).alias("otp_rate"),
        F.sum("thunderstorm_flag").alias("thunderstorm_count"),
        F.sum("precipitation_flag").alias("precipitation_count"),
        F.sum("low_visibility_flag").alias("low_vis_count"),
        F.sum("wind_gust_flag").alias("wind_gust_count"),
        F.count("*").alias("total_flights"),
    )


def performance_rollup(flights: DataFrame, vehicle: str = "Tail_Number") -> DataFrame:
    """Flights, vehicles and mean delay per (Route, Year, Month), (Route, Year), Route and over all.

    ``level`` is the grouping id: bit 4 for Route, 2 for Year, 1 for Month, set where the column is
    added up. Flights are reduced to one row per month, route and vehicle before the levels are made,
    so the rows are multiplied after the reduction; distinct vehicles are counted anew at each level.
    """
    monthly = flights.groupBy("Route", "Year", "Month", vehicle).agg(
        F.count("*").alias("n"), F.count("DepDelay").alias("known"), F.sum("DepDelay").alias("total"),
    )
    return monthly.rollup("Route", "Year", "Month").agg(
        F.grouping_id().alias("level"),
        F.sum("n").alias("flights"),
        F.count_distinct(vehicle).alias("vehicles"),
        rounded(ratio(F.sum("total"), F.sum("known")), 6).alias("avg_dep_delay"),
    )
