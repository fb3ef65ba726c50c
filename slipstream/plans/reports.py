"""Named reports over the views: file reports, canned answers and export sheets.

Functions take view DataFrames and return lazily. Sorting happens here, on aggregated rows, and
each sort ends in a unique key, so a limit always keeps the same rows. Nulls sort last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import first_match, nullif_zero, ratio, rounded, season, year_month

LONG_SEASONS = ("Winter (Dec-Feb)", "Spring (Mar-May)", "Summer (Jun-Aug)", "Fall (Sep-Nov)")
SHORT_SEASONS = ("Winter", "Spring", "Summer", "Fall")


def up(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def down(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def percent(c: str | Column, digits: int) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return rounded(value * F.lit(100.0), digits)


def mean(c: str, digits: int) -> Column:
    return rounded(F.avg(c), digits)


# ---- file reports -------------------------------------------------------------------------------

def otp_trend(summary: DataFrame) -> DataFrame:
    return summary.select(
        "YearMonth", "Year", "Month",
        F.col("network_otp").alias("network_otp_rate"),
        percent("network_otp", 1).alias("otp_pct"),
        F.col("avg_arr_delay").alias("avg_arr_delay_min"),
        F.col("avg_dep_delay").alias("avg_dep_delay_min"),
        "total_flights", "cancelled_flights",
        percent("cancel_rate", 2).alias("cancel_rate_pct"),
        "routes_operated",
    ).orderBy(up("Year"), up("Month"))


def top_delay_routes(performance: DataFrame) -> DataFrame:
    """Routes by mean arrival delay. Means are over months, not weighted by flights."""
    late, operated = F.sum("delayed_flights"), F.sum("operated_flights")
    causes = {
        "avg_arr_delay_min": "avg_arr_delay_min", "avg_carrier_delay_min": "avg_carrier_delay",
        "avg_weather_delay_min": "avg_weather_delay", "avg_nas_delay_min": "avg_nas_delay",
        "avg_late_ac_delay_min": "avg_late_ac_delay",
    }
    return performance.groupBy("Route", "Dest").agg(
        operated.alias("total_operated"), late.alias("total_delayed"),
        percent(ratio(late, operated), 1).alias("delay_rate_pct"),
        percent(ratio(operated - late, operated), 1).alias("otp_pct"),
        *[mean(source, 1).alias(name) for name, source in causes.items()],
        percent(F.avg("cancel_rate"), 2).alias("avg_cancel_rate_pct"),
    ).orderBy(down("avg_arr_delay_min"), up("Route"), up("Dest"))


def capacity_efficiency(utilization: DataFrame) -> DataFrame:
    """Completion loss and the 60/40 score of load factor and punctuality, per route and month."""
    flown = F.col("DepPerformed").cast("double") / nullif_zero("DepScheduled")
    score = F.col("LoadFactor") * F.lit(0.6) + F.col("otp_rate") * F.lit(0.4)
    return utilization.where(F.col("LoadFactor").isNotNull()).select(
        "Route", "YearMonth", "Year", "Month", "DepScheduled", "DepPerformed",
        percent(F.lit(1.0) - flown, 2).alias("completion_factor_loss_pct"),
        "Seats", "Passengers",
        percent("LoadFactor", 1).alias("load_factor_pct"),
        percent("otp_rate", 1).alias("otp_pct"),
        "avg_arr_delay_min", "cancel_rate",
        percent(score, 1).alias("efficiency_score"),
    ).orderBy(up("Route"), up("YearMonth"))


def season_comparison(utilization: DataFrame) -> DataFrame:
    known = utilization.where(F.col("LoadFactor").isNotNull() & F.col("otp_rate").isNotNull())
    return known.groupBy("Route", season("Month", LONG_SEASONS).alias("season")).agg(
        percent(F.avg("LoadFactor"), 1).alias("avg_lf_pct"),
        percent(F.min("LoadFactor"), 1).alias("min_lf_pct"),
        percent(F.max("LoadFactor"), 1).alias("max_lf_pct"),
        percent(F.avg("otp_rate"), 1).alias("avg_otp_pct"),
        F.sum("Passengers").alias("total_passengers"),
        F.sum("Seats").alias("total_seats"),
    ).orderBy(up("Route"), down("avg_lf_pct"), up("season"))


def weather_category(severity: str) -> Column:
    s = F.col(severity)
    return first_match([(s >= 4.0, "Severe"), (s >= 2.0, "Moderate"), (s >= 0.5, "Light")], "Clear")


def weather_by_month(impact: DataFrame) -> DataFrame:
    return impact.select(
        "Route", "Year", "Month", year_month("Year", "Month").alias("YearMonth"),
        "avg_weather_severity", "thunderstorm_count", "precipitation_count", "low_vis_count",
        "wind_gust_count",
        percent("otp_rate", 1).alias("otp_pct"),
        F.col("avg_arr_delay").alias("avg_arr_delay_min"), "total_flights",
        weather_category("avg_weather_severity").alias("weather_category"),
    ).orderBy(up("Year"), up("Month"), up("Route"))


def worst_weather_months(impact: DataFrame, k: int = 20) -> DataFrame:
    """Months by flight-weighted severity."""
    weighted = ratio(
        F.sum(F.col("avg_weather_severity") * F.col("total_flights")), F.sum("total_flights")
    )
    return impact.groupBy("Year", "Month").agg(
        year_month("Year", "Month").alias("YearMonth"),
        # Rounded where it is compared: the order must not depend on the order of summing.
        rounded(weighted, 8).alias("weighted_severity"),
        percent(F.avg("otp_rate"), 1).alias("avg_otp_pct"),
        F.sum("thunderstorm_count").alias("total_thunderstorms"),
        F.sum("precipitation_count").alias("total_precipitation"),
        F.sum("total_flights").alias("network_flights"),
    ).orderBy(down("weighted_severity"), up("Year"), up("Month")).limit(k)


# ---- canned answers -----------------------------------------------------------------------------

def _routes_by_otp(performance: DataFrame, name: str) -> DataFrame:
    return performance.groupBy("Route").agg(
        percent(F.avg("otp_rate"), 1).alias(name),
        mean("avg_arr_delay_min", 1).alias("avg_delay_min"),
        F.sum("operated_flights").alias("total_flights"),
    )


def worst_otp_routes(performance: DataFrame, k: int = 10) -> DataFrame:
    return _routes_by_otp(performance, "otp_pct").orderBy(up("otp_pct"), up("Route")).limit(k)


def best_otp_routes(performance: DataFrame, k: int = 10) -> DataFrame:
    return _routes_by_otp(performance, "otp_pct").orderBy(down("otp_pct"), up("Route")).limit(k)


def december_by_route(performance: DataFrame) -> DataFrame:
    december = performance.where(F.col("Month") == 12)
    return _routes_by_otp(december, "avg_otp_pct").orderBy(up("avg_otp_pct"), up("Route"))


def one_route_over_time(performance: DataFrame, route: str = fv.DEFAULT_ROUTE) -> DataFrame:
    return performance.where(F.col("Route") == route).select(
        "Year", "Month",
        percent("otp_rate", 1).alias("otp_pct"),
        rounded("avg_arr_delay_min", 1).alias("avg_delay_min"),
        "operated_flights", "delayed_flights",
    ).orderBy(up("Year"), up("Month"))


def delay_causes_by_route(causes: DataFrame, k: int = 10) -> DataFrame:
    return causes.groupBy("Route").agg(*[
        mean(f"avg_{c}_delay", 1).alias(f"{c}_delay_avg")
        for c in ("carrier", "weather", "nas", "late_ac")
    ]).orderBy(down("carrier_delay_avg"), up("Route")).limit(k)


def latest_load_factors(utilization: DataFrame, k: int = 20) -> DataFrame:
    return utilization.where(F.col("LoadFactor").isNotNull()).select(
        "Route", "YearMonth",
        percent("LoadFactor", 1).alias("load_factor_pct"),
        percent("otp_rate", 1).alias("otp_pct"), "Passengers", "Seats",
    ).orderBy(down("YearMonth"), down("load_factor_pct"), up("Route")).limit(k)


def seasonal_load_factor(utilization: DataFrame) -> DataFrame:
    known = utilization.where(F.col("LoadFactor").isNotNull())
    return known.groupBy("Route", season("Month", SHORT_SEASONS).alias("season")).agg(
        percent(F.avg("LoadFactor"), 1).alias("avg_lf_pct"),
        percent(F.avg("otp_rate"), 1).alias("avg_otp_pct"),
    ).orderBy(up("Route"), up("season"))


def weather_by_route(impact: DataFrame) -> DataFrame:
    return impact.groupBy("Route").agg(
        mean("avg_weather_severity", 2).alias("avg_severity"),
        F.sum("thunderstorm_count").alias("thunderstorms"),
        percent(F.avg("otp_rate"), 1).alias("avg_otp_pct"),
        mean("avg_arr_delay", 1).alias("avg_delay_min"),
    ).orderBy(down("avg_severity"), up("Route"))


def monthly_trend(summary: DataFrame) -> DataFrame:
    return summary.orderBy(up("Year"), up("Month")).select(
        "YearMonth", percent("network_otp", 1).alias("otp_pct"),
        rounded("avg_arr_delay", 1).alias("avg_delay_min"), "total_flights", "cancelled_flights",
    )


def result_summary(report: DataFrame) -> DataFrame:
    """Rows, and the range of the first numeric column, of any report."""
    numeric = [n for n, t in report.dtypes if t.split("(")[0] in NUMERIC_TYPES]
    if not numeric:
        return report.agg(
            F.count("*").alias("n_rows"), F.lit(None).cast("string").alias("column_name"),
            F.lit(None).cast("double").alias("min_value"),
            F.lit(None).cast("double").alias("max_value"),
        )
    c = F.col(f"`{numeric[0]}`")
    return report.agg(
        F.count("*").alias("n_rows"), F.lit(numeric[0]).alias("column_name"),
        F.min(c).cast("double").alias("min_value"), F.max(c).cast("double").alias("max_value"),
    )


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


# ---- export sheets ------------------------------------------------------------------------------

def _sheet(df: DataFrame, columns: dict[str, str | Column], *, sort: tuple[str, ...]) -> DataFrame:
    picked = [
        (F.col(source) if isinstance(source, str) else source).alias(header)
        for header, source in columns.items()
    ]
    return df.select(*picked).orderBy(*[up(f"`{c}`") for c in sort])


_BY_ROUTE_MONTH = ("Route", "Year", "Month")


def sheet_otp_monthly(performance: DataFrame) -> DataFrame:
    return _sheet(performance, {
        "Route": "Route", "Year": "Year", "Month": "Month",
        "Year-Month": year_month("Year", "Month"),
        "Total Flights": "total_flights", "Operated Flights": "operated_flights",
        "Cancelled Flights": "cancelled_flights", "Cancel Rate %": percent("cancel_rate", 2),
        "Delayed Flights (15+ min)": "delayed_flights", "OTP %": percent("otp_rate", 2),
        "Avg Arrival Delay (min)": rounded("avg_arr_delay_min", 1),
        "Avg Departure Delay (min)": rounded("avg_dep_delay_min", 1),
    }, sort=_BY_ROUTE_MONTH)


def sheet_delay_causes(causes: DataFrame) -> DataFrame:
    titles = {
        "carrier": "Carrier", "weather": "Weather", "nas": "NAS", "late_ac": "Late Aircraft",
        "security": "Security",
    }
    columns = {
        "Route": "Route", "Year": "Year", "Month": "Month",
        "Year-Month": year_month("Year", "Month"), "Delayed Flights": "delayed_count",
    }
    for c, title in titles.items():
        columns[f"Avg {title} Delay (min)"] = rounded(f"avg_{c}_delay", 1)
    for c, title in titles.items():
        if c != "security":
            columns[f"{title} Delay %"] = percent(f"{c}_delay_pct", 1)
    return _sheet(causes, columns, sort=_BY_ROUTE_MONTH)


def sheet_load_factor(utilization: DataFrame) -> DataFrame:
    return _sheet(utilization.where(F.col("LoadFactor").isNotNull()), {
        "Route": "Route", "Year": "Year", "Month": "Month", "Year-Month": "YearMonth",
        "Scheduled Departures": "DepScheduled", "Performed Departures": "DepPerformed",
        "Available Seats": "Seats", "Passengers": "Passengers",
        "Load Factor %": percent("LoadFactor", 2), "OTP %": percent("otp_rate", 2),
        "Avg Arrival Delay (min)": rounded("avg_arr_delay_min", 1),
    }, sort=_BY_ROUTE_MONTH)


def sheet_weather_impact(impact: DataFrame) -> DataFrame:
    return _sheet(impact, {
        "Route": "Route", "Year": "Year", "Month": "Month",
        "Year-Month": year_month("Year", "Month"), "Total Flights": "total_flights",
        "Avg Weather Severity (0-10)": rounded("avg_weather_severity", 2),
        "Thunderstorm Flights": "thunderstorm_count",
        "Precipitation Flights": "precipitation_count",
        "Low Visibility Flights": "low_vis_count", "High Wind Flights": "wind_gust_count",
        "OTP %": percent("otp_rate", 2), "Avg Arrival Delay (min)": rounded("avg_arr_delay", 1),
    }, sort=_BY_ROUTE_MONTH)


def sheet_scenario_summary(comparison: DataFrame) -> DataFrame:
    return _sheet(comparison, {
        "Route": "Route", "Schedule Strategy": "Scenario", "Schedule": "Schedule",
        "Flights Before": "Daily_Flights_Before", "Flights After": "Daily_Flights_After",
        "Baseline LF %": "`Baseline_LF_%`", "Projected LF %": "`Projected_LF_%`",
        "LF Change (pp)": "LF_Change_pp", "LF P10 %": "`LF_P10_%`", "LF P90 %": "`LF_P90_%`",
        "Baseline OTP %": "`Baseline_OTP_%`", "Projected OTP %": "`Projected_OTP_%`",
        "OTP Change (pp)": "OTP_Change_pp",
        "Annual Revenue Delta ($M)": "`Annual_Revenue_Delta_M$`",
        "Revenue P10 ($M)": "`Rev_P10_M$`", "Revenue P90 ($M)": "`Rev_P90_M$`",
        "Recommendation": "Recommendation",
    }, sort=("Route", "Schedule"))


def sheet_demand_forecast(forecast: DataFrame) -> DataFrame:
    return _sheet(forecast, {
        "Route": "route", "Forecast Month": "period", "Forecast Passengers": "forecast_passengers",
        "Lower Bound (80% CI)": "lower_80", "Upper Bound (80% CI)": "upper_80",
        "Lower Bound (95% CI)": "lower_95", "Upper Bound (95% CI)": "upper_95",
        "Forecast Seats": "forecast_seats", "Forecast Load Factor": "forecast_lf",
    }, sort=("Route", "Forecast Month"))


def sheet_metadata(flights: DataFrame, sheets: dict[str, str]) -> DataFrame:
    """Field and value: the data's range and routes, and one row per exported sheet."""
    fixed = F.array(*[
        F.struct(F.lit(name).alias("Field"), F.lit(text).alias("Value"))
        for name, text in sheets.items()
    ])
    found = flights.agg(
        F.min("FlightDate").alias("first"), F.max("FlightDate").alias("last"),
        F.count_distinct("Route").alias("routes"), F.count("*").alias("flights"),
    )
    span = F.concat(
        F.date_format("first", "yyyy-MM-dd"), F.lit(" to "), F.date_format("last", "yyyy-MM-dd")
    )
    computed = F.array(*[
        F.struct(F.lit(name).alias("Field"), value.cast("string").alias("Value"))
        for name, value in (
            ("Data Range", span), ("Routes", F.col("routes")), ("Flights", F.col("flights"))
        )
    ])
    return found.select(F.inline(F.concat(computed, fixed)))
