"""Tables and views under names, for SQL and for reports by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from slipstream.plans import reports, views


def register_views(
    spark: SparkSession, flights: DataFrame, capacity: DataFrame, weather: DataFrame
) -> dict[str, DataFrame]:
    """Register the three tables and the five views as temporary views and return them.

    ``flights`` must carry its weather columns. A definition that does not resolve raises.
    """
    performance = views.route_performance(flights)
    tables = {
        "flights": flights,
        "capacity": capacity,
        "weather": weather,
        "route_performance": performance,
        "monthly_otp_summary": views.monthly_otp_summary(flights),
        "delay_cause_decomposition": views.delay_cause_decomposition(flights),
        "capacity_utilization": views.capacity_utilization(capacity, performance),
        "weather_impact": views.weather_impact(flights),
    }
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


# Report of each question intent, with the view it reads.
INTENT_REPORTS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "worst_otp_routes": ("route_performance", reports.worst_otp_routes),
    "delay_causes_by_route": ("delay_cause_decomposition", reports.delay_causes_by_route),
    "latest_load_factors": ("capacity_utilization", reports.latest_load_factors),
    "seasonal_load_factor": ("capacity_utilization", reports.seasonal_load_factor),
    "weather_by_route": ("weather_impact", reports.weather_by_route),
    "monthly_trend": ("monthly_otp_summary", reports.monthly_trend),
    "december_by_route": ("route_performance", reports.december_by_route),
    "one_route_over_time": ("route_performance", reports.one_route_over_time),
    "best_otp_routes": ("route_performance", reports.best_otp_routes),
}


def report_for(tables: dict[str, DataFrame], intent: str, **options) -> DataFrame:
    view, build = INTENT_REPORTS[intent]
    return build(tables[view], **options)


def run_sql(spark: SparkSession, text: str) -> tuple[DataFrame | None, str]:
    """Analyse a query; (result, "") or (None, message).

    The text is parsed as a subquery, so that the parser itself refuses everything that is not a
    query (insertions also behind WITH or FROM, definitions, settings) before anything runs.
    """
    try:
        return spark.sql("SELECT * FROM (\n" + text.strip().rstrip(";") + "\n)"), ""
    except PySparkException as error:
        return None, str(error)
