"""Airport weather reports in JSON to flags and severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.functions.columns import clamp, flag
from slipstream.schemas import SNAPSHOT


def snapshot_severity(
    thunderstorm: Column, precipitation: Column, low_visibility: Column, gust: Column
) -> Column:
    """Severity of a report; rain counts only without a thunderstorm."""
    sky = F.when(thunderstorm, F.lit(4.5)).when(precipitation, F.lit(2.0)).otherwise(F.lit(0.0))
    points = sky + flag(low_visibility) * F.lit(2.5) + flag(gust) * F.lit(1.5)
    return clamp(points, 0.0, 10.0)


def parse_snapshots(reports: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace the JSON column by typed fields, condition flags and severity.

    Missing fields, and text that is not JSON, count as clear sky, 20 degrees, no wind and 10 km
    visibility.
    """
    doc = F.from_json(F.col(payload), SNAPSHOT)
    sky = F.get(F.col("_doc.weather"), F.lit(0))
    typed = reports.withColumn("_doc", doc).withColumns({
        "description": F.coalesce(sky["description"], F.lit("unknown")),
        "condition_id": F.coalesce(sky["id"], F.lit(800)),
        "temp_c": F.coalesce(F.col("_doc.main.temp"), F.lit(20.0)),
        "wind_speed_ms": F.coalesce(F.col("_doc.wind.speed"), F.lit(0.0)),
        "visibility_m": F.coalesce(F.col("_doc.visibility"), F.lit(10000)),
    })
    code = F.col("condition_id")
    thunder, rain = code.between(200, 299), code.between(300, 699)
    low, gust = F.col("visibility_m") < 4800, F.col("wind_speed_ms") > 12.0
    return typed.withColumns({
        "thunderstorm": thunder, "precipitation": rain, "low_visibility": low, "wind_gust": gust,
        "severity": snapshot_severity(thunder, rain, low, gust),
    }).drop("_doc", payload)
