"""Punctuality per day and route kept up to date from arriving files.

Flights are added up per event-time day and route. A day is final once the latest event seen is
``delay`` past its end: it is then written once and its state goes, so the state holds the open days
only, however long the stream has run. ``advance`` works off the files that have come since the last
call and stops (``availableNow``); progress and state are in the checkpoint folder, so a call after
a lost driver goes on where the last finished batch ended, and the sink's log keeps each day from
being written twice. Rows later than the delay are dropped and counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_TIME = "event_time"
DELAY = "2 days"


def daily_totals(flights: DataFrame, delay: str | None = DELAY) -> DataFrame:
    """Rows, cancellations, operated and punctual flights and arrival minutes per day and route.

    ``flights`` needs event_time (an instant; days are those of UTC), Route, Cancelled, ArrDel15 and ArrDelay, and may be a
    stream or a table. Rows without a time belong to no day and are left out. ``delay`` None sets no
    watermark (tables).
    """
    flights = flights.where(F.col(EVENT_TIME).isNotNull())
    if delay is not None:
        flights = flights.withWatermark(EVENT_TIME, delay)
    return flights.groupBy(F.window(EVENT_TIME, "1 day").alias("_day"), "Route").agg(
        F.count("*").alias("total"),
        F.sum("Cancelled").alias("cancelled"),
        F.sum(F.expr("int(Cancelled = 0)")).alias("operated"),
        F.sum(F.expr("int(Cancelled = 0 and ArrDel15 = 0)")).alias("punctual"),
        F.sum(F.expr("case when Cancelled = 0 then ArrDelay end")).alias("arr_minutes"),
        F.count(F.expr("case when Cancelled = 0 then ArrDelay end")).alias("arr_known"),
    ).select(F.expr("date_from_unix_date(int(unix_seconds(_day.start) div 86400))").alias("day"), "Route", "total", "cancelled", "operated",
             "punctual", "arr_minutes", "arr_known")


@dataclass
class Increment:
    """What one ``advance`` did."""

    batches: int
    rows_read: int
    late_groups: int  # (day, route) groups of a batch that came after their day was final


def advance(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
    delay: str = DELAY, files_per_batch: int = 1000,
) -> Increment:
    """Work off the new Parquet files of ``source`` and append the days that became final to ``target``."""
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    running = (
        daily_totals(arriving, delay).writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint).option("path", target)
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    progress = running.recentProgress
    return Increment(
        len(progress), sum(p["numInputRows"] for p in progress),
        sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]),
    )


def final_days(spark: SparkSession, target: str) -> DataFrame:
    """The days written so far; the sink's log hides files of batches that did not finish."""
    return spark.read.parquet(target)


def monthly_summary(days: DataFrame) -> DataFrame:
    """Network-wide month from daily totals: the same figures as from the flights of those days."""
    per_route = days.groupBy(
        F.year("day").alias("Year"), F.month("day").alias("Month"), "Route"
    ).agg(*[F.sum(c).alias(c) for c in ("total", "cancelled", "operated", "punctual", "arr_minutes", "arr_known")])
    return per_route.groupBy("Year", "Month").agg(
        F.sum("total").alias("total_flights"), F.sum("cancelled").alias("cancelled_flights"),
        F.expr("cast(round(cast(sum(punctual) / nullif(sum(operated), 0) as decimal(28,10)), 4) as double)")
        .alias("network_otp"),
        F.expr("cast(round(cast(sum(arr_minutes) / nullif(sum(arr_known), 0) as decimal(28,10)), 2) as double)")
        .alias("avg_arr_delay"),
        F.count("*").alias("routes_operated"),
    )
