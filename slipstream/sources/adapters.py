"""Flight-shaped views of order and event tables.

The operators take flight tables; these projections give the same shape to a star schema of order
lines and to an event log. The dimension joins are written so that each big table is shuffled once
per key; only ``nation`` (25 rows) and ``region`` (5 rows) are broadcast, the size of the others
decides for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.operators.cleaning import clean_capacity, clean_flights, clean_weather
from slipstream.schemas import TABLES

SHIPMENT_TIE_BREAK = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
)
LEG_TIE_BREAK = ("event_id",)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def shipments_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One flight per order line; route = supplier nation - customer region."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, folder, "lineitem")

    regions = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
    targets = customer.join(
        F.broadcast(regions.select("n_nationkey", "r_regionkey", F.col("r_name").alias("Dest"))),
        F.col("c_nationkey") == F.col("n_nationkey"),
    ).select("c_custkey", "r_regionkey", "Dest")
    order_target = orders.join(targets, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "r_regionkey", "Dest"
    )
    sources = supplier.join(
        F.broadcast(nation.select("n_nationkey", F.col("n_name").alias("Origin"))),
        F.col("s_nationkey") == F.col("n_nationkey"),
    ).select("s_suppkey", "n_nationkey", "Origin")
    joined = lines.join(order_target, F.col("l_orderkey") == F.col("o_orderkey")).join(
        sources, F.col("l_suppkey") == F.col("s_suppkey")
    )

    return joined.withColumn(
        "_cx", F.expr("coalesce(l_returnflag = 'R' and l_orderkey % 10 = 0, false)")
    ).selectExpr(
        "cast(l_shipdate as date) as FlightDate", "l_suppkey as Tail_Number", "Origin", "Dest",
        "concat(Origin, '-', Dest) as Route",
        "int(l_partkey % 24 * 100 + l_orderkey % 60) as CRSDepTime",
        "int(_cx) as Cancelled",
        "case when not _cx then (l_quantity - 36) * 45 end as DepDelay",
        "case when not _cx then (l_quantity - 36) * 45 - l_orderkey % 5 end as ArrDelay",
        "int(not _cx and (l_quantity - 36) * 45 - l_orderkey % 5 >= 15) as ArrDel15",
        "case when not _cx then double(l_partkey % 30) end as CarrierDelay",
        "case when not _cx then double(l_suppkey % 20) end as WeatherDelay",
        "case when not _cx then double(l_linenumber) end as NASDelay",
        "case when not _cx then double(l_orderkey % 3) end as SecurityDelay",
        "case when not _cx and l_partkey % 7 <> 0 then l_quantity end as LateAircraftDelay",
        "int(100 + n_nationkey * 90 + r_regionkey * 20) as Distance",
        "case when not _cx then (100 + n_nationkey * 90 + r_regionkey * 20) / 8.0D + 30 end"
        " as AirTime",
        *SHIPMENT_TIE_BREAK,
    )


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned flights from order lines."""
    return clean_flights(shipments_raw(spark, folder))


def legs_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One leg per event; the user is the vehicle."""
    return table(spark, folder, "events").selectExpr(
        "*",
        "coalesce(event_type = 'error' and event_id % 20 = 0, false) as _cx",
        "double(floor(value)) - 20.0D as _dep",
    ).selectExpr(
        "event_id", "user_id as Tail_Number", "cast(ts as date) as FlightDate",
        "hour(ts) * 100 as CRSDepTime", "'HUB' as Origin", "event_type as Dest",
        "concat('HUB-', event_type) as Route", "int(_cx) as Cancelled",
        "case when not _cx then _dep end as DepDelay",
        "case when not _cx then _dep - event_id % 7 end as ArrDelay",
        "int(coalesce(not _cx and _dep - event_id % 7 >= 15, false)) as ArrDel15",
        "case when not _cx then double(25 + event_id % 276) end as AirTime",
    )


def legs(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned legs from events."""
    return clean_flights(legs_raw(spark, folder))


def weather_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather from the number of events per hour, with hours left out on purpose."""
    hourly = (
        table(spark, folder, "events")
        .groupBy(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("valid"))
        .agg(F.count("*").alias("n"))
        .where((F.dayofmonth("valid") * 24 + F.hour("valid")) % 11 != 0)
    )
    return hourly.selectExpr(
        "valid", "'HUB' as station", "double(n + 40) as tmpf", "double(n - 10) as sknt",
        "double(n % 5) / 10.0D as p01i", "double(n % 12) as vsby",
        "case when n % 4 <> 0 then double(n * 2) end as gust",
        "case when n % 6 = 0 then 'TSRA' when n % 3 = 0 then 'RA' else '' end as wxcodes",
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return clean_weather(weather_raw(spark, folder))


def capacity_raw(flights: DataFrame, key: str = "Route") -> DataFrame:
    """Monthly capacity per route (or origin) from cleaned shipments; quantities are passengers."""
    monthly = flights.groupBy(F.col(key).alias("Route"), "Year", "Month").agg(
        F.count("*").alias("DepScheduled"),
        F.sum(1 - F.col("Cancelled")).alias("DepPerformed"),
        (F.count("*") * 60).alias("Seats"),
        F.sum(F.col("l_quantity").cast("long")).alias("Passengers"),
    )
    return monthly.withColumns({
        "YearMonth": F.format_string("%d-%02d", "Year", "Month"),
        "LoadFactor": F.col("Passengers").cast("double") / F.col("Seats"),
    })


def capacity(flights: DataFrame, key: str = "Route") -> DataFrame:
    return clean_capacity(capacity_raw(flights, key))
