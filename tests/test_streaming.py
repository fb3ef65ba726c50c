from __future__ import annotations

import datetime as dt

from slipstream.streaming import daily

SCHEMA = "event_time timestamp, Route string, Cancelled int, ArrDel15 int, ArrDelay double"


def flight(day, hour, route="a", delay=0.0, cancelled=0):
    return (dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc), route, cancelled, int(delay >= 15), None if cancelled else delay)


FIRST = [flight(1, 5), flight(1, 9, delay=20.0), flight(1, 9, "b", cancelled=1), flight(2, 3), flight(6, 1)]
SECOND = [flight(1, 7, delay=99.0), flight(6, 2, delay=30.0), flight(7, 1), flight(12, 1), (None, "a", 0, 0, 1.0)]


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_two_deliveries_and_a_restart(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("source", "target", "progress"))
    deliver(spark, source, FIRST)
    schema = spark.createDataFrame([], SCHEMA).schema
    first = daily.advance(spark, source, schema, target, progress)
    assert (first.rows_read, first.late_groups) == (5, 0)
    days = {(r.day.day, r.Route) for r in daily.final_days(spark, target).collect()}
    assert days == {(1, "a"), (1, "b"), (2, "a")}
    again = daily.advance(spark, source, schema, target, progress)
    assert again.rows_read == 0
    deliver(spark, source, SECOND)
    second = daily.advance(spark, source, schema, target, progress)
    # The flight of day 1 comes after its day was final: dropped, and counted.
    assert (second.rows_read, second.late_groups) == (5, 1)
    got = sorted(tuple(r) for r in daily.final_days(spark, target).collect())
    timely = spark.createDataFrame(FIRST + SECOND[1:3], SCHEMA)
    want = sorted(tuple(r) for r in daily.daily_totals(timely, None).collect())
    assert got == want and len(got) == 5


def test_empty_source(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("source", "target", "progress"))
    deliver(spark, source, [])
    schema = spark.createDataFrame([], SCHEMA).schema
    assert daily.advance(spark, source, schema, target, progress).rows_read == 0


def test_month_from_days(spark):
    days = daily.daily_totals(spark.createDataFrame(FIRST, SCHEMA), None)
    (month,) = daily.monthly_summary(days).collect()
    assert (month.total_flights, month.cancelled_flights, month.routes_operated) == (5, 1, 2)
    assert (month.network_otp, month.avg_arr_delay) == (0.75, 5.0)
