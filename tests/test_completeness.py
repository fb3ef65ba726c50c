"""Results keep every key and row, and reads cannot write."""

from __future__ import annotations

import pytest

from slipstream.operators import ordered, weather_join, whatif
from slipstream.plans import catalog


def test_inserts_are_refused(spark):
    spark.sql("create table if not exists kept_rows (a int) using parquet")
    before = spark.table("kept_rows").count()
    for text in ("with x as (select 1 as a) insert into kept_rows select a from x",
                 "from values (2) as v(a) insert into kept_rows select a"):
        result, error = catalog.run_sql(spark, text)
        assert result is None and error
    assert spark.table("kept_rows").count() == before


@pytest.mark.parametrize("few", [True, False])
def test_percentiles_keep_keys_without_values(spark, few):
    rows = [("x", 1.0), ("x", 3.0), ("x", None), ("y", None), (None, 2.0)]
    found = ordered.percentiles(
        spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"p": 0.5}, few_values=few
    )
    assert {r.k: r.p for r in found.collect()} == {"x": 2.0, "y": None, None: 2.0}


def test_scenarios_are_accepted_or_rejected(spark):
    rows = [(1, "A-B", 1, 10), (2, "A-B", 1, 0), (3, "A-B", None, 10), (4, "A-B", -9, 10), (5, "Z-Z", 1, 10), (6, "A-B", 1, None)]
    scenarios = spark.createDataFrame(
        rows, "scenario_id long, route string, additional_daily_flights int, simulation_runs int"
    )
    routes = spark.createDataFrame([("A-B", 500.0, 0.8, 0.7, 5)], "route string, distance double, base_lf double, base_otp double, daily_flights int")
    prepared = whatif.prepare_scenarios(scenarios, routes)
    good = {r.scenario_id for r in whatif.accepted(prepared).collect()}
    bad = {r.scenario_id: r.reject_reason for r in whatif.rejected(prepared).collect()}
    assert good == {1, 6} and set(bad) == {2, 3, 4, 5}
    assert bad[2] == "no runs" and bad[3] == "no flight change given"


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_weather_ties_are_settled(spark, parts):
    rows = [("2024-01-01 05:10:00", "B", 1.0), ("2024-01-01 05:10:00", "A", 9.0), ("2024-01-01 05:10:00", "B", 4.0), ("2024-01-01 05:00:00", "C", 7.0)]
    frame = spark.createDataFrame(rows, "valid string, station string, vsby double").selectExpr(
        "cast(valid as timestamp) valid", "station", "vsby").repartition(parts)
    assert [r.vsby for r in weather_join.hourly_weather(frame).collect()] == [4.0]
