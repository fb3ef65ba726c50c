from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.operators import intent, snapshots, staging
from slipstream.plans import catalog, reports, views
from slipstream.sources import adapters as ad
from slipstream.sources import readers, sinks

WEATHER_CSV = """valid,station,tmpf,dwpf,drct,sknt,p01i,vsby,gust,skyc1,wxcodes
2023-06-15 00:00:00,H,80.1,70,90,5,M,10,,CLR,
2023-06-15 01:00:00,H,,,,,0.2,1.5,30,OVC,TSRA
"""


def test_weather_csv(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text(WEATHER_CSV)
    a, b = readers.read_weather(spark, str(path)).orderBy("valid").collect()
    assert a.valid == dt.datetime(2023, 6, 15)
    assert (a.p01i, a.gust, a.wxcodes, b.tmpf, b.wxcodes) == ("M", None, None, None, "TSRA")


def test_csv_with_other_columns_fails(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text(WEATHER_CSV.replace("station,tmpf", "tmpf,station"))
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_weather(spark, str(path)).collect()


def test_partitioned_write_prunes(spark, small, tmp_path):
    from conftest import executed_plan_of

    path = str(tmp_path / "flights")
    flights = ad.shipments(spark, small)
    sinks.write_parquet(flights, path, ["Year", "Month"])
    back = readers.read_parquet(spark, path)
    assert back.count() == flights.count()
    plan = executed_plan_of(back.where("Year = 1996 and DepDelay > 5").select("Route"))
    assert "PartitionFilters: [isnotnull(Year" in plan
    assert "PushedFilters: [IsNotNull(DepDelay), GreaterThan(DepDelay,5.0)]" in plan
    assert "ReadSchema: struct<Route:string,DepDelay:double>" in plan


def test_export(spark, tmp_path):
    df = spark.range(3).select(F.col("id").alias("Cancel Rate %"))
    paths = sinks.export_reports({"a": df, "b": df}, str(tmp_path / "x"))
    assert [spark.read.parquet(p).count() for p in paths] == [3, 3]
    (csv,) = sinks.export_reports({"a": df}, str(tmp_path / "y"), "csv")
    assert spark.read.option("header", True).csv(csv).columns == ["Cancel Rate %"]
    with pytest.raises(ValueError):
        sinks.export_reports({}, "x", "xlsx")


def test_stage_writes_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5))
    assert all(folder in f for f in staged.inputFiles())
    assert staged.count() == 5


def test_adapter_reads_only_needed_columns(spark, small):
    from conftest import executed_plan_of

    plan = executed_plan_of(ad.shipments(spark, small).groupBy("Route").count())
    line = next(x for x in plan.splitlines() if "lineitem.parquet" in x)
    assert "l_extendedprice" not in line.split("ReadSchema")[1]


@pytest.mark.parametrize("text, report", [
    ("What are the WORST OTP routes?", "worst_otp_routes"),
    ("on-time by\nroute", fv.DEFAULT_INTENT),             # a line feed ends the search
    ("on time by   route", "worst_otp_routes"),      # other separators do not
    ("weather and load factor", "latest_load_factors"),   # the first pattern wins
    ("December trend", "monthly_trend"), ("peak season", "seasonal_load_factor"),
    ("holiday rush", "december_by_route"), ("fll-atl", "one_route_over_time"),
    ("hello", fv.DEFAULT_INTENT), (None, fv.DEFAULT_INTENT),
])
def test_intents(spark, text, report):
    df = spark.createDataFrame([(text,)], "text string")
    assert intent.tag_intent(df).first().intent == report


def test_every_intent_has_a_report():
    named = {r for _, r in fv.INTENT_PATTERNS} | {fv.DEFAULT_INTENT}
    assert named == set(catalog.INTENT_REPORTS)


@pytest.mark.parametrize("payload, want", [
    ('{"weather":[{"id":211,"description":"storm"}],"main":{"temp":3.5},'
     '"wind":{"speed":12.5},"visibility":4799}', ("storm", True, False, True, True, 8.5)),
    ('{"weather":[{"id":500}],"wind":{"speed":12},"visibility":4800}',
     ("unknown", False, True, False, False, 2.0)),
    ('{"weather":[]}', ("unknown", False, False, False, False, 0.0)),
    ("{}", ("unknown", False, False, False, False, 0.0)),
    ("no json", ("unknown", False, False, False, False, 0.0)),
    (None, ("unknown", False, False, False, False, 0.0)),
])
def test_snapshots(spark, payload, want):
    df = spark.createDataFrame([("H", payload)], "airport string, payload string")
    r = snapshots.parse_snapshots(df).first()
    assert (r.description, r.thunderstorm, r.precipitation, r.low_visibility, r.wind_gust,
            r.severity) == want


def test_catalog(spark, small):
    flights = ad.shipments(spark, small).withColumns({
        c: F.lit(0) for c in (
            "weather_severity", "thunderstorm_flag", "precipitation_flag", "low_visibility_flag",
            "wind_gust_flag")})
    tables = catalog.register_views(
        spark, flights, ad.capacity(flights), ad.weather(spark, small))
    assert len(tables) == 8
    df, error = catalog.run_sql(spark, "select count(*) n from route_performance;")
    assert error == "" and df.first().n > 0
    assert catalog.run_sql(spark, "select nothing from route_performance")[0] is None
    for text in ("drop view route_performance", "create view w as select 1", "set a=b", "select 1) x; drop view w --"):
        result, error = catalog.run_sql(spark, text)
        assert result is None and error
    assert catalog.run_sql(spark, "with x as (select 1 as a) select a from x -- last")[0].collect()[0].a == 1
    assert catalog.report_for(tables, "one_route_over_time").columns[0] == "Year"
    best = catalog.report_for(tables, "best_otp_routes", k=3)
    assert best.count() == 3
    summary = reports.result_summary(best).first()
    assert (summary.n_rows, summary.column_name) == (3, "otp_pct")
    with pytest.raises(Exception):
        catalog.register_views(spark, flights.drop("Route"), tables["capacity"], flights)


def test_months_without_flights_or_departures(spark):
    cap = spark.createDataFrame(
        [("A", 2023, 1, "2023-01", 0, 0, 0, 0, None), ("B", 2023, 1, "2023-01", 4, 3, 9, 8, 0.9)],
        "Route string, Year int, Month int, YearMonth string, DepScheduled int, DepPerformed int, "
        "Seats int, Passengers int, LoadFactor double")
    flights = spark.createDataFrame(
        [("A", "X", "Y", 2023, 1, 5, 1, 0, None, None, None, None, None, None, None)],
        "Route string, Origin string, Dest string, Year int, Month int, Distance int, "
        "Cancelled int, ArrDel15 int, ArrDelay double, DepDelay double, CarrierDelay double, "
        "WeatherDelay double, NASDelay double, SecurityDelay double, LateAircraftDelay double")
    performance = views.route_performance(flights)
    r = performance.first()
    assert (r.total_flights, r.operated_flights, r.otp_rate, r.cancel_rate) == (1, 0, None, 1.0)
    used = views.capacity_utilization(cap, performance)
    assert {x.Route: x.operated_flights for x in used.collect()} == {"A": 0, "B": None}
    assert [x.Route for x in reports.capacity_efficiency(used).collect()] == ["B"]
    c = views.delay_cause_decomposition(flights).first()
    assert (c.delayed_count, c.carrier_delay_pct) == (0, None)
    assert reports.top_delay_routes(performance).first().delay_rate_pct is None
