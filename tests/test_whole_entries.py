"""Entries that cover all routes and all report tables, but the simulator's."""

from __future__ import annotations

import datetime

from check_queries import oracle, rows_of

import __spark_entry__ as entry
from slipstream.operators import features
from slipstream.registry import base, feature_queries, report_queries
from slipstream.sources import adapters

BUILDERS = entry.queries()


def test_route_features_know_every_route(spark, small):
    got = BUILDERS["p16_p17_j4_route_features"](spark, small).collect()
    want = oracle(small).execute(base.with_sql(base.SHIPMENTS) + f"""
        select "Route", max("Distance"), {base.rnd('avg(1 - "ArrDel15")', 4)},
            {base.rnd('max("Distance")::double / (select max("Distance") from flights)', 6)}, count(*)
        from flights group by 1""").fetchall()
    assert any(len(r[0]) % 2 for r in want)
    assert sorted(
        (r.Route, r.route_distance, r.route_otp_baseline, r.distance_normalised, r.n) for r in got
    ) == sorted(want)


def test_route_missing_from_lookup(spark):
    flights = spark.createDataFrame([("a", "x", 300), ("bc", "x", 1600)], "Route string, Dest string, Distance int")
    lookup = spark.createDataFrame([("a", 500, 0.9)], "route string, distance int, base_otp double")
    a, b = features.add_route_features(flights, lookup).orderBy("Route").collect()
    assert (a.route_distance, a.route_otp_baseline, a.distance_normalised) == (500.0, 0.9, 1.0)
    assert (b.route_distance, b.route_otp_baseline, b.is_long_haul) == (1600.0, 0.75, 1)


def test_export_writes_all_reports(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(feature_queries, "_scratch", lambda s, name: str(tmp_path))
    assert BUILDERS["s8_export_reports"](spark, small).count() == adapters.shipments(spark, small).select("Route").distinct().count()
    names = {"otp_monthly", "delay_causes", "load_factor", "weather_impact", "demand_forecast", "metadata"}
    assert {p.name for p in tmp_path.iterdir()} == names | {"per_route"}
    for name in names:
        got, want = spark.read.parquet(str(tmp_path / name)), BUILDERS[feature_queries.EXPORTED[name]](spark, small)
        assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect()) and got.count() > 0


def test_metadata_lists_the_exported_tables(spark, small):
    rows = dict(BUILDERS["s9_export_metadata"](spark, small).collect())
    assert set(feature_queries.EXPORTED) - {"metadata"} == set(rows) - {"Data Range", "Routes", "Flights"}
    assert rows["weather_impact"] == report_queries.SHEETS["weather_impact"]
    first, last = rows["Data Range"].split(" to ")
    assert datetime.date.fromisoformat(first) <= datetime.date.fromisoformat(last)


def test_export_makes_its_flights_once(spark, small, monkeypatch):
    calls = []
    shipments = adapters.shipments
    monkeypatch.setattr(adapters, "shipments", lambda s, d: calls.append(d) or shipments(s, d))
    assert BUILDERS["s8_export_reports"](spark, small).count() > 0
    assert calls == [small]
