from __future__ import annotations

from slipstream import schemas
from slipstream.operators import cleaning
from slipstream.sources import rejects

HEADER = ",".join(f.name for f in schemas.FLIGHTS_RAW)


def line(**values):
    given = {"FlightDate": "2024-01-05", "Origin": "FLL", "Dest": "ATL", "Route": "FLL-ATL"} | values
    return ",".join(str(given.get(f.name, "")) for f in schemas.FLIGHTS_RAW)


def read(spark, tmp_path, lines):
    path = tmp_path / "flights.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    rows = rejects.read_permissive(spark, str(path), schemas.FLIGHTS_RAW)
    return rejects.split(rows, cleaning.FLIGHT_KEYS, cleaning.FLIGHT_MEASURES)


def test_every_row_leaves_once_with_its_reason(spark, tmp_path):
    accepted, rejected = read(spark, tmp_path, [
        line(ArrDelay="5"), line(ArrDelay="late", DepDelay="x"), line(Route=""), line(Origin="", Dest=""),
        line(FlightDate="someday"), "only,three,fields", line(), line(),
    ])
    assert accepted.count() == 4
    assert sorted(r.reject_reason for r in rejected.collect()) == [
        "no Origin", "no Route", "unreadable line", "unreadable line"]
    assert [r.raw_line for r in rejected.where("raw_line like 'only%'").collect()] == ["only,three,fields"]
    assert sorted(tuple(r.bad_numbers) for r in accepted.collect())[-1] == ("DepDelay", "ArrDelay")
    # The cleaning step drops none of the accepted rows, and nulls the bad numbers.
    cleaned = cleaning.clean_flights(accepted)
    assert cleaned.count() == 4 and cleaned.where("ArrDelay = 5").count() == 1
    counts = {(r.outcome, r.detail): r.n for r in rejects.summary(accepted, rejected).collect()}
    assert counts == {
        ("accepted", None): 4, ("rejected", "no Route"): 1, ("rejected", "no Origin"): 1,
        ("rejected", "unreadable line"): 2, ("bad number", "ArrDelay"): 1, ("bad number", "DepDelay"): 1}


def test_empty_file(spark, tmp_path):
    accepted, rejected = read(spark, tmp_path, [])
    assert (accepted.count(), rejected.count()) == (0, 0)
    assert accepted.columns == [*[f.name for f in schemas.FLIGHTS_RAW], "bad_numbers"]
