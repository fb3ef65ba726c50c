"""Schemas of the raw files and of the tables other modules produce."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _INT, _DBL = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Measures are read as text and turned into numbers by the cleaning step, so that one bad value
# becomes a missing value and not a failed or dropped row.
FLIGHTS_RAW = _struct(
    ("FlightDate", T.DateType()), ("Reporting_Airline", _STR), ("Tail_Number", _STR),
    ("Flight_Number_Reporting_Airline", _STR), ("Origin", _STR), ("Dest", _STR),
    ("CRSDepTime", _STR), ("DepTime", _STR), ("DepDelay", _STR), ("ArrDelay", _STR),
    ("ArrDel15", _STR), ("Cancelled", _STR), ("CancellationCode", _STR), ("CarrierDelay", _STR),
    ("WeatherDelay", _STR), ("NASDelay", _STR), ("SecurityDelay", _STR),
    ("LateAircraftDelay", _STR), ("Distance", _STR), ("AirTime", _STR), ("AircraftType", _STR),
    ("Route", _STR),
)

CAPACITY_RAW = _struct(
    ("Year", _INT), ("Month", _INT), ("YearMonth", _STR), ("Origin", _STR), ("Dest", _STR),
    ("Route", _STR), ("Reporting_Airline", _STR), ("AircraftType", _STR), ("DepScheduled", _INT),
    ("DepPerformed", _INT), ("Seats", _INT), ("Passengers", _INT), ("LoadFactor", _STR),
    ("AvgSeatsPerDep", _DBL),
)

WEATHER_RAW = _struct(
    ("valid", T.TimestampNTZType()), ("station", _STR), ("tmpf", _STR), ("dwpf", _STR),
    ("drct", _STR), ("sknt", _STR), ("p01i", _STR), ("vsby", _STR), ("gust", _STR),
    ("skyc1", _STR), ("wxcodes", _STR),
)

# One weather report as the provider sends it.
SNAPSHOT = T.StructType([
    T.StructField("weather", T.ArrayType(_struct(("id", _INT), ("description", _STR)))),
    T.StructField("main", _struct(("temp", _DBL))),
    T.StructField("wind", _struct(("speed", _DBL))),
    T.StructField("visibility", _INT),
])

SCENARIOS = _struct(
    ("scenario_id", T.LongType()), ("route", _STR), ("additional_daily_flights", _INT),
    ("schedule_change", _STR), ("simulation_runs", _INT), ("label", _STR),
)

RUNS = T.StructType([
    T.StructField("run_id", _STR), T.StructField("logged_at", T.TimestampNTZType()),
    T.StructField("params", T.MapType(_STR, _STR)), T.StructField("auc_roc", _DBL),
    T.StructField("f1_score", _DBL), T.StructField("average_precision", _DBL),
    T.StructField("n_features", _INT),
])

# Star schema and event log that the adapters read. Given here so that opening a table does not
# start a job that reads file footers.
_LONG, _NTZ = T.LongType(), T.TimestampNTZType()
TABLES = {
    "region": _struct(("r_regionkey", _INT), ("r_name", _STR)),
    "nation": _struct(("n_nationkey", _INT), ("n_name", _STR), ("n_regionkey", _INT)),
    "customer": _struct(
        ("c_custkey", _LONG), ("c_name", _STR), ("c_nationkey", _INT), ("c_acctbal", _DBL),
        ("c_mktsegment", _STR),
    ),
    "supplier": _struct(
        ("s_suppkey", _LONG), ("s_name", _STR), ("s_nationkey", _INT), ("s_acctbal", _DBL)
    ),
    "orders": _struct(
        ("o_orderkey", _LONG), ("o_custkey", _LONG), ("o_orderstatus", _STR),
        ("o_totalprice", _DBL), ("o_orderdate", _NTZ), ("o_orderpriority", _STR),
    ),
    "lineitem": _struct(
        ("l_orderkey", _LONG), ("l_partkey", _LONG), ("l_suppkey", _LONG), ("l_linenumber", _INT),
        ("l_quantity", _DBL), ("l_extendedprice", _DBL), ("l_discount", _DBL), ("l_tax", _DBL),
        ("l_returnflag", _STR), ("l_linestatus", _STR), ("l_shipdate", _NTZ),
    ),
    "events": _struct(
        ("event_id", _LONG), ("ts", _NTZ), ("user_id", _LONG), ("event_type", _STR),
        ("value", _DBL), ("props", _STR),
    ),
    "conversations": _struct(("conv_id", _LONG), ("turn", _LONG), ("role", _STR), ("text", _STR)),
}
