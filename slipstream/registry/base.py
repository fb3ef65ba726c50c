"""Registration of queries and the SQL fragments that their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder, and the SQL it must agree with."""
    def add(builder: Builder) -> Builder:
        if name in BUILDERS:
            raise ValueError(f"{name} is registered twice")
        BUILDERS[name] = builder
        if sql is not None:
            SQL[name] = sql
        return builder

    return add


def rnd(x: str, digits: int) -> str:
    """SQL that rounds half up on the decimal value."""
    return f"cast(round(cast({x} as decimal(28,10)), {digits}) as double)"


def clamp(x: str, low: str, high: str) -> str:
    return f"case when {x} is not null then least(greatest({x}, {low}), {high}) end"


# Flights from order lines, before and after cleaning.
SHIPMENTS = """
raw_shipments as (
  select *,
    case when cx = 0 then (l_quantity - 36) * 45 end as dep_raw,
    case when cx = 0 then (l_quantity - 36) * 45 - l_orderkey % 5 end as arr_raw
  from (
    select l.*, sn.n_name as "Origin", cr.r_name as "Dest", sn.n_nationkey as nk,
      cr.r_regionkey as rk,
      case when l_returnflag = 'R' and l_orderkey % 10 = 0 then 1 else 0 end as cx
    from lineitem l
    join orders o on l.l_orderkey = o.o_orderkey
    join supplier s on l.l_suppkey = s.s_suppkey
    join nation sn on s.s_nationkey = sn.n_nationkey
    join customer c on o.o_custkey = c.c_custkey
    join nation cn on c.c_nationkey = cn.n_nationkey
    join region cr on cn.n_regionkey = cr.r_regionkey)
),
flights as (
  select cast(l_shipdate as date) as "FlightDate", l_suppkey as "Tail_Number", "Origin", "Dest",
    "Origin" || '-' || "Dest" as "Route",
    cast(l_partkey % 24 * 100 + l_orderkey % 60 as integer) as "CRSDepTime",
    cx as "Cancelled",
    case when dep_raw is not null then least(greatest(dep_raw, -30.0::double), 600.0::double) end
      as "DepDelay",
    case when arr_raw is not null then least(greatest(arr_raw, -30.0::double), 600.0::double) end
      as "ArrDelay",
    case when arr_raw >= 15 then 1 else 0 end as "ArrDel15",
    case when cx = 0 then cast(l_partkey % 30 as double) end as "CarrierDelay",
    case when cx = 0 then cast(l_suppkey % 20 as double) end as "WeatherDelay",
    case when cx = 0 then cast(l_linenumber as double) end as "NASDelay",
    case when cx = 0 then cast(l_orderkey % 3 as double) end as "SecurityDelay",
    case when cx = 0 and l_partkey % 7 <> 0 then l_quantity end as "LateAircraftDelay",
    cast(100 + nk * 90 + rk * 20 as integer) as "Distance",
    case when cx = 0 then cast(100 + nk * 90 + rk * 20 as double) / 8 + 30 end as "AirTime",
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    cast(year(l_shipdate) as integer) as "Year", cast(month(l_shipdate) as integer) as "Month",
    cast(isodow(l_shipdate) - 1 as integer) as "DayOfWeek",
    cast(dayofyear(l_shipdate) as integer) as "DayOfYear",
    cast(quarter(l_shipdate) as integer) as "Quarter",
    cast(l_partkey % 24 as integer) as "DepHour"
  from raw_shipments
)"""

# Legs from events.
LEGS = """
legs as (
  select event_id, user_id as "Tail_Number", cast(ts as date) as "FlightDate",
    cast(extract(hour from ts) as integer) as "DepHour", 'HUB' as "Origin",
    event_type as "Dest", 'HUB-' || event_type as "Route", cx as "Cancelled",
    case when cx = 0 then least(greatest(dep, -30.0::double), 600.0::double) end as "DepDelay",
    case when cx = 0 then least(greatest(dep - event_id % 7, -30.0::double), 600.0::double) end
      as "ArrDelay",
    case when cx = 0 and dep - event_id % 7 >= 15 then 1 else 0 end as "ArrDel15",
    case when cx = 0 then cast(25 + event_id % 276 as double) end as "AirTime",
    cast(year(ts) as integer) as "Year", cast(month(ts) as integer) as "Month",
    cast(isodow(ts) - 1 as integer) as "DayOfWeek"
  from (
    select *, case when event_type = 'error' and event_id % 20 = 0 then 1 else 0 end as cx,
      cast(floor(value) as double) - 20 as dep
    from events)
)"""

WEATHER = """
weather as (
  select *,
    least(greatest(thunderstorm_flag * 4.0::double + low_visibility_flag * 2.5::double
      + precipitation_flag * 1.5::double + wind_gust_flag * 2.0::double
      + least(p01i / 0.5::double, 1.0::double), 0.0::double), 10.0::double) as weather_severity
  from (
    select *,
      case when wxcodes like '%TS%' then 1 else 0 end as thunderstorm_flag,
      case when p01i > 0.01 then 1 else 0 end as precipitation_flag,
      case when vsby < 3 then 1 else 0 end as low_visibility_flag,
      case when gust > 25 then 1 else 0 end as wind_gust_flag
    from (
      select valid, 'HUB' as station,
        least(greatest(cast(n + 40 as double), -10.0::double), 120.0::double) as tmpf,
        abs(cast(n - 10 as double)) as sknt,
        cast(n % 5 as double) / 10.0::double as p01i,
        least(cast(n % 12 as double), 10.0::double) as vsby,
        case when n % 4 <> 0 then cast(n * 2 as double) end as gust,
        case when n % 6 = 0 then 'TSRA' when n % 3 = 0 then 'RA' else '' end as wxcodes
      from (select date_trunc('hour', ts) as valid, count(*) as n from events group by 1)
      where (day(valid) * 24 + hour(valid)) % 11 <> 0))
)"""

# Legs with the weather of their hour.
LEGS_WEATHER = LEGS + "," + WEATHER + """,
legs_wx as (
  select l.*, w.tmpf, w.sknt, coalesce(w.p01i, 0) as p01i, coalesce(w.vsby, 10) as vsby, w.gust,
    w.wxcodes, coalesce(w.thunderstorm_flag, 0) as thunderstorm_flag,
    coalesce(w.precipitation_flag, 0) as precipitation_flag,
    coalesce(w.low_visibility_flag, 0) as low_visibility_flag,
    coalesce(w.wind_gust_flag, 0) as wind_gust_flag,
    coalesce(w.weather_severity, 0) as weather_severity
  from legs l
  left join weather w on cast(w.valid as date) = l."FlightDate" and hour(w.valid) = l."DepHour"
)"""


def capacity_sql(key: str = "Route", name: str = "capacity") -> str:
    return f"""
{name} as (
  select *, printf('%d-%02d', "Year", "Month") as "YearMonth",
    cast("Passengers" as double) / "Seats" as "LoadFactor"
  from (
    select "{key}" as "Route", "Year", "Month", count(*) as "DepScheduled",
      cast(sum(1 - "Cancelled") as bigint) as "DepPerformed", count(*) * 60 as "Seats",
      cast(sum(cast(l_quantity as bigint)) as bigint) as "Passengers"
    from flights group by 1, 2, 3)
)"""


CAPACITY = capacity_sql()

# The five views, over "flights" or, for the weather, over "legs_wx".
_OPERATED = '"Cancelled" = 0'
_LATE = '"Cancelled" = 0 and "ArrDel15" = 1'
OTP_SQL = rnd(
    'count(*) filter ("Cancelled" = 0 and "ArrDel15" = 0)::double'
    ' / nullif(count(*) filter ("Cancelled" = 0), 0)', 4,
)
CANCEL_SQL = rnd('sum("Cancelled")::double / count(*)', 4)


def mean_sql(column: str, condition: str = _OPERATED) -> str:
    return rnd(f'avg("{column}") filter ({condition})', 2)


PERFORMANCE = f"""
route_performance as (
  select "Route", "Origin", "Dest", "Year", "Month", "Distance", count(*) as total_flights,
    cast(sum("Cancelled") as bigint) as cancelled_flights, {CANCEL_SQL} as cancel_rate,
    count(*) filter ({_OPERATED}) as operated_flights,
    count(*) filter ({_LATE}) as delayed_flights, {OTP_SQL} as otp_rate,
    {mean_sql("ArrDelay")} as avg_arr_delay_min, {mean_sql("DepDelay")} as avg_dep_delay_min,
    {mean_sql("CarrierDelay")} as avg_carrier_delay,
    {mean_sql("WeatherDelay")} as avg_weather_delay,
    {mean_sql("NASDelay")} as avg_nas_delay, {mean_sql("LateAircraftDelay")} as avg_late_ac_delay
  from flights group by all
)"""

SUMMARY = f"""
monthly_otp_summary as (
  select "Year", "Month", printf('%d-%02d', "Year", "Month") as "YearMonth",
    count(*) as total_flights, cast(sum("Cancelled") as bigint) as cancelled_flights,
    {CANCEL_SQL} as cancel_rate, {OTP_SQL} as network_otp, {mean_sql("ArrDelay")} as avg_arr_delay,
    {mean_sql("DepDelay")} as avg_dep_delay, count(distinct "Route") as routes_operated
  from flights group by "Year", "Month"
)"""

_TOTAL_MINUTES = "+".join(
    f'coalesce("{c}", 0)'
    for c in ("CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")
)


def _share(column: str) -> str:
    return rnd(
        f'sum(case when {_LATE} then "{column}" else 0 end)'
        f" / nullif(sum(case when {_LATE} then {_TOTAL_MINUTES} else 0 end), 0)", 4,
    )


DECOMPOSITION = f"""
delay_cause_decomposition as (
  select "Route", "Year", "Month", {mean_sql("CarrierDelay", _LATE)} as avg_carrier_delay,
    {mean_sql("WeatherDelay", _LATE)} as avg_weather_delay,
    {mean_sql("NASDelay", _LATE)} as avg_nas_delay,
    {mean_sql("SecurityDelay", _LATE)} as avg_security_delay,
    {mean_sql("LateAircraftDelay", _LATE)} as avg_late_ac_delay,
    count(*) filter ({_LATE}) as delayed_count, {_share("CarrierDelay")} as carrier_delay_pct,
    {_share("WeatherDelay")} as weather_delay_pct, {_share("NASDelay")} as nas_delay_pct,
    {_share("LateAircraftDelay")} as late_ac_delay_pct
  from flights group by "Route", "Year", "Month"
)"""

UTILIZATION = """
capacity_utilization as (
  select c."Route", c."Year", c."Month", c."YearMonth", c."DepScheduled", c."DepPerformed",
    c."Seats", c."Passengers", c."LoadFactor", r.otp_rate, r.avg_arr_delay_min, r.cancel_rate,
    r.delayed_flights, r.operated_flights
  from capacity c
  left join route_performance r
    on c."Route" = r."Route" and c."Year" = r."Year" and c."Month" = r."Month"
)"""

IMPACT = f"""
weather_impact as (
  select "Route", "Year", "Month", {rnd("avg(weather_severity)", 2)} as avg_weather_severity,
    {mean_sql("ArrDelay")} as avg_arr_delay, {OTP_SQL} as otp_rate,
    cast(sum(thunderstorm_flag) as bigint) as thunderstorm_count,
    cast(sum(precipitation_flag) as bigint) as precipitation_count,
    cast(sum(low_visibility_flag) as bigint) as low_vis_count,
    cast(sum(wind_gust_flag) as bigint) as wind_gust_count, count(*) as total_flights
  from legs_wx group by "Route", "Year", "Month"
)"""


def with_sql(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"
