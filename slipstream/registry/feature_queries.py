"""Cleaning, joins, windows and features over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import rounded
from slipstream.operators import cleaning, features, intent, rotation, scoring, snapshots, weather_join
from slipstream.operators.asof import as_of_join
from slipstream.operators.staging import shared_folder, stage
from slipstream.operators.trailing import trailing_mean_at, trailing_mean_delay
from slipstream.plans import views
from slipstream.registry.base import (
    BUILDERS, CAPACITY, LEGS, LEGS_WEATHER, OTP_SQL, PERFORMANCE, SHIPMENTS, WEATHER, mean_sql, query, rnd,
    with_sql,
)
from slipstream.registry.report_queries import legs_with_weather, sheets_of
from slipstream.sources import adapters as ad
from slipstream.sources import readers, rejects, sinks
from slipstream.streaming import daily

FL, LG, LW = with_sql(SHIPMENTS), with_sql(LEGS), with_sql(LEGS_WEATHER)


def _quoted(*names: str) -> str:
    return ", ".join(f'"{n}"' for n in names)


# ---- cleaning -----------------------------------------------------------------------------------
CLEAN = (
    "FlightDate", "Route", "CRSDepTime", "Cancelled", "DepDelay", "ArrDelay", "ArrDel15",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay", "AirTime",
    "Distance", "Year", "Month", "DayOfWeek", "DayOfYear", "Quarter", "DepHour",
    "l_orderkey", "l_linenumber",
)
query("p1_p6_clean_flights", FL + f"select {_quoted(*CLEAN)} from flights")(
    lambda s, d: ad.shipments(s, d).select(*CLEAN))


@query("p1_p2_drop_and_coerce", """
select l_orderkey, l_linenumber, l_shipdate::date as "FlightDate", l_returnflag as "Route",
  case when l_linenumber % 3 = 0 then null
    else least(greatest(l_quantity, -30.0::double), 600.0::double) end as "DepDelay"
from lineitem where l_partkey % 11 <> 0""")
def _coerce(s: SparkSession, d: str) -> DataFrame:
    """Rows without a route are dropped; a text that is no number becomes null."""
    lines = ad.table(s, d, "lineitem")
    raw = lines.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("FlightDate"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_returnflag")).alias("Route"),
        F.lit("A").alias("Origin"), F.lit("B").alias("Dest"), F.lit("930").alias("CRSDepTime"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("string")).alias("DepDelay"),
        F.lit("").alias("ArrDelay"), F.lit("0").alias("ArrDel15"), F.lit(None).alias("Cancelled"),
    )
    return cleaning.clean_flights(raw).select(
        "l_orderkey", "l_linenumber", "FlightDate", "Route", "DepDelay"
    )


WX = (
    "valid_day", "valid_hour", "tmpf", "sknt", "p01i", "vsby", "gust", "thunderstorm_flag",
    "precipitation_flag", "low_visibility_flag", "wind_gust_flag", "weather_severity",
)
query("p7_p8_p9_clean_weather", with_sql(WEATHER) + """
select cast(valid as date) as valid_day, cast(hour(valid) as integer) as valid_hour,
  tmpf, sknt, p01i, vsby, gust, thunderstorm_flag, precipitation_flag, low_visibility_flag,
  wind_gust_flag, """ + rnd("weather_severity", 6) + """ as weather_severity from weather"""
)(lambda s, d: ad.weather(s, d).select(
    F.to_date("valid").alias("valid_day"), F.hour("valid").alias("valid_hour"), *WX[2:-1],
    rounded("weather_severity", 6).alias("weather_severity")))
query("p3_clean_capacity", with_sql(SHIPMENTS, CAPACITY) + f"""
select "Route", "Year", "Month", "YearMonth", "DepScheduled", "DepPerformed", "Seats",
  "Passengers", {rnd('least(greatest("LoadFactor", 0.0::double), 1.0::double)', 6)} as "LoadFactor"
from capacity""")(lambda s, d: ad.capacity(ad.shipments(s, d)).withColumn(
    "LoadFactor", rounded("LoadFactor", 6)))

# ---- joins --------------------------------------------------------------------------------------
J1 = (
    "event_id", "Route", "DepDelay", "sknt", "p01i", "vsby", "gust", "wxcodes",
    "thunderstorm_flag", "precipitation_flag", "low_visibility_flag", "wind_gust_flag",
    "weather_severity",
)
query("j1_weather_join", LW + f"select {_quoted(*J1)} from legs_wx".replace(
    '"weather_severity"', rnd("weather_severity", 6) + " as weather_severity"))(
    lambda s, d: legs_with_weather(s, d).select(*J1).withColumn(
        "weather_severity", rounded("weather_severity", 6)))


@query("j2_capacity_with_punctuality", with_sql(SHIPMENTS, CAPACITY, PERFORMANCE) + """
select c."Route", c."YearMonth", c."Passengers", r.otp_rate
from capacity c left join route_performance r using ("Route", "Year", "Month")""")
def _j2(s: SparkSession, d: str) -> DataFrame:
    flights = ad.shipments(s, d)
    joined = views.capacity_utilization(ad.capacity(flights), views.route_performance(flights))
    return joined.select("Route", "YearMonth", "Passengers", "otp_rate")


# ---- calendar, route and weather features -------------------------------------------------------
HOLIDAYS_SQL = "(values " + ", ".join(f"(date '{h}')" for h in fv.HOLIDAYS) + ") h(holiday)"
TAU = "2.0::double * pi()"


def _cycle(name: str, x: str, period: int) -> str:
    return (
        f"{rnd(f'sin({TAU} * {x} / {period})', 6)} as {name}_sin, "
        f"{rnd(f'cos({TAU} * {x} / {period})', 6)} as {name}_cos"
    )


CALENDAR = (
    "event_id", "hour_of_day", "day_of_week", "month", "quarter", "day_of_year", "is_weekend",
    "is_monday", "is_friday", "is_holiday", "is_holiday_window", "is_early_morning",
    "is_peak_morning", "is_afternoon", "is_evening", "is_summer", "is_hurricane_season",
    "is_winter", "hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos",
)
CALENDAR_SQL = f"""
  event_id, "DepHour" as hour_of_day, "DayOfWeek" as day_of_week, "Month" as month,
  cast(quarter("FlightDate") as integer) as quarter,
  cast(dayofyear("FlightDate") as integer) as day_of_year,
  ("DayOfWeek" >= 5)::int as is_weekend, ("DayOfWeek" = 0)::int as is_monday,
  ("DayOfWeek" = 4)::int as is_friday,
  ("FlightDate" in (select holiday from {HOLIDAYS_SQL}))::int as is_holiday,
  ("FlightDate" in (select cast(holiday + i as date) from {HOLIDAYS_SQL},
    (values (-1), (0), (1), (2)) w(i)))::int as is_holiday_window,
  ("DepHour" < 7)::int as is_early_morning,
  ("DepHour" >= 7 and "DepHour" < 10)::int as is_peak_morning,
  ("DepHour" >= 13 and "DepHour" < 18)::int as is_afternoon,
  ("DepHour" >= 18)::int as is_evening, ("Month" in (6, 7, 8))::int as is_summer,
  ("Month" in (8, 9, 10))::int as is_hurricane_season, ("Month" in (12, 1, 2))::int as is_winter,
  {_cycle("hour", '"DepHour"', 24)}, {_cycle("month", '("Month" - 1)', 12)},
  {_cycle("dow", '"DayOfWeek"', 7)}"""
CYCLES = ("hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos")


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rounded(c, digits) for c in columns})


query("p13_p14_p15_j5_calendar_features", LG + f"select {CALENDAR_SQL} from legs")(
    lambda s, d: _rounded(
        features.add_calendar_features(ad.legs(s, d)).select(*CALENDAR), CYCLES))


def _route_lookup(s: SparkSession, d: str) -> DataFrame:
    """Distance and punctuality per route."""
    flights = ad.shipments(s, d)
    return flights.groupBy(F.col("Route").alias("route")).agg(
        F.max("Distance").alias("distance"),
        rounded(F.avg(1 - F.col("ArrDel15")), 4).alias("base_otp"),
    )


@query("p16_p17_j4_route_features", FL + f""",
lookup as (
  select "Route", max("Distance") as distance, {rnd('avg(1 - "ArrDel15")', 4)} as base_otp
  from flights group by 1),
joined as (
  select f.*, coalesce(k.distance, f."Distance")::double as rd, k.base_otp
  from flights f left join lookup k on f."Route" = k."Route")
select "Route", rd as route_distance, coalesce(base_otp, 0.75) as route_otp_baseline,
  ("Dest" in ('ASIA', 'EUROPE'))::int as is_high_congestion_dest,
  (rd >= 1500)::int as is_long_haul, (rd < 400)::int as is_short_haul,
  {rnd("rd / (select max(distance) from lookup)", 6)} as distance_normalised, count(*) as n
from joined group by all""")
def _route_features(s: SparkSession, d: str) -> DataFrame:
    out = features.add_route_features(
        ad.shipments(s, d), _route_lookup(s, d), congested=("ASIA", "EUROPE")
    ).withColumn("distance_normalised", rounded("distance_normalised", 6))
    return out.groupBy(
        "Route", "route_distance", "route_otp_baseline", "is_high_congestion_dest",
        "is_long_haul", "is_short_haul", "distance_normalised",
    ).agg(F.count("*").alias("n"))


WEATHER_FEATURES_SQL = f"""
  thunderstorm_flag, precipitation_flag, low_visibility_flag, wind_gust_flag,
  {rnd("weather_severity", 6)} as weather_severity, coalesce(sknt, 0) as wind_speed,
  (coalesce(sknt, 0) > 20)::int as high_wind_flag"""
query("p8_p12_weather_features", LW + f"select event_id, {WEATHER_FEATURES_SQL} from legs_wx")(
    lambda s, d: _rounded(features.add_weather_features(legs_with_weather(s, d)).select(
        "event_id", "thunderstorm_flag", "precipitation_flag", "low_visibility_flag",
        "wind_gust_flag", "weather_severity", "wind_speed", "high_wind_flag"),
        ["weather_severity"]))
query("p10_fallback_severity", LW + """
select event_id, least(thunderstorm_flag * 4.0::double + low_visibility_flag * 2.5::double
  + precipitation_flag * 1.5::double + wind_gust_flag * 2.0::double, 10.0::double)
  as weather_severity from legs_wx""")(lambda s, d: features.add_weather_features(
    legs_with_weather(s, d).drop("weather_severity")).select("event_id", "weather_severity"))

# ---- snapshots ----------------------------------------------------------------------------------
SNAPSHOT_SQL = """
select event_id, 'sky ' || event_type as description, cast(200 + event_id % 620 as integer)
  as condition_id, cast(event_id % 40 as double) as temp_c,
  case when event_id % 5 = 0 then 0.0::double else cast(event_id % 30 as double) end
    as wind_speed_ms,
  cast(case when event_id % 7 = 0 then 10000 else event_id * 37 % 12000 end as integer)
    as visibility_m
from events"""


@query("s10_p11_weather_snapshots", f"""
with t as ({SNAPSHOT_SQL}), f as (
  select *, condition_id between 200 and 299 as thunderstorm,
    condition_id between 300 and 699 as precipitation, visibility_m < 4800 as low_visibility,
    wind_speed_ms > 12 as wind_gust from t)
select *, (case when thunderstorm then 4.5 when precipitation then 2.0 else 0.0 end)::double
  + low_visibility::int * 2.5::double + wind_gust::int * 1.5::double as severity from f""")
def _snapshots(s: SparkSession, d: str) -> DataFrame:
    """Reports in JSON are made from the events, with fields left out on purpose."""
    e = F.col("event_id")
    payload = F.to_json(F.struct(
        F.array(F.struct(
            (200 + e % 620).cast("int").alias("id"),
            F.concat(F.lit("sky "), "event_type").alias("description"),
        )).alias("weather"),
        F.struct((e % 40).cast("double").alias("temp")).alias("main"),
        F.when(e % 5 != 0, F.struct((e % 30).cast("double").alias("speed"))).alias("wind"),
        F.when(e % 7 != 0, (e * 37 % 12000).cast("int")).alias("visibility"),
    ))
    raw = ad.table(s, d, "events").select("event_id", payload.alias("payload"))
    return snapshots.parse_snapshots(raw)


# ---- rotation -----------------------------------------------------------------------------------
ROTATION_SQL = LEGS + """,
seq as (
  select *, lag("DepDelay") over t as p_dep, lag("ArrDelay") over t as p_arr,
    date_diff('minute', timestamp '1970-01-01', "FlightDate"::timestamp) + "DepHour" * 60 as dep_at,
    row_number() over (partition by "Tail_Number", "FlightDate" order by "DepHour", event_id) - 1
      as before_today,
    coalesce(sum(coalesce("DepDelay", 0)) over (
      partition by "Tail_Number", "FlightDate" order by "DepHour", event_id
      rows between unbounded preceding and 1 preceding), 0) as debt,
    sum(1 - "ArrDel15") over t as island
  from legs window t as (partition by "Tail_Number" order by "FlightDate", "DepHour", event_id)),
runs as (
  select *, dep_at + coalesce("DepDelay", 0) + coalesce("AirTime", 90) as arr_at,
    sum("ArrDel15") over (partition by "Tail_Number", island
      order by "FlightDate", "DepHour", event_id) as run
  from seq),
chain as (
  select *, (dep_at - lag(arr_at) over t) / 60.0::double as gap,
    coalesce(lag(run) over t, 0) as streak
  from runs window t as (partition by "Tail_Number" order by "FlightDate", "DepHour", event_id)),
rotation as (
  select *, case when gap between 0 and 16 then gap else 4.0::double end as hours_idle from chain)
"""
ROT = with_sql(ROTATION_SQL)


def _rotation(s: SparkSession, d: str) -> DataFrame:
    return rotation.rotation_features(ad.legs(s, d), ad.LEG_TIE_BREAK)


def _rot(*columns: str):
    return lambda s, d: _rotation(s, d).select("event_id", *columns)


query("w1_prev_departure_delay", ROT + """
select event_id, coalesce(p_dep, 0) as prev_tail_dep_delay from rotation"""
)(_rot("prev_tail_dep_delay"))
query("w2_prev_arrival_delay", ROT + """
select event_id, least(greatest(coalesce(p_arr, 0), -30.0::double), 300.0::double)
  as prev_tail_arr_delay from rotation""")(_rot("prev_tail_arr_delay"))
query("w3_legs_before_today", ROT + """
select event_id, cast(least(before_today, 10) as integer) as legs_today_before from rotation"""
)(_rot("legs_today_before"))
query("w4_delay_before_today", ROT + """
select event_id, least(greatest(debt, -30.0::double), 300.0::double) as cumulative_tail_delay_today
from rotation""")(_rot("cumulative_tail_delay_today"))
query("w5_idle_hours", ROT + f"""
select event_id, {rnd("hours_idle", 6)} as hours_since_last_flight,
  (hours_idle < 1)::int as quick_turn_flag from rotation""")(lambda s, d: _rounded(
    _rot("hours_since_last_flight", "quick_turn_flag")(s, d), ["hours_since_last_flight"]))
query("w6_late_streak", ROT + """
select event_id, cast(least(streak, 10) as integer) as tail_delay_streak from rotation"""
)(_rot("tail_delay_streak"))

# ---- trailing mean ------------------------------------------------------------------------------
AT = "(\"FlightDate\" + to_hours(\"DepHour\"))"
TRAILING_PEERS = f"""coalesce({rnd(f'avg("DepDelay") over (order by {AT} range between interval 1 hour preceding and current row)', 6)}, 0)"""
TRAILING_STRICT = f"""coalesce({rnd(f'avg("DepDelay") over (order by {AT} range between interval 1 hour preceding and interval 1 hour preceding)', 6)}, 0)"""


def _trailing(mode: str):
    def build(s: SparkSession, d: str) -> DataFrame:
        out = trailing_mean_delay(ad.legs(s, d), mode, ad.LEG_TIE_BREAK)
        return _rounded(out.select("event_id", "rolling_avg_dep_delay"), ["rolling_avg_dep_delay"])

    return build


query("w7_trailing_mean_peers", LG + f"""
select event_id, {TRAILING_PEERS} as rolling_avg_dep_delay from legs""")(_trailing("peers"))
query("w7_trailing_mean_strict", LG + f"""
select event_id, {TRAILING_STRICT} as rolling_avg_dep_delay from legs""")(_trailing("strict"))
RUNNING_SQL = LG + f""",
h as (select "FlightDate" + to_hours("DepHour") as at, count("DepDelay") as n,
  coalesce(sum("DepDelay"), 0) as s from legs group by 1),
r as (select event_id, {AT} as at,
    count("DepDelay") over w as n, coalesce(sum("DepDelay") over w, 0) as s
  from legs window w as (partition by {AT} order by event_id))
select event_id, coalesce({rnd("(r.s + coalesce(h.s, 0)) / nullif(r.n + coalesce(h.n, 0), 0)", 6)}, 0)
  as rolling_avg_dep_delay
from r left join h on h.at = r.at - interval 1 hour"""
query("w7_trailing_mean_running", RUNNING_SQL)(_trailing("running"))


def _frame(mode: str) -> str:
    end = "current row" if mode == "peers" else "interval '0.000001 second' preceding"
    return f"""(partition by event_type order by ts
      range between interval '7199.999999 seconds' preceding and {end})"""


def _trailing_at(mode: str):
    @query(f"w7_trailing_mean_any_time_{mode}", f"""
select event_id, coalesce({rnd('cast(s as double) / nullif(n, 0)', 6)}, 0) as rolling_avg_dep_delay
from (
  select event_id, count(value) over w as n, sum(cast(value as decimal(18,6))) over w as s
  from events window w as {_frame(mode)})""")
    def build(s: SparkSession, d: str) -> DataFrame:
        """Mean over the two hours up to each event among events of its type, times to the microsecond."""
        out = trailing_mean_at(
            ad.table(s, d, "events"), "ts", keys=["event_type"], mode=mode, value="value"
        )
        return _rounded(out.select("event_id", "rolling_avg_dep_delay"), ["rolling_avg_dep_delay"])


_trailing_at("peers")
_trailing_at("strict")

# ---- weather of the latest observation ----------------------------------------------------------
query("j1_weather_as_of", with_sql(WEATHER) + """
select event_id, ts, case when near then valid end as valid, case when near then tmpf end as tmpf,
  case when near then vsby else 10 end as vsby,
  case when near then weather_severity else 0 end as weather_severity
from (
  select *, coalesce(ts <= valid + interval 75 minutes, false) as near
  from events asof left join weather on ts >= valid)""")(
    lambda s, d: weather_join.join_weather_as_of(
        ad.table(s, d, "events").select("event_id", "ts", F.lit("HUB").alias("Origin")),
        ad.weather(s, d), "ts", dt.timedelta(minutes=75),
    ).select("event_id", "ts", "valid", "tmpf", "vsby", "weather_severity"))


@query("j1_as_of_by_key", """
select event_id, asked as user_id, case when near then seen_at end as seen_at,
  case when near then seen_id end as seen_id, case when near then seen_value end as seen_value
from (
  select event_id, e.user_id as asked, seen_at, seen_id, seen_value,
    coalesce(ts <= seen_at + interval 2 days, false) as near
  from events e asof left join (
    select user_id, date_trunc('day', ts) as seen_at, max(event_id) as seen_id,
      arg_max(value, event_id) as seen_value
    from events where event_type = 'view' group by 1, 2) as seen
  on e.user_id = seen.user_id and ts >= seen_at)""")
def _as_of_by_key(s: SparkSession, d: str) -> DataFrame:
    """Each event with its user's latest view day, at most two days ago; many views share a day."""
    events = ad.table(s, d, "events")
    seen = events.where(F.col("event_type") == "view").select(
        "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("seen_at"),
        F.col("event_id").alias("seen_id"), F.col("value").alias("seen_value"),
    )
    return as_of_join(
        events.select("event_id", "user_id", "ts"), seen, "ts", "seen_at", ["user_id"],
        dt.timedelta(days=2), ["seen_id"],
    ).drop("ts")

# ---- all features -------------------------------------------------------------------------------
FEATURES_SQL = with_sql(LEGS_WEATHER + ROTATION_SQL[len(LEGS):]) + f"""
select x.* exclude (day_of_year),
  w.* exclude (event_id), x2.* exclude (event_id), q.* exclude (event_id), u.* exclude (event_id)
from (select {CALENDAR_SQL} from legs) x
join (select event_id, {WEATHER_FEATURES_SQL} from legs_wx) w using (event_id)
join (select event_id, 0.0::double as route_distance, 0.75::double as route_otp_baseline,
    0 as is_high_congestion_dest, 0 as is_long_haul, 1 as is_short_haul,
    0.0::double as distance_normalised from legs) x2 using (event_id)
join (select event_id, {TRAILING_PEERS} as rolling_avg_dep_delay from legs) q using (event_id)
join (select event_id, coalesce(p_dep, 0) as prev_tail_dep_delay,
    least(greatest(coalesce(p_arr, 0), -30.0::double), 300.0::double) as prev_tail_arr_delay,
    cast(least(before_today, 10) as integer) as legs_today_before,
    least(greatest(debt, -30.0::double), 300.0::double) as cumulative_tail_delay_today,
    {rnd("hours_idle", 6)} as hours_since_last_flight, (hours_idle < 1)::int as quick_turn_flag,
    cast(least(streak, 10) as integer) as tail_delay_streak
  from rotation) u using (event_id)"""


def leg_features(s: SparkSession, d: str, mode: str = "peers") -> DataFrame:
    return features.build_features(legs_with_weather(s, d), ad.LEG_TIE_BREAK, mode=mode)


query("m1_build_features", FEATURES_SQL)(lambda s, d: _rounded(
    leg_features(s, d).select("event_id", *fv.FEATURES),
    [*CYCLES, "weather_severity", "rolling_avg_dep_delay", "hours_since_last_flight"]))


@query("m1_features_switched_off", LG + """
select sum(0.0::double) as rolling, sum(0.0::double) as prev, sum(0.0::double) as streak,
  count(*) as n from legs""")
def _switched_off(s: SparkSession, d: str) -> DataFrame:
    out = features.build_features(
        legs_with_weather(s, d), ad.LEG_TIE_BREAK, propagation=False, tail_lag=False,
        rotation_chain=False,
    )
    return out.agg(
        F.sum("rolling_avg_dep_delay").alias("rolling"), F.sum("prev_tail_dep_delay").alias("prev"),
        F.sum("tail_delay_streak").alias("streak"), F.count("*").alias("n"),
    )


# ---- scores and intents -------------------------------------------------------------------------
SCORE_SQL = f"""
  {rnd('''least(greatest(1.0::double - 0.75::double + weather_severity * 0.025::double
    + thunderstorm_flag * 0.12::double + ("DepHour" >= 16)::int * 0.06::double
    + ("DayOfWeek" >= 4)::int * 0.04::double + coalesce(p_dep, 0) * 0.002::double,
    0.05::double), 0.95::double)''', 6)}"""
SCORED_SQL = LEGS_WEATHER + ROTATION_SQL[len(LEGS):] + f""",
scored as (
  select l.event_id, l."ArrDel15" as label, {SCORE_SQL} as score
  from legs_wx l join rotation r using (event_id) where l."Cancelled" = 0)"""
SCORED_SQL = SCORED_SQL.replace('("DepHour" >= 16)', '(l."DepHour" >= 16)').replace(
    '("DayOfWeek" >= 4)', '(l."DayOfWeek" >= 4)')


def scored_legs(s: SparkSession, d: str) -> DataFrame:
    """Operated legs with the heuristic score; columns event_id, label, score."""
    legs = rotation.rotation_features(legs_with_weather(s, d), ad.LEG_TIE_BREAK)
    score = scoring.heuristic_score(
        F.lit(fv.DEFAULT_ROUTE_OTP), F.col("weather_severity"), F.col("thunderstorm_flag"),
        F.col("DepHour"), F.col("DayOfWeek"), F.col("prev_tail_dep_delay"),
    )
    return legs.where(F.col("Cancelled") == 0).select(
        "event_id", F.col("ArrDel15").alias("label"), rounded(score, 6).alias("score")
    )


query("p27_heuristic_score", with_sql(SCORED_SQL) + """
select event_id, score as delay_probability, case when score < 0.3 then 'Low'
  when score < 0.55 then 'Medium' else 'High' end as risk_level from scored"""
)(lambda s, d: scored_legs(s, d).select(
    "event_id", F.col("score").alias("delay_probability")
).withColumn("risk_level", scoring.risk_band()))

INTENT_SQL = "case " + " ".join(
    f"when regexp_matches(lower(text), '{p}') then '{report}'" for p, report in fv.INTENT_PATTERNS
) + f" else '{fv.DEFAULT_INTENT}' end"
query("p28_question_intent", f"select conv_id, turn, {INTENT_SQL} as intent from conversations")(
    lambda s, d: intent.tag_intent(ad.table(s, d, "conversations")).select(
        "conv_id", "turn", "intent"))

# ---- sources and sinks --------------------------------------------------------------------------


def _scratch(s: SparkSession, name: str) -> str:
    return f"{shared_folder(s)}/{name}-{uuid.uuid4().hex}"


@query("s1_s5_csv_to_parquet", FL + """
select "Year", "Month", count(*) as n, sum("DepDelay") as dep, sum("ArrDelay") as arr,
  cast(sum("Cancelled") as bigint) as cancelled from flights group by 1, 2""")
def _round_trip(s: SparkSession, d: str) -> DataFrame:
    """Raw CSV, typed and cleaned, written by month as Parquet and read back."""
    raw = ad.shipments_raw(s, d)
    given = {c: F.col(c).cast("string") for c in raw.columns}
    columns = [
        given.get(f.name, F.lit(None).cast("string")).alias(f.name)
        for f in readers.schemas.FLIGHTS_RAW
    ]
    csv, parquet = _scratch(s, "flights-csv"), _scratch(s, "flights")
    raw.select(*columns).write.option("header", True).csv(csv)
    cleaned = cleaning.clean_flights(readers.read_flights(s, csv))
    sinks.write_parquet(cleaned, parquet, ["Year", "Month"])
    return readers.read_parquet(s, parquet).groupBy("Year", "Month").agg(
        F.count("*").alias("n"), F.sum("DepDelay").alias("dep"), F.sum("ArrDelay").alias("arr"),
        F.sum("Cancelled").alias("cancelled"),
    )


@query("s2_capacity_csv", with_sql(SHIPMENTS, CAPACITY) + f"""
select "Route", "YearMonth", cast("Seats" as integer) as "Seats",
  cast("Passengers" as integer) as "Passengers", {rnd('"LoadFactor"', 6)} as "LoadFactor"
from capacity""")
def _capacity_csv(s: SparkSession, d: str) -> DataFrame:
    raw = ad.capacity_raw(ad.shipments(s, d))
    path = _scratch(s, "capacity-csv")
    raw.select(*[
        (F.col(f.name) if f.name in raw.columns else F.lit(None).cast("string")).alias(f.name)
        for f in readers.schemas.CAPACITY_RAW
    ]).write.option("header", True).csv(path)
    return cleaning.clean_capacity(readers.read_capacity(s, path)).select(
        "Route", "YearMonth", "Seats", "Passengers", rounded("LoadFactor", 6).alias("LoadFactor")
    )


@query("s3_weather_csv", with_sql(WEATHER) + f"""
select cast(valid as date) as day, cast(hour(valid) as integer) as hour,
  {rnd("weather_severity", 6)} as weather_severity from weather""")
def _weather_csv(s: SparkSession, d: str) -> DataFrame:
    raw = ad.weather_raw(s, d)
    path = _scratch(s, "weather-csv")
    raw.select(*[
        (F.col(f.name) if f.name in raw.columns else F.lit(None).cast("string")).alias(f.name)
        for f in readers.schemas.WEATHER_RAW
    ]).write.option("header", True).csv(path)
    return cleaning.clean_weather(readers.read_weather(s, path)).select(
        F.to_date("valid").alias("day"), F.hour("valid").alias("hour"),
        rounded("weather_severity", 6).alias("weather_severity"),
    )


@query("s4_parquet_scan", """
select l_returnflag, count(*) as n, sum(l_quantity) as quantity from lineitem
where l_shipdate >= date '1998-01-01' group by 1""")
def _scan(s: SparkSession, d: str) -> DataFrame:
    lines = readers.read_parquet(s, f"{d}/lineitem.parquet")
    return lines.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).groupBy(
        "l_returnflag"
    ).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


# Report tables of the export, but the simulator's, and the queries that make them.
EXPORTED = {
    "otp_monthly": "q21_sheet_otp_monthly", "delay_causes": "q22_sheet_delay_causes",
    "load_factor": "q23_sheet_load_factor", "weather_impact": "q24_sheet_weather_impact",
    "demand_forecast": "q26_sheet_demand_forecast", "metadata": "s9_export_metadata",
}
# What these tables read of a flight.
EXPORT_COLUMNS = (
    "FlightDate", "Route", "Origin", "Dest", "Year", "Month", "Distance", "Cancelled", "ArrDel15", "ArrDelay",
    "DepDelay", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay", "l_quantity",
)


@query("s8_export_reports", FL + """
select "Route", count(*) as n, count(*) filter ("Cancelled" = 1) as cancelled from flights
group by 1""")
def _export(s: SparkSession, d: str) -> DataFrame:
    # The joins behind the flights run once, for all tables.
    flights = stage(ad.shipments(s, d).select(*EXPORT_COLUMNS))
    per_route = flights.groupBy("Route").agg(
        F.count("*").alias("n"), F.count_if(F.col("Cancelled") == 1).alias("cancelled")
    )
    made = sheets_of(flights)
    sheets = {
        name: made[name] if name in made else BUILDERS[entry](s, d) for name, entry in EXPORTED.items()
    }
    path, *_ = sinks.export_reports({"per_route": per_route} | sheets, _scratch(s, "export"))
    return readers.read_parquet(s, path)



# ---- files with bad rows ------------------------------------------------------------------------
# Rows that the entry spoils on purpose: lines with a day that is none, without a route, with text
# for a delay.
NO_DAY, NO_ROUTE, NO_DELAY = "l_orderkey % 13 = 0", "l_orderkey % 11 = 0", "l_partkey % 17 = 0"


@query("s1_m12_reject_table", FL + f"""
select case when {NO_DAY} or {NO_ROUTE} then 'rejected' else 'accepted' end as outcome,
  case when {NO_DAY} then 'unreadable line' when {NO_ROUTE} then 'no Route' end as detail, count(*) as n
from flights group by 1, 2
union all
select 'bad number', 'ArrDelay', count(*) from flights where {NO_DELAY} and not ({NO_DAY} or {NO_ROUTE})
having count(*) > 0""")
def _rejects(s: SparkSession, d: str) -> DataFrame:
    """Flights as CSV with bad rows among them; every row leaves with its outcome."""
    raw = ad.shipments_raw(s, d).withColumns({
        "FlightDate": F.expr(f"case when {NO_DAY} then 'someday' else cast(FlightDate as string) end"),
        "Route": F.expr(f"case when not ({NO_ROUTE}) then Route end"),
        "ArrDelay": F.expr(f"case when {NO_DELAY} then 'late' else cast(ArrDelay as string) end"),
    })
    path = _scratch(s, "spoilt-csv")
    raw.select(*[
        (F.col(f.name).cast("string") if f.name in raw.columns else F.lit(None).cast("string")).alias(f.name)
        for f in readers.schemas.FLIGHTS_RAW
    ]).write.option("header", True).csv(path)
    rows = rejects.read_permissive(s, path, readers.schemas.FLIGHTS_RAW)
    return rejects.summary(*rejects.split(rows, cleaning.FLIGHT_KEYS, cleaning.FLIGHT_MEASURES))


# ---- files that arrive --------------------------------------------------------------------------
_STREAMED = """
streamed as (select *, cast("FlightDate" as timestamp) + to_hours("DepHour") as moment from legs),
done as (select * from streamed where "FlightDate" + interval 1 day
  <= (select max(moment) from streamed) - interval 2 day)"""


def _streamed_days(s: SparkSession, d: str) -> DataFrame:
    """Legs in two deliveries, each worked off by a stream of its own from one checkpoint."""
    flights = stage(ad.legs(s, d).selectExpr(
        "from_utc_timestamp(timestamp(FlightDate) + make_interval(0, 0, 0, 0, DepHour), current_timezone())"
        " as event_time", "Route", "Cancelled",
        "ArrDel15", "ArrDelay"))
    ends = flights.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    cut = ends.select(F.timestamp_seconds((F.unix_timestamp("lo") + F.unix_timestamp("hi")) / 2)).scalar()
    source, target, checkpoint = _scratch(s, "arriving"), _scratch(s, "days"), _scratch(s, "progress")
    earlier = F.col("event_time") < cut
    for delivery in (flights.where(earlier), flights.where(~earlier)):
        delivery.write.mode("append").parquet(source)
        daily.advance(s, source, flights.schema, target, checkpoint)
    return daily.final_days(s, target)


query("q2_streamed_days", with_sql(LEGS, _STREAMED) + """
select "FlightDate" as day, "Route", count(*) as total, cast(sum("Cancelled") as bigint) as cancelled,
  count(*) filter ("Cancelled" = 0) as operated,
  count(*) filter ("Cancelled" = 0 and "ArrDel15" = 0) as punctual,
  sum("ArrDelay") filter ("Cancelled" = 0) as arr_minutes,
  count("ArrDelay") filter ("Cancelled" = 0) as arr_known
from done group by 1, 2""")(_streamed_days)
query("q2_streamed_months", with_sql(LEGS, _STREAMED) + f"""
select "Year", "Month", count(*) as total_flights, cast(sum("Cancelled") as bigint) as cancelled_flights,
  {OTP_SQL} as network_otp, {mean_sql("ArrDelay")} as avg_arr_delay,
  count(distinct "Route") as routes_operated
from done group by 1, 2""")(lambda s, d: daily.monthly_summary(_streamed_days(s, d)))
