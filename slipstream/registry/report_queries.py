"""Q1-Q24, Q26-Q42 and the aggregates, sorts and joins they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.functions.aggregates import weighted_mean
from slipstream.functions.columns import rounded
from slipstream.operators import forecast, sketches, weather_join, whatif
from slipstream.operators.scoring import with_prediction
from slipstream.operators.staging import stage
from slipstream.plans import catalog, dashboards, reports, views
from slipstream.registry.base import (
    CAPACITY, DECOMPOSITION, IMPACT, LEGS_WEATHER, PERFORMANCE, SHIPMENTS, SUMMARY, UTILIZATION,
    query, rnd, with_sql,
)
from slipstream.sources import adapters as ad

ROUTE = "NATION_5-ASIA"


def _performance(s: SparkSession, d: str) -> DataFrame:
    return views.route_performance(ad.shipments(s, d))


def _summary(s: SparkSession, d: str) -> DataFrame:
    return views.monthly_otp_summary(ad.shipments(s, d))


def _causes(s: SparkSession, d: str) -> DataFrame:
    return views.delay_cause_decomposition(ad.shipments(s, d))


def _utilization(s: SparkSession, d: str) -> DataFrame:
    flights = ad.shipments(s, d)
    return views.capacity_utilization(ad.capacity(flights), views.route_performance(flights))


def sheets_of(flights: DataFrame) -> dict[str, DataFrame]:
    """Exported report tables that are made of flights, all from the given ones."""
    # A row per route and month, which two tables start from.
    performance = stage(views.route_performance(flights))
    return {
        "otp_monthly": reports.sheet_otp_monthly(performance),
        "delay_causes": reports.sheet_delay_causes(views.delay_cause_decomposition(flights)),
        "load_factor": reports.sheet_load_factor(
            views.capacity_utilization(ad.capacity(flights), performance)),
        "demand_forecast": reports.sheet_demand_forecast(forecast.forecast(
            ad.capacity(flights, "Origin"), horizon=12, model="trend_season")),
        "metadata": reports.sheet_metadata(flights, SHEETS),
    }


def legs_with_weather(s: SparkSession, d: str) -> DataFrame:
    return weather_join.join_weather(ad.legs(s, d), ad.weather(s, d))


def _impact(s: SparkSession, d: str) -> DataFrame:
    return views.weather_impact(legs_with_weather(s, d))


def _capacity(s: SparkSession, d: str) -> DataFrame:
    return ad.capacity(ad.shipments(s, d))


P, S, C, U, W = (
    with_sql(SHIPMENTS, PERFORMANCE), with_sql(SHIPMENTS, SUMMARY),
    with_sql(SHIPMENTS, DECOMPOSITION), with_sql(SHIPMENTS, CAPACITY, PERFORMANCE, UTILIZATION),
    with_sql(LEGS_WEATHER, IMPACT),
)
FL, CAP, LW = with_sql(SHIPMENTS), with_sql(SHIPMENTS, CAPACITY), with_sql(LEGS_WEATHER)
YM = "printf('%d-%02d', \"Year\", \"Month\")"


def pct(x: str, n: int) -> str:
    return rnd(f"{x} * 100", n)


# ---- the five views -----------------------------------------------------------------------------
query("q1_route_performance", P + "select * from route_performance")(_performance)
query("q2_monthly_otp_summary", S + "select * from monthly_otp_summary")(_summary)
query("q3_delay_cause_decomposition", C + "select * from delay_cause_decomposition")(_causes)
query("q4_capacity_utilization", U + "select * from capacity_utilization")(_utilization)
query("q5_weather_impact", W + "select * from weather_impact")(_impact)

# ---- file reports -------------------------------------------------------------------------------
query("q6_otp_trend", S + f"""
select "YearMonth", "Year", "Month", network_otp as network_otp_rate,
  {pct("network_otp", 1)} as otp_pct, avg_arr_delay as avg_arr_delay_min,
  avg_dep_delay as avg_dep_delay_min, total_flights, cancelled_flights,
  {pct("cancel_rate", 2)} as cancel_rate_pct, routes_operated
from monthly_otp_summary""")(lambda s, d: reports.otp_trend(_summary(s, d)))

query("q7_top_delay_routes", P + f"""
select "Route", "Dest", cast(sum(operated_flights) as bigint) as total_operated,
  cast(sum(delayed_flights) as bigint) as total_delayed,
  {pct("sum(delayed_flights)::double / nullif(sum(operated_flights), 0)", 1)} as delay_rate_pct,
  {pct("sum(operated_flights - delayed_flights)::double / nullif(sum(operated_flights), 0)", 1)}
    as otp_pct,
  {rnd("avg(avg_arr_delay_min)", 1)} as avg_arr_delay_min,
  {rnd("avg(avg_carrier_delay)", 1)} as avg_carrier_delay_min,
  {rnd("avg(avg_weather_delay)", 1)} as avg_weather_delay_min,
  {rnd("avg(avg_nas_delay)", 1)} as avg_nas_delay_min,
  {rnd("avg(avg_late_ac_delay)", 1)} as avg_late_ac_delay_min,
  {pct("avg(cancel_rate)", 2)} as avg_cancel_rate_pct
from route_performance group by 1, 2""")(lambda s, d: reports.top_delay_routes(_performance(s, d)))

query("q8_capacity_efficiency", U + f"""
select "Route", "YearMonth", "Year", "Month", "DepScheduled", "DepPerformed",
  {pct('(1 - "DepPerformed"::double / nullif("DepScheduled", 0))', 2)}
    as completion_factor_loss_pct,
  "Seats", "Passengers", {pct('"LoadFactor"', 1)} as load_factor_pct,
  {pct("otp_rate", 1)} as otp_pct, avg_arr_delay_min, cancel_rate,
  {pct('("LoadFactor" * 0.6::double + otp_rate * 0.4::double)', 1)} as efficiency_score
from capacity_utilization where "LoadFactor" is not null"""
)(lambda s, d: reports.capacity_efficiency(_utilization(s, d)))

LONG_SEASON = """case "Month" % 12 // 3 when 0 then 'Winter (Dec-Feb)' when 1 then 'Spring (Mar-May)'
  when 2 then 'Summer (Jun-Aug)' else 'Fall (Sep-Nov)' end"""
query("q9_season_comparison", U + f"""
select "Route", {LONG_SEASON} as season, {pct('avg("LoadFactor")', 1)} as avg_lf_pct,
  {pct('min("LoadFactor")', 1)} as min_lf_pct, {pct('max("LoadFactor")', 1)} as max_lf_pct,
  {pct("avg(otp_rate)", 1)} as avg_otp_pct,
  cast(sum("Passengers") as bigint) as total_passengers, cast(sum("Seats") as bigint) as total_seats
from capacity_utilization where "LoadFactor" is not null and otp_rate is not null group by 1, 2"""
)(lambda s, d: reports.season_comparison(_utilization(s, d)))

query("q10_weather_by_month", W + f"""
select "Route", "Year", "Month", {YM} as "YearMonth", avg_weather_severity, thunderstorm_count,
  precipitation_count, low_vis_count, wind_gust_count, {pct("otp_rate", 1)} as otp_pct,
  avg_arr_delay as avg_arr_delay_min, total_flights,
  case when avg_weather_severity >= 4 then 'Severe' when avg_weather_severity >= 2 then 'Moderate'
    when avg_weather_severity >= 0.5 then 'Light' else 'Clear' end as weather_category
from weather_impact""")(lambda s, d: reports.weather_by_month(_impact(s, d)))

query("q11_worst_weather_months", W + f"""
select "Year", "Month", {YM} as "YearMonth",
  {rnd("sum(avg_weather_severity * total_flights) / nullif(sum(total_flights), 0)", 8)}
    as weighted_severity,
  {pct("avg(otp_rate)", 1)} as avg_otp_pct,
  cast(sum(thunderstorm_count) as bigint) as total_thunderstorms,
  cast(sum(precipitation_count) as bigint) as total_precipitation,
  cast(sum(total_flights) as bigint) as network_flights
from weather_impact group by 1, 2 order by weighted_severity desc nulls last, 1, 2 limit 20"""
)(lambda s, d: reports.worst_weather_months(_impact(s, d)))

# ---- canned answers -----------------------------------------------------------------------------


def _by_otp(name: str, where: str = "") -> str:
    return f"""
select "Route", {pct("avg(otp_rate)", 1)} as {name},
  {rnd("avg(avg_arr_delay_min)", 1)} as avg_delay_min,
  cast(sum(operated_flights) as bigint) as total_flights
from route_performance {where} group by 1"""


query("q12_worst_otp_routes", P + _by_otp("otp_pct") + ' order by 2 nulls last, 1 limit 10')(
    lambda s, d: reports.worst_otp_routes(_performance(s, d)))
query("q13_delay_causes_by_route", C + f"""
select "Route", {rnd("avg(avg_carrier_delay)", 1)} as carrier_delay_avg,
  {rnd("avg(avg_weather_delay)", 1)} as weather_delay_avg,
  {rnd("avg(avg_nas_delay)", 1)} as nas_delay_avg,
  {rnd("avg(avg_late_ac_delay)", 1)} as late_ac_delay_avg
from delay_cause_decomposition group by 1 order by 2 desc nulls last, 1 limit 10"""
)(lambda s, d: reports.delay_causes_by_route(_causes(s, d)))
query("q14_latest_load_factors", U + f"""
select "Route", "YearMonth", {pct('"LoadFactor"', 1)} as load_factor_pct,
  {pct("otp_rate", 1)} as otp_pct, "Passengers", "Seats"
from capacity_utilization where "LoadFactor" is not null
order by "YearMonth" desc nulls last, load_factor_pct desc nulls last, "Route" limit 20"""
)(lambda s, d: reports.latest_load_factors(_utilization(s, d)))
query("q15_seasonal_load_factor", U + f"""
select "Route", case "Month" % 12 // 3 when 0 then 'Winter' when 1 then 'Spring' when 2 then 'Summer'
  else 'Fall' end as season, {pct('avg("LoadFactor")', 1)} as avg_lf_pct,
  {pct("avg(otp_rate)", 1)} as avg_otp_pct
from capacity_utilization where "LoadFactor" is not null group by 1, 2"""
)(lambda s, d: reports.seasonal_load_factor(_utilization(s, d)))
query("q16_weather_by_route", W + f"""
select "Route", {rnd("avg(avg_weather_severity)", 2)} as avg_severity,
  cast(sum(thunderstorm_count) as bigint) as thunderstorms,
  {pct("avg(otp_rate)", 1)} as avg_otp_pct, {rnd("avg(avg_arr_delay)", 1)} as avg_delay_min
from weather_impact group by 1""")(lambda s, d: reports.weather_by_route(_impact(s, d)))
query("q17_monthly_trend", S + f"""
select "YearMonth", {pct("network_otp", 1)} as otp_pct, {rnd("avg_arr_delay", 1)} as avg_delay_min,
  total_flights, cancelled_flights from monthly_otp_summary"""
)(lambda s, d: reports.monthly_trend(_summary(s, d)))
query("q18_december_by_route", P + _by_otp("avg_otp_pct", 'where "Month" = 12'))(
    lambda s, d: reports.december_by_route(_performance(s, d)))
query("q19_one_route_over_time", P + f"""
select "Year", "Month", {pct("otp_rate", 1)} as otp_pct,
  {rnd("avg_arr_delay_min", 1)} as avg_delay_min, operated_flights, delayed_flights
from route_performance where "Route" = '{ROUTE}'"""
)(lambda s, d: reports.one_route_over_time(_performance(s, d), ROUTE))
query("q20_best_otp_routes", P + _by_otp("otp_pct") + ' order by 2 desc nulls last, 1 limit 10')(
    lambda s, d: reports.best_otp_routes(_performance(s, d)))

# ---- export sheets ------------------------------------------------------------------------------
query("q21_sheet_otp_monthly", P + f"""
select "Route", "Year", "Month", {YM} as "Year-Month", total_flights as "Total Flights",
  operated_flights as "Operated Flights", cancelled_flights as "Cancelled Flights",
  {pct("cancel_rate", 2)} as "Cancel Rate %", delayed_flights as "Delayed Flights (15+ min)",
  {pct("otp_rate", 2)} as "OTP %", {rnd("avg_arr_delay_min", 1)} as "Avg Arrival Delay (min)",
  {rnd("avg_dep_delay_min", 1)} as "Avg Departure Delay (min)"
from route_performance""")(lambda s, d: reports.sheet_otp_monthly(_performance(s, d)))
query("q22_sheet_delay_causes", C + f"""
select "Route", "Year", "Month", {YM} as "Year-Month", delayed_count as "Delayed Flights",
  {rnd("avg_carrier_delay", 1)} as "Avg Carrier Delay (min)",
  {rnd("avg_weather_delay", 1)} as "Avg Weather Delay (min)",
  {rnd("avg_nas_delay", 1)} as "Avg NAS Delay (min)",
  {rnd("avg_late_ac_delay", 1)} as "Avg Late Aircraft Delay (min)",
  {rnd("avg_security_delay", 1)} as "Avg Security Delay (min)",
  {pct("carrier_delay_pct", 1)} as "Carrier Delay %",
  {pct("weather_delay_pct", 1)} as "Weather Delay %", {pct("nas_delay_pct", 1)} as "NAS Delay %",
  {pct("late_ac_delay_pct", 1)} as "Late Aircraft Delay %"
from delay_cause_decomposition""")(lambda s, d: reports.sheet_delay_causes(_causes(s, d)))
query("q23_sheet_load_factor", U + f"""
select "Route", "Year", "Month", "YearMonth" as "Year-Month",
  "DepScheduled" as "Scheduled Departures", "DepPerformed" as "Performed Departures",
  "Seats" as "Available Seats", "Passengers", {pct('"LoadFactor"', 2)} as "Load Factor %",
  {pct("otp_rate", 2)} as "OTP %", {rnd("avg_arr_delay_min", 1)} as "Avg Arrival Delay (min)"
from capacity_utilization where "LoadFactor" is not null"""
)(lambda s, d: reports.sheet_load_factor(_utilization(s, d)))
query("q24_sheet_weather_impact", W + f"""
select "Route", "Year", "Month", {YM} as "Year-Month", total_flights as "Total Flights",
  {rnd("avg_weather_severity", 2)} as "Avg Weather Severity (0-10)",
  thunderstorm_count as "Thunderstorm Flights", precipitation_count as "Precipitation Flights",
  low_vis_count as "Low Visibility Flights", wind_gust_count as "High Wind Flights",
  {pct("otp_rate", 2)} as "OTP %", {rnd("avg_arr_delay", 1)} as "Avg Arrival Delay (min)"
from weather_impact""")(lambda s, d: reports.sheet_weather_impact(_impact(s, d)))

SHEETS = {
    "otp_monthly": "Punctuality, delays and cancellations by route and month",
    "delay_causes": "Minutes and shares of delay causes by route and month",
    "load_factor": "Load factor and seats by route and month",
    "weather_impact": "Weather and punctuality by route and month",
    "demand_forecast": "Passengers, bands and seats of the next twelve months by route",
}
query("s9_export_metadata", FL + """
select 'Data Range' as "Field", strftime(min("FlightDate"), '%Y-%m-%d') || ' to '
  || strftime(max("FlightDate"), '%Y-%m-%d') as "Value" from flights
union all select 'Routes', cast(count(distinct "Route") as varchar) from flights
union all select 'Flights', cast(count(*) as varchar) from flights
""" + "".join(f"union all select '{k}', '{v}'\n" for k, v in SHEETS.items())
)(lambda s, d: reports.sheet_metadata(ad.shipments(s, d), SHEETS))

# ---- dashboard and exploration ------------------------------------------------------------------
OTP_ROWS = 'avg(case when "ArrDel15" = 0 then 1.0::double else 0.0::double end)'


def _round_all(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fixed number of digits for comparison with another engine."""
    return df.withColumns({c: rounded(F.col(f"`{c}`"), digits) for c in columns})


@query("a19_q27_kpi_row", CAP + f"""
select {rnd(OTP_ROWS + ' filter ("Cancelled" = 0) * 100', 6)} as otp_pct,
  {rnd('avg("ArrDelay") filter ("Cancelled" = 0)', 6)} as avg_arr_delay,
  {rnd('avg("Cancelled") * 100', 6)} as cancel_rate_pct, count(distinct "Route") as routes,
  (select {rnd('avg("LoadFactor") * 100', 6)} from capacity) as avg_load_factor_pct,
  (select cast(sum("Passengers") as bigint) from capacity) as total_passengers
from flights""")
def _kpi(s: SparkSession, d: str) -> DataFrame:
    flights = ad.shipments(s, d)
    return _round_all(
        dashboards.kpi_row(flights, ad.capacity(flights)),
        "otp_pct", "avg_arr_delay", "cancel_rate_pct", "avg_load_factor_pct",
    )


query("a10_q28_monthly_punctuality", FL + f"""
select "Year", "Month", count("ArrDel15") as total, count(*) filter ("ArrDel15" = 0) as ontime,
  {rnd('avg("ArrDelay")', 6)} as avg_delay, {rnd(OTP_ROWS + " * 100", 6)} as otp_pct,
  make_date("Year", "Month", 1) as period
from flights where "Cancelled" = 0 group by 1, 2"""
)(lambda s, d: _round_all(
    dashboards.monthly_punctuality(ad.shipments(s, d)), "avg_delay", "otp_pct"))
query("q29_o6_route_summary", FL + f"""
select "Route", count("ArrDel15") as operated_flights, {rnd(OTP_ROWS + " * 100", 1)} as otp_pct,
  {rnd('avg("ArrDelay")', 1)} as avg_delay_min, cast(sum("Cancelled") as bigint) as cancelled
from flights where "Cancelled" = 0 group by 1"""
)(lambda s, d: dashboards.route_summary(ad.shipments(s, d)))

MONTH_CELLS = ", ".join(
    rnd(f'{OTP_ROWS} filter ("Month" = {m}) * 100', 6) + f' as "{{}}"' for m in range(1, 13)
)
M_NAMES = [f"m{m:02d}" for m in range(1, 13)]
query("a15_q30_route_month_grid", FL + f"""
select "Route", {MONTH_CELLS.format(*M_NAMES)} from flights where "Cancelled" = 0 group by 1"""
)(lambda s, d: _round_all(dashboards.punctuality_grid(ad.shipments(s, d), "Route"), *M_NAMES))
SHORT_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
query("q37_weekday_month_grid", FL + f"""
select "DayOfWeek", {MONTH_CELLS.format(*SHORT_MONTHS)} from flights where "Cancelled" = 0
group by 1""")(lambda s, d: _round_all(
    dashboards.punctuality_grid(ad.shipments(s, d), "DayOfWeek", SHORT_MONTHS), *SHORT_MONTHS))

CAUSE_AVGS = {
    "avg_carrier": "CarrierDelay", "avg_weather": "WeatherDelay", "avg_nas": "NASDelay",
    "avg_security": "SecurityDelay", "avg_late_ac": "LateAircraftDelay",
}
query("q31_cause_means", FL + 'select "Route", ' + ", ".join(
    f"""{rnd(f'avg("{c}")', 6)} as {n}""" for n, c in CAUSE_AVGS.items()
) + """ from flights where "Cancelled" = 0 and "ArrDel15" = 1 group by 1"""
)(lambda s, d: _round_all(dashboards.cause_means(ad.shipments(s, d)), *CAUSE_AVGS))
query("q34_a16_cause_totals", FL + " union all ".join(
    f"""select '{label}' as cause, coalesce(sum("{c}"), 0) as minutes from flights
    where "Cancelled" = 0 and "ArrDel15" = 1"""
    for c, label in dashboards.CAUSE_LABELS.items()
))(lambda s, d: dashboards.cause_totals(ad.shipments(s, d)))


@query("q32_j3_a11_route_detail", CAP + f"""
select f.*, c.avg_lf_pct from (
  select "Route", count("ArrDel15") as operated, {rnd(OTP_ROWS + " * 100", 1)} as otp_pct,
    {rnd('avg("ArrDelay")', 1)} as avg_delay,
    {rnd('quantile_cont("ArrDelay", 0.75)', 1)} as p75_delay,
    {rnd('avg("CarrierDelay")', 6)} as avg_carrier, {rnd('avg("WeatherDelay")', 6)} as avg_weather
  from flights where "Cancelled" = 0 group by 1) f
left join (
  select "Route", {rnd('avg("LoadFactor") * 100', 1)} as avg_lf_pct from capacity group by 1) c
using ("Route")""")
def _detail(s: SparkSession, d: str) -> DataFrame:
    flights = ad.shipments(s, d)
    out = dashboards.route_detail(flights, ad.capacity(flights))
    return _round_all(out, "avg_carrier", "avg_weather")


query("q33_route_volume", FL + """
select "Route", count("ArrDel15") as total_flights, count(*) filter ("Cancelled" = 0) as operated,
  cast(sum("Cancelled") as bigint) as cancelled from flights group by 1"""
)(lambda s, d: dashboards.route_volume(ad.shipments(s, d)))

BIN5 = """case when weather_severity <= 0.5 then 'Clear' when weather_severity <= 2 then 'Light'
  when weather_severity <= 4 then 'Moderate' when weather_severity <= 6 then 'Significant'
  else 'Severe' end"""
BIN4 = """case when weather_severity <= 0.5 then 'Clear' when weather_severity <= 2 then 'Light'
  when weather_severity <= 4 then 'Moderate' else 'Severe' end"""
query("q35_p22_punctuality_by_severity", LW + f"""
select {BIN5} as severity_bin, {rnd(OTP_ROWS + " * 100", 6)} as otp_pct,
  {rnd('avg("ArrDelay")', 6)} as avg_delay, count("ArrDel15") as n
from legs_wx where "Cancelled" = 0 group by 1""")(lambda s, d: _round_all(
    dashboards.punctuality_by_severity(legs_with_weather(s, d)), "otp_pct", "avg_delay"))
query("q40_delay_rate_by_severity", LW + f"""
select {BIN4} as severity_bin, {rnd('avg("ArrDel15") * 100', 6)} as delay_rate,
  count("ArrDel15") as n from legs_wx where "Cancelled" = 0 group by 1"""
)(lambda s, d: _round_all(
    dashboards.delay_rate_by_severity(legs_with_weather(s, d)), "delay_rate"))
query("a13_q36_load_factor_stats", CAP + f"""
select "Route", {rnd('avg("LoadFactor")', 6)} as mean_lf,
  {rnd('stddev_samp("LoadFactor")', 6)} as std_lf, {rnd('min("LoadFactor")', 6)} as min_lf,
  {rnd('max("LoadFactor")', 6)} as max_lf from capacity group by 1"""
)(lambda s, d: _round_all(
    dashboards.load_factor_stats(_capacity(s, d)), "mean_lf", "std_lf", "min_lf", "max_lf"))
BOX = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
query("a14_q36_load_factor_boxes", CAP + 'select "Route", ' + ", ".join(
    f"""{rnd(f'quantile_cont("LoadFactor", {p})', 6)} as {n}""" for n, p in BOX.items()
) + " from capacity group by 1")(lambda s, d: _round_all(
    dashboards.load_factor_boxes(_capacity(s, d)), *BOX))
query("q38_exploration_summary", FL + f"""
select count(*) as total_flights, count(*) filter ("Cancelled" = 0) as operated_flights,
  cast(sum("Cancelled") as bigint) as cancelled_flights,
  {rnd(OTP_ROWS + ' filter ("Cancelled" = 0) * 100', 6)} as otp_pct,
  {rnd('avg("ArrDelay") filter ("Cancelled" = 0)', 6)} as avg_arr_delay,
  count(distinct "Route") as routes, min("FlightDate") as first_date, max("FlightDate") as last_date
from flights""")(lambda s, d: _round_all(
    dashboards.exploration_summary(ad.shipments(s, d)), "otp_pct", "avg_arr_delay"))
query("q39_delay_rate_by_hour", FL + f"""
select "DepHour" as hour_of_day, {rnd('avg("ArrDel15") * 100', 6)} as delay_rate
from flights where "Cancelled" = 0 group by 1""")(lambda s, d: _round_all(
    dashboards.delay_rate_by_hour(ad.shipments(s, d)), "delay_rate"))
query("q42_load_check", FL + """
select count(*) as flights, count(distinct "Route") as routes from flights"""
)(lambda s, d: dashboards.load_check(ad.shipments(s, d)))
query("q42_flights_per_route", FL + 'select "Route", count(*) as n from flights group by 1')(
    lambda s, d: dashboards.flights_per_route(ad.shipments(s, d)))

# ---- operators behind the reports ---------------------------------------------------------------
query("a1_group_aggregates", FL + """
select "Route", count(*) as n, count("ArrDelay") as n_known, sum("DepDelay") as sum_dep,
  """ + rnd('avg("DepDelay")', 6) + """ as avg_dep, min("ArrDelay") as min_arr,
  max("ArrDelay") as max_arr from flights group by 1"""
)(lambda s, d: ad.shipments(s, d).groupBy("Route").agg(
    F.count("*").alias("n"), F.count("ArrDelay").alias("n_known"),
    F.sum("DepDelay").alias("sum_dep"), rounded(F.avg("DepDelay"), 6).alias("avg_dep"),
    F.min("ArrDelay").alias("min_arr"), F.max("ArrDelay").alias("max_arr")))
query("a2_a3_a4_conditional_aggregates", P + """
select "Route", "Year", "Month", operated_flights, delayed_flights, otp_rate, avg_arr_delay_min
from route_performance""")(lambda s, d: _performance(s, d).select(
    "Route", "Year", "Month", "operated_flights", "delayed_flights", "otp_rate",
    "avg_arr_delay_min"))
query("a5_cause_shares", C + """
select "Route", "Year", "Month", carrier_delay_pct, weather_delay_pct, nas_delay_pct,
  late_ac_delay_pct from delay_cause_decomposition""")(lambda s, d: _causes(s, d).select(
    "Route", "Year", "Month", "carrier_delay_pct", "weather_delay_pct", "nas_delay_pct",
    "late_ac_delay_pct"))
query("a1_performance_rollup", FL + f"""
select "Route", "Year", "Month", grouping("Route", "Year", "Month") as level, count(*) as flights,
  count(distinct "Tail_Number") as vehicles, {rnd('sum("DepDelay") / nullif(count("DepDelay"), 0)', 6)} as avg_dep_delay
from flights group by rollup ("Route", "Year", "Month")""")(
    lambda s, d: views.performance_rollup(ad.shipments(s, d)))
query("a6_distinct_routes", S + 'select "Year", "Month", routes_operated from monthly_otp_summary')(
    lambda s, d: _summary(s, d).select("Year", "Month", "routes_operated"))
query("a7_mean_of_monthly_means", P + f"""
select "Route", {rnd("avg(avg_arr_delay_min)", 1)} as mean_of_months,
  cast(sum(operated_flights) as bigint) as flights from route_performance group by 1"""
)(lambda s, d: _performance(s, d).groupBy("Route").agg(
    rounded(F.avg("avg_arr_delay_min"), 1).alias("mean_of_months"),
    F.sum("operated_flights").alias("flights")))
query("a8_weighted_mean", W + f"""
select "Year", "Month",
  {rnd("sum(avg_weather_severity * total_flights) / nullif(sum(total_flights), 0)", 6)}
    as weighted_severity from weather_impact group by 1, 2"""
)(lambda s, d: _impact(s, d).groupBy("Year", "Month").agg(rounded(
    weighted_mean("avg_weather_severity", "total_flights"), 6).alias("weighted_severity")))


@query("a9_group_by_alias", U + f"""
select "Route", {LONG_SEASON} as season, count(*) as months from capacity_utilization group by 1, 2""")
def _alias(s: SparkSession, d: str) -> DataFrame:
    _utilization(s, d).createOrReplaceTempView("capacity_utilization")
    out, error = catalog.run_sql(s, """
        SELECT Route, CASE WHEN Month IN (6, 7, 8) THEN 'Summer (Jun-Aug)'
            WHEN Month IN (12, 1, 2) THEN 'Winter (Dec-Feb)'
            WHEN Month IN (3, 4, 5) THEN 'Spring (Mar-May)' ELSE 'Fall (Sep-Nov)' END AS season,
            count(*) AS months
        FROM capacity_utilization GROUP BY Route, season""")
    if out is None:
        raise RuntimeError(error)
    return out


query("a17_delay_histogram", FL + """,
ends as (select min("ArrDelay") as lo, max("ArrDelay") as hi from flights)
select cast(least(floor(("ArrDelay" - lo) / ((hi - lo) / 60)) + 1, 60) as integer) as bin,
  """ + rnd("any_value(lo) + (any_value(hi) - any_value(lo)) / 60 * (least(floor((\"ArrDelay\" - lo) / ((hi - lo) / 60)) + 1, 60) - 1)", 6) + """ as bin_low,
  """ + rnd("any_value(lo) + (any_value(hi) - any_value(lo)) / 60 * least(floor((\"ArrDelay\" - lo) / ((hi - lo) / 60)) + 1, 60)", 6) + """ as bin_high, count(*) as n
from flights, ends where "ArrDelay" is not null
group by least(floor(("ArrDelay" - lo) / ((hi - lo) / 60)) + 1, 60)"""
)(lambda s, d: _round_all(
    whatif.histogram(ad.shipments(s, d), "ArrDelay", 60), "bin_low", "bin_high"))
query("a20_result_summary", P + f"""
select count(*) as n_rows, 'otp_pct' as column_name, min(otp_pct) as min_value,
  max(otp_pct) as max_value from ({_by_otp("otp_pct")} order by 2 nulls last, 1 limit 10)"""
)(lambda s, d: reports.result_summary(reports.worst_otp_routes(_performance(s, d))))
@query("o3_o4_top_k_nulls_last", P + """
select "Route", "Dest", "Year", "Month", otp_rate, avg_arr_delay_min from route_performance
order by avg_arr_delay_min asc nulls last, otp_rate desc nulls last, "Route", "Year", "Month"
limit 25""")
def _top_k(s: SparkSession, d: str) -> DataFrame:
    return _performance(s, d).select(
        "Route", "Dest", "Year", "Month", "otp_rate", "avg_arr_delay_min"
    ).orderBy(
        reports.up("avg_arr_delay_min"), reports.down("otp_rate"), "Route", "Year", "Month"
    ).limit(25)


@query("o5_head", FL + """
select "Route", sum("DepDelay") as s from flights group by 1 order by 2 desc nulls last, 1 limit 15""")
def _head(s: SparkSession, d: str) -> DataFrame:
    return ad.shipments(s, d).groupBy("Route").agg(F.sum("DepDelay").alias("s")).orderBy(
        reports.down("s"), "Route").limit(15)


query("u2_distinct_routes", FL + 'select distinct "Route" from flights')(
    lambda s, d: ad.shipments(s, d).select("Route").distinct())


@query("u1_concat_reports", P + """
select 'worst' as report, "Route", otp_pct from (""" + _by_otp("otp_pct") + """
  order by 2 nulls last, 1 limit 10)
union all select 'best', "Route", otp_pct from (""" + _by_otp("otp_pct") + """
  order by 2 desc nulls last, 1 limit 10)""")
def _concat(s: SparkSession, d: str) -> DataFrame:
    p = _performance(s, d)
    worst = reports.worst_otp_routes(p).select(F.lit("worst").alias("report"), "Route", "otp_pct")
    best = reports.best_otp_routes(p).select(F.lit("best").alias("report"), "Route", "otp_pct")
    return worst.unionByName(best)


query("p18_p19_filtered_routes", FL + f"""
select "Route", count(*) as n from flights
where "Cancelled" = 0 and "ArrDel15" = 1 and "Route" in ('{ROUTE}', 'NATION_1-EUROPE') group by 1"""
)(lambda s, d: dashboards.delayed_only(
    dashboards.operated(ad.shipments(s, d), [ROUTE, "NATION_1-EUROPE"])
).groupBy("Route").agg(F.count("*").alias("n")))
query("p21_weather_category", W + """
select case when avg_weather_severity >= 4 then 'Severe' when avg_weather_severity >= 2
  then 'Moderate' when avg_weather_severity >= 0.5 then 'Light' else 'Clear' end as category,
  count(*) as n from weather_impact group by 1"""
)(lambda s, d: _impact(s, d).groupBy(
    reports.weather_category("avg_weather_severity").alias("category")
).agg(F.count("*").alias("n")))
query("p20_p24_completion_loss", U + f"""
select "Route", "YearMonth",
  {pct('(1 - "DepPerformed"::double / nullif("DepScheduled", 0))', 2)} as loss_pct
from capacity_utilization where "LoadFactor" is not null"""
)(lambda s, d: reports.capacity_efficiency(_utilization(s, d)).select(
    "Route", "YearMonth", F.col("completion_factor_loss_pct").alias("loss_pct")))


@query("s6_s7_sql_over_views", S + """
select "YearMonth", total_flights, routes_operated from monthly_otp_summary""")
def _sql_views(s: SparkSession, d: str) -> DataFrame:
    flights = ad.shipments(s, d).withColumns({
        c: F.lit(0) for c in (
            "weather_severity", "thunderstorm_flag", "precipitation_flag", "low_visibility_flag",
            "wind_gust_flag")
    })
    catalog.register_views(s, flights, ad.capacity(flights), ad.weather(s, d))
    out, error = catalog.run_sql(
        s, "SELECT YearMonth, total_flights, routes_operated FROM monthly_otp_summary")
    if out is None:
        raise RuntimeError(error)
    return out


@query("a18_q41_error_profile", with_sql(LEGS_WEATHER) + f"""
select case when "ArrDel15" = 0 and p = 1 then 'False Positive'
  when "ArrDel15" = 1 and p = 0 then 'False Negative'
  when "ArrDel15" = 1 and p = 1 then 'True Positive' else 'True Negative' end as error_type,
  count(*) as n, {rnd("avg(weather_severity)", 6)} as avg_weather_severity,
  {rnd('avg("DepHour")', 6)} as "avg_DepHour"
from (select *, case when weather_severity >= 2 then 1 else 0 end as p from legs_wx
  where "Cancelled" = 0) group by 1""")
def _errors(s: SparkSession, d: str) -> DataFrame:
    flown = dashboards.operated(legs_with_weather(s, d))
    predicted = with_prediction(flown, "weather_severity", threshold=2.0)
    out = dashboards.error_profile(predicted, ["weather_severity", "DepHour"], label="ArrDel15")
    return _round_all(out, "avg_weather_severity", "avg_DepHour")



# ---- mergeable summaries ------------------------------------------------------------------------
def _sketched(s: SparkSession, d: str) -> DataFrame:
    """Per route and year, from merged monthly sketches: whether the answers are inside the stated errors."""
    keys, shares = ["Route", "Year"], {"p10": 0.1, "p75": 0.75, "p90": 0.9}
    flights = ad.shipments(s, d).select("Route", "Year", "Month", "Tail_Number", "ArrDelay")
    monthly = stage(sketches.build(flights, [*keys, "Month"], ["Tail_Number"], ["ArrDelay"]))
    merged = sketches.answers(
        sketches.merge(monthly, keys), keys, {n: ("ArrDelay", p) for n, p in shares.items()}
    ).withColumnRenamed("Tail_Number_distinct", "tails")
    # Exact counts of the same rows: vehicles, and the share of delays below and up to each answer.
    exact = flights.groupBy(*keys, "Tail_Number", "ArrDelay").agg(F.count("ArrDelay").alias("n"))
    known = F.nullif(F.sum("n"), F.lit(0))
    checks = exact.join(merged, keys).groupBy(*keys, "n_rows", "tails").agg(
        F.count_distinct("Tail_Number").alias("_tails"), F.sum("n").alias("known"),
        *[F.greatest(
            F.sum(F.when(F.col("ArrDelay") < F.col(n), F.col("n")).otherwise(0)) / known - F.lit(p),
            F.lit(p) - F.sum(F.when(F.col("ArrDelay") <= F.col(n), F.col("n")).otherwise(0)) / known,
        ).alias(n) for n, p in shares.items()],
    )
    # Twice the stated error at 99 %, and five standard deviations: no answer of thousands is outside.
    bound = 2 * sketches.rank_error()
    return checks.select(
        *keys, "n_rows", "known",
        (F.abs(F.col("tails") / F.col("_tails") - 1) <= 5 * sketches.distinct_error()).alias("tails_inside"),
        *[(F.col(n) <= bound).alias(f"{n}_inside") for n in shares],
    )


query("a6_a11_a12_sketches", FL + """
select "Route", "Year", count(*) as n_rows, count("ArrDelay") as known, true as tails_inside,
  true as p10_inside, true as p75_inside, true as p90_inside
from flights group by 1, 2""")(_sketched)
