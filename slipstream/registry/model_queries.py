"""Score evaluation, data checks, forecasts, what-if and the classifier over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import rounded
from slipstream.operators import classifier, forecast, ordered, quality, scoring, whatif
from slipstream.operators.staging import shared_folder, stage
from slipstream.plans import reports
from slipstream.registry.base import (
    LEGS, SHIPMENTS, WEATHER, capacity_sql, query, rnd, with_sql,
)
from slipstream.registry.feature_queries import SCORED_SQL, TAU, leg_features, scored_legs
from slipstream.registry.report_queries import legs_with_weather
from slipstream.sources import adapters as ad

FL, LG = with_sql(SHIPMENTS), with_sql(LEGS)


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rounded(c, digits) for c in columns})


# ---- exact evaluation of scores -----------------------------------------------------------------
STEPS_SQL = SCORED_SQL + """,
steps as (
  select score, pos, neg, sum(pos) over w as tp, sum(neg) over w as fp,
    sum(pos) over () as n_pos, sum(neg) over () as n_neg
  from (select score, count(*) filter (label = 1) as pos, count(*) filter (label <> 1) as neg
    from scored group by 1)
  window w as (order by score desc))"""


def _steps(s: SparkSession, d: str) -> DataFrame:
    return scoring.score_steps(stage(scored_legs(s, d)))


query("w8_roc_points", with_sql(STEPS_SQL) + f"""
select score as threshold, {rnd("fp / n_neg", 6)} as fpr, {rnd("tp / n_pos", 6)} as tpr from steps
union all select null, 0.0::double, 0.0::double"""
)(lambda s, d: _rounded(scoring.roc_points(_steps(s, d)), ["fpr", "tpr"]))
query("w8_precision_recall_points", with_sql(STEPS_SQL) + f"""
select score as threshold, {rnd("tp / (tp + fp)", 6)} as precision,
  {rnd("tp / n_pos", 6)} as recall from steps
union all select null, 1.0::double, 0.0::double"""
)(lambda s, d: _rounded(scoring.pr_points(_steps(s, d)), ["precision", "recall"]))

EVALUATION_SQL = STEPS_SQL + f""",
evaluation as (
  select (select {rnd("sum(neg * (tp - pos / 2)) / (any_value(n_pos) * any_value(n_neg))", 6)}
      from steps) as auc_roc,
    (select {rnd("sum(pos * (tp / (tp + fp))) / any_value(n_pos)", 6)} from steps)
      as average_precision,
    {rnd("2 * count(*) filter (label = 1 and score >= {t}) / (2 * count(*) filter (label = 1 and score >= {t}) + count(*) filter (label = 0 and score >= {t}) + count(*) filter (label = 1 and score < {t}))", 6).replace("{t}", "0.5")} as f1_score,
    count(*) filter (label = 0 and score < 0.5) as true_negatives,
    count(*) filter (label = 0 and score >= 0.5) as false_positives,
    count(*) filter (label = 1 and score < 0.5) as false_negatives,
    count(*) filter (label = 1 and score >= 0.5) as true_positives
  from scored)"""
METRICS = ["auc_roc", "average_precision", "f1_score"]


def _evaluation(s: SparkSession, d: str) -> DataFrame:
    return _rounded(scoring.evaluation(stage(scored_legs(s, d))), METRICS)


query("m7_evaluation", with_sql(EVALUATION_SQL) + "select * from evaluation")(_evaluation)
query("m7_a18_confusion", with_sql(SCORED_SQL) + """
select label as actual, (score >= 0.5)::int as predicted, count(*) as n,
  case when label = 0 and score >= 0.5 then 'False Positive'
    when label = 1 and score < 0.5 then 'False Negative'
    when label = 1 and score >= 0.5 then 'True Positive' else 'True Negative' end as error_type
from scored group by 1, 2, 4""")(lambda s, d: scoring.confusion(
    scoring.with_prediction(scored_legs(s, d))))
REPORT_SQL = SCORED_SQL + """,
cells as (
  select count(*) filter (label = 1 and score >= 0.5)::double as tp,
    count(*) filter (label = 0 and score >= 0.5)::double as fp,
    count(*) filter (label = 1 and score < 0.5)::double as fn,
    count(*) filter (label = 0 and score < 0.5)::double as tn from scored),
classes as (
  select '0' as class, tn / (tn + fn) as p, tn / (tn + fp) as r, 2 * tn / (2 * tn + fn + fp) as f,
    tn + fp as support, (tp + tn) / (tp + tn + fp + fn) as acc from cells
  union all
  select '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn,
    (tp + tn) / (tp + tn + fp + fn) from cells)"""


def _report_row(name: str, p: str, r: str, f: str, support: str, group: str = "") -> str:
    return f"""select {name} as class, {rnd(p, 6)} as precision, {rnd(r, 6)} as recall,
  {rnd(f, 6)} as f1_score, cast({support} as bigint) as support from classes {group}
"""


query("m7_class_report", with_sql(REPORT_SQL) + "union all ".join([
    _report_row("class", "p", "r", "f", "support"),
    _report_row("'accuracy'", *["any_value(acc)"] * 3, "sum(support)"),
    _report_row("'macro avg'", "avg(p)", "avg(r)", "avg(f)", "sum(support)"),
    _report_row("'weighted avg'", *[f"sum({c} * support) / sum(support)" for c in "prf"],
                "sum(support)"),
]))(lambda s, d: _rounded(
    scoring.class_report(scoring.with_prediction(scored_legs(s, d))),
    ["precision", "recall", "f1_score"]))


@query("m11_quality_gates", with_sql(EVALUATION_SQL) + """,
storm as (
  select avg(score) filter (thunderstorm_flag = 1) > avg(score) filter (thunderstorm_flag = 0) as ok
  from scored join legs_wx using (event_id))
select auc_roc, f1_score, auc_roc >= 0.75 as auc_ok, f1_score >= 0.4 as f1_ok, ok as storm_ok,
  auc_roc >= 0.75 and f1_score >= 0.4 and ok as release
from evaluation, storm""")
def _gates(s: SparkSession, d: str) -> DataFrame:
    scored = stage(scored_legs(s, d))
    storms = legs_with_weather(s, d).select("event_id", "thunderstorm_flag")
    by_weather = scored.join(storms, "event_id").agg(
        F.avg(F.when(F.col("thunderstorm_flag") == 1, F.col("score"))).alias("storm"),
        F.avg(F.when(F.col("thunderstorm_flag") == 0, F.col("score"))).alias("clear"),
    )
    metrics = _rounded(scoring.evaluation(scored), METRICS)
    return scoring.quality_gates(
        metrics, by_weather.select("storm").scalar(), by_weather.select("clear").scalar()
    )


THRESHOLDS = (0.3, 0.4, 0.5)


def _f1_sql(t: float) -> str:
    hit = f"count(*) filter (label = 1 and score >= {t})"
    miss = f"count(*) filter (label = 0 and score >= {t}) + count(*) filter (label = 1 and score < {t})"
    return f"select 'threshold-{t}' as run_id, {rnd(f'2 * {hit} / (2 * {hit} + {miss})', 6)} as f1_score from scored"


@query("m10_w11_best_run", with_sql(SCORED_SQL) + f"""
select run_id, f1_score from ({" union all ".join(_f1_sql(t) for t in THRESHOLDS)})
order by f1_score desc, run_id limit 1""")
def _best_run(s: SparkSession, d: str) -> DataFrame:
    scored = stage(scored_legs(s, d))
    path = f"{shared_folder(s)}/runs-{uuid.uuid4().hex}"
    for t in THRESHOLDS:
        metrics = scoring.evaluation(scored, threshold=t)
        quality.log_run(s, path, f"threshold-{t}", metrics, {"threshold": t}, 6)
    best = quality.best_run(quality.read_runs(s, path), "f1_score")
    return best.select("run_id", rounded("f1_score", 6).alias("f1_score"))


# ---- data checks --------------------------------------------------------------------------------
CHECKED = (
    "FlightDate", "Tail_Number", "Origin", "Dest", "Route", "CRSDepTime", "Cancelled", "DepDelay", "ArrDelay",
    "ArrDel15", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay", "Distance",
    "AirTime", "Year", "Month", "DepHour",
)
query("m12_null_rates", FL + " union all ".join(
    f"""select '{c}' as column_name, count(*) as rows, count(*) filter ("{c}" is null) as nulls,
  count(*) filter ("{c}" is null)::double / count(*) as null_rate from flights"""
    for c in CHECKED))(lambda s, d: quality.null_rates(ad.shipments(s, d), CHECKED))
query("m12_rule_violations", FL + """
select 'delay_in_range' as rule, count(*) filter (not "DepDelay" between -30 and 500) as violations
from flights union all
select 'hour_in_range', count(*) filter (not "DepHour" between 0 and 23) from flights union all
select 'cause_known_when_late', count(*) filter ("ArrDel15" = 1 and "LateAircraftDelay" is null)
from flights""")(lambda s, d: quality.rule_violations(ad.shipments(s, d), {
    "delay_in_range": F.col("DepDelay").between(-30, 500),
    "hour_in_range": F.col("DepHour").between(0, 23),
    "cause_known_when_late": ~(
        (F.col("ArrDel15") == 1) & F.col("LateAircraftDelay").isNull()
    ),
}))
@query("m12_route_coverage", """
select c_custkey from customer where not exists (select 1 from events where user_id = c_custkey)""")
def _coverage(s: SparkSession, d: str) -> DataFrame:
    """Customers without any event."""
    users = ad.table(s, d, "events").select(F.col("user_id").alias("c_custkey"))
    return quality.missing_keys(ad.table(s, d, "customer"), users, "c_custkey")


query("s11_freshness", with_sql(SHIPMENTS, LEGS, WEATHER) + """
select 'flights' as dataset, count(*) as rows, max("FlightDate") as latest,
  count(distinct "Route") as distinct_keys from flights union all
select 'legs', count(*), max("FlightDate"), count(distinct "Tail_Number") from legs union all
select 'weather', count(*), cast(max(valid) as date), count(distinct station) from weather"""
)(lambda s, d: quality.freshness({
    "flights": (ad.shipments(s, d), "FlightDate", "Route"),
    "legs": (ad.legs(s, d), "FlightDate", "Tail_Number"),
    "weather": (ad.weather(s, d), "valid", "station"),
}))
query("s11_file_freshness")(lambda s, d: quality.file_freshness(
    s, {t: f"{d}/{t}.parquet" for t in ("lineitem", "orders", "events")}))

# ---- percentiles of any column ------------------------------------------------------------------
query("a11_a12_percentiles_by_rank", FL + f"""
select "Route", {rnd("quantile_cont(l_extendedprice, 0.1)", 6)} as p10,
  {rnd("quantile_cont(l_extendedprice, 0.9)", 6)} as p90 from flights group by 1"""
)(lambda s, d: _rounded(ordered.percentiles(
    ad.shipments(s, d), ["Route"], "l_extendedprice", {"p10": 0.1, "p90": 0.9}), ["p10", "p90"]))

# ---- forecast -----------------------------------------------------------------------------------
SPINE_SQL = """
known as (
  select "Route" as route, make_date("Year", "Month", 1) as period, "Passengers"::double as x,
    "Seats"::double as seats from capacity),
spans as (
  select route, min(period) as first, max(period) as last from known group by 1 having count(*) >= 12),
spine as (
  select route, first, last, unnest(generate_series(first, last, interval 1 month))::date as period
  from spans),
panel as materialized (
  select s.route, s.period, cast(month(s.period) as integer) as month,
    cast(date_diff('month', first, s.period) as integer) as t,
    cast(date_diff('month', first, last) + 1 as integer) as n, x, seats
  from spine s left join known k on k.route = s.route and k.period = s.period)"""
PANEL_SQL = SHIPMENTS + "," + capacity_sql("Origin") + "," + SPINE_SQL
PARTS_SQL = """,
around as (
  select *, last_value(case when x is not null then t end ignore nulls) over (w rows between unbounded preceding and 1 preceding) as et,
    last_value(x ignore nulls) over (w rows between unbounded preceding and 1 preceding) as ex,
    first_value(case when x is not null then t end ignore nulls) over (w rows between 1 following and unbounded following) as lt,
    first_value(x ignore nulls) over (w rows between 1 following and unbounded following) as lx
  from panel where n >= 24 window w as (partition by route order by t)),
filled as (select *, coalesce(x, ex + (lx - ex) * (t - et) / (lt - et)) as xx from around),
smoothed as (
  select *, case when t between 6 and n - 7 then (
      sum(xx) over (s rows between 6 preceding and 6 following)
      + sum(xx) over (s rows between 5 preceding and 5 following)) / 24 end as smooth
  from filled window s as (partition by route order by t)),
ends as (
  select route,
    regr_slope(smooth, t) filter (t >= 6 and t < least(18, n - 7)) as hs,
    regr_intercept(smooth, t) filter (t >= 6 and t < least(18, n - 7)) as hi,
    regr_slope(smooth, t) filter (t >= greatest(6, n - 19) and t < n - 7) as ts,
    regr_intercept(smooth, t) filter (t >= greatest(6, n - 19) and t < n - 7) as ti
  from smoothed group by 1),
season_raw as (select route, month, avg(x - smooth) as m from smoothed group by 1, 2),
season as (select route, month, m - avg(m) over (partition by route) as seasonal from season_raw
  where m is not null),
parts as (
  select s.route, s.period, s.month, s.t, s.n, s.x,
    coalesce(s.smooth, case when s.t < 6 then hi + hs * s.t else ti + ts * s.t end) as trend,
    seasonal
  from smoothed s join ends using (route) left join season using (route, month))"""
DECOMPOSE_SQL = PANEL_SQL + PARTS_SQL


def _panel(s: SparkSession, d: str) -> DataFrame:
    return forecast.monthly_panel(ad.capacity(ad.shipments(s, d), "Origin"))


query("t1_monthly_panel", with_sql(PANEL_SQL) + "select * from panel")(_panel)
query("t1_short_series", """
select o_custkey as route, count(distinct (year(o_orderdate), month(o_orderdate))) as months
from orders group by 1 having months < 12"""
)(lambda s, d: forecast.short_series(ad.table(s, d, "orders").select(
    "o_custkey", F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month")), "o_custkey"))
query("t2_w9_decomposition", with_sql(DECOMPOSE_SQL) + f"""
select route, period, month, t, n, x, {rnd("trend", 4)} as trend, {rnd("seasonal", 4)} as seasonal,
  {rnd("x - trend - seasonal", 4)} as resid from parts"""
)(lambda s, d: _rounded(forecast.decompose(_panel(s, d)), ["trend", "seasonal", "resid"], 4))
RATIO_SQL = """,
ratios as (select route, avg(seats / nullif(x, 0)) as seats_per_pax from panel where t >= n - 3
  group by 1)"""
query("w10_seats_per_passenger", with_sql(PANEL_SQL + RATIO_SQL) + f"""
select route, {rnd("seats_per_pax", 6)} as seats_per_pax from ratios"""
)(lambda s, d: _rounded(forecast.seats_per_passenger(_panel(s, d)), ["seats_per_pax"]))

FIT_SQL = DECOMPOSE_SQL + RATIO_SQL + """,
index as (select route, month, max(seasonal) as seasonal from parts group by 1, 2),
level as (
  select p.*, x - coalesce(seasonal, 0) as y from panel p left join index using (route, month)),
lines as (
  select route, max(period) as last_period, max(n) as n, regr_slope(y, t) as slope,
    regr_intercept(y, t) as intercept,
    sqrt(greatest(var_pop(y) - regr_slope(y, t) * covar_pop(y, t), 0)) as sigma
  from level group by 1)"""
PATH_SQL = FIT_SQL + """,
ahead as (
  select *, cast(last_period + to_months(h) as date) as period
  from lines, (select unnest(range(1, 13))::int as h)),
path as (
  select a.route, h, a.period,
    intercept + slope * (n - 1 + h) + coalesce(seasonal, 0) as f, sigma
  from ahead a left join index i on i.route = a.route and i.month = month(a.period))"""


def _whole(x: str) -> str:
    return f"cast(round_even({x}, 0) as bigint)"


def _forecast_sql(path: str, source: str = "path") -> str:
    return path + f""",
forecast as (
  select period, route, {_whole("greatest(f, 0)")} as forecast_passengers,
    {_whole("greatest(f - 1.28::double * sigma * sqrt(h), 0)")} as lower_80,
    {_whole("f + 1.28::double * sigma * sqrt(h)")} as upper_80,
    {_whole("greatest(f - 1.96::double * sigma * sqrt(h), 0)")} as lower_95,
    {_whole("f + 1.96::double * sigma * sqrt(h)")} as upper_95,
    {_whole("greatest(f, 0) * seats_per_pax")} as forecast_seats,
    case when greatest(f, 0) * seats_per_pax > 0
      then {rnd("greatest(f, 0) / (greatest(f, 0) * seats_per_pax)", 4)} end as forecast_lf
  from {source} left join ratios using (route))"""


FORECAST_SQL = _forecast_sql(PATH_SQL)


def _forecast(model: str):
    def build(s: SparkSession, d: str) -> DataFrame:
        return forecast.forecast(
            ad.capacity(ad.shipments(s, d), "Origin"), horizon=12, model=model
        )

    return build


query("t4_t5_t7_trend_season_forecast", with_sql(FORECAST_SQL) + "select * from forecast")(
    _forecast("trend_season"))
query("q26_sheet_demand_forecast", with_sql(FORECAST_SQL) + """
select route as "Route", period as "Forecast Month", forecast_passengers as "Forecast Passengers",
  lower_80 as "Lower Bound (80% CI)", upper_80 as "Upper Bound (80% CI)",
  lower_95 as "Lower Bound (95% CI)", upper_95 as "Upper Bound (95% CI)",
  forecast_seats as "Forecast Seats", forecast_lf as "Forecast Load Factor" from forecast"""
)(lambda s, d: reports.sheet_demand_forecast(_forecast("trend_season")(s, d)))


def _values(numbers) -> str:
    return ", ".join(f"({v}::double)" for v in numbers)


G = forecast.DEFAULT_GRID
_CLIP = f"least(greatest({{}}, {forecast.LOWEST}::double), {forecast.HIGHEST}::double)"


def _fold_sql(name: str, source: str) -> str:
    """Smoothing of every series under the settings (route, place, alpha, beta, gamma) of a table."""
    return f"""
{name} as (
  select p.route, place, alpha, beta, gamma, 0 as i, m1 as level, coalesce((m2 - m1) / 12, 0) as trend,
    list_transform(xs, lambda v: coalesce(v - m1, 0)) as season, 0.0::double as sse, 0.0::double as se
  from {source} s join year1 p on p.route = s.route left join year2 y on y.route = s.route
  union all
  select route, place, alpha, beta, gamma, i + 1, new_level,
    case when x is null then trend else beta * (new_level - level) + (1 - beta) * trend end,
    list_append(season[2:12], coalesce(gamma * (x - (level + trend)) + (1 - gamma) * season[1], season[1])),
    sse + coalesce(e * e, 0), se + coalesce(e, 0)
  from (
    select f.*, p.x, p.x - (f.level + f.trend + f.season[1]) as e,
      coalesce(f.alpha * (p.x - f.season[1]) + (1 - f.alpha) * (f.level + f.trend), f.level + f.trend) as new_level
    from {name} f join panel p on p.route = f.route and p.t = f.i))"""


def _search_sql(rounds: int) -> str:
    """Rounds of the search: the centre or the best of its neighbours, by error and settings."""
    moves = ", ".join(f"({a}, {b}, {g})" for a, b, g in forecast.DIRECTIONS)
    out = f""",
at_0 as materialized (
  select route, place, alpha, beta, gamma, sse, {forecast.FIRST_STEP}::double as step
  from (select route, alpha, beta, gamma, sse, row_number() over (
      partition by route order by sse, alpha, beta, gamma) as place
    from grid_fold f join spread using (route) where f.i = spread.n)
  where place <= {forecast.STARTS})"""
    for k in range(1, rounds + 1):
        settings = ", ".join(_CLIP.format(f"{c} + d{c} * step") + f" as {c}" for c in ("alpha", "beta", "gamma"))
        out += f""",
near_{k} as materialized (select route, place, {settings} from at_{k - 1},
  (values {moves}) d(dalpha, dbeta, dgamma)),""" + _fold_sql(f"fold_{k}", f"near_{k}") + f""",
at_{k} as materialized (
  select route, place, b.alpha, b.beta, b.gamma, b.sse, case when moved then step else step / 2 end as step
  from (
    select route, place, step, c <> o as moved, c as b from (
      select a.route, a.place, any_value(a.step) as step,
        any_value({{'sse': a.sse, 'alpha': a.alpha, 'beta': a.beta, 'gamma': a.gamma}}) as o,
        min(least({{'sse': f.sse, 'alpha': f.alpha, 'beta': f.beta, 'gamma': f.gamma}},
          {{'sse': a.sse, 'alpha': a.alpha, 'beta': a.beta, 'gamma': a.gamma}})) as c
      from at_{k - 1} a join fold_{k} f using (route, place) join spread using (route)
      where f.i = spread.n group by 1, 2)))"""
    return out


def smoothing_sql(rounds: int = forecast.SEARCH_ROUNDS) -> str:
    return f""",
spread as materialized (
  select route, max(period) as last_period, max(n) as n, count(x) as known from panel group by 1),
year1 as materialized (
  select route, avg(x) as m1, list(x order by t) as xs from panel where t < 12 group by 1),
year2 as materialized (
  select route, avg(x) as m2 from panel where t between 12 and 23 and n >= 24 group by 1),
grid as (select route, 0 as place, alpha, beta, gamma from spread, (values {_values(G["alpha"])}) a(alpha),
    (values {_values(G["beta"])}) b(beta), (values {_values(G["gamma"])}) g(gamma)),
""" + _fold_sql("grid_fold", "grid") + _search_sql(rounds) + f""",
won as materialized (
  select route, 0 as place, alpha, beta, gamma from (
    select *, row_number() over (partition by route order by sse, alpha, beta, gamma) as k from at_{rounds})
  where k = 1),
""" + _fold_sql("won_fold", "won") + """,
best as (select f.*, last_period, n, known from won_fold f join spread using (route) where i = n),
path as (
  select route, h, cast(last_period + to_months(h) as date) as period,
    level + h * trend + season[(h - 1) % 12 + 1] as f,
    sqrt(greatest(sse / known - (se / known) * (se / known), 0)) as sigma
  from best, (select unnest(range(1, 13))::int as h))"""


SMOOTHING_SQL = PANEL_SQL + RATIO_SQL + smoothing_sql()


def recursive_sql(*parts: str) -> str:
    return with_sql(*parts).replace("with ", "with recursive ", 1)


query("t3_t6_holt_winters_forecast", recursive_sql(_forecast_sql(SMOOTHING_SQL)) + """
select * from forecast""")(_forecast("holt_winters"))
FIT_ROWS = f"""
select route, {rnd("alpha", 6)} as alpha, {rnd("beta", 6)} as beta, {rnd("gamma", 6)} as gamma,
  {rnd("level", 4)} as level, {rnd("trend", 4)} as trend, {rnd("sse", 2)} as sse from best"""


def _fit_rows(panel: DataFrame) -> DataFrame:
    out = forecast.fit_holt_winters(stage(panel)).select(
        "route", "alpha", "beta", "gamma", "level", "trend", "sse")
    return _rounded(_rounded(_rounded(out, ["alpha", "beta", "gamma"]), ["level", "trend"], 4), ["sse"], 2)


query("t3_holt_winters_fit", recursive_sql(SMOOTHING_SQL) + FIT_ROWS)(
    lambda s, d: _fit_rows(_panel(s, d)))

# Orders of customers leave most months out: series with gaps.
CUSTOMER_SQL = """
capacity as (
  select o_custkey as "Route", cast(year(o_orderdate) as integer) as "Year",
    cast(month(o_orderdate) as integer) as "Month",
    cast(sum(cast(floor(o_totalprice / 1000) as bigint)) as bigint) as "Passengers", count(*) * 60 as "Seats"
  from orders group by 1, 2, 3),""" + SPINE_SQL


def _order_panel(orders: DataFrame, key: str) -> DataFrame:
    orders = orders.groupBy(
        F.col(key).alias("Route"), F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Month"),
    ).agg(
        # Whole numbers, which both engines add without rounding.
        F.sum(F.floor(F.col("o_totalprice") / 1000)).alias("Passengers"), (F.count("*") * 60).alias("Seats"),
    )
    return forecast.monthly_panel(orders)


def _customers(s: SparkSession, d: str) -> DataFrame:
    return _order_panel(ad.table(s, d, "orders"), "o_custkey")


query("t1_panel_with_gaps", with_sql(CUSTOMER_SQL) + "select * from panel")(_customers)
query("t2_decomposition_with_gaps", with_sql(CUSTOMER_SQL + PARTS_SQL) + f"""
select route, period, month, t, n, x, {rnd("trend", 4)} as trend, {rnd("seasonal", 4)} as seasonal,
  {rnd("x - trend - seasonal", 4)} as resid from parts"""
)(lambda s, d: _rounded(forecast.decompose(_customers(s, d)), ["trend", "seasonal", "resid"], 4))

# Orders by nation and priority leave some months out, and are few enough series for the fold in SQL.
PRIORITY_SQL = CUSTOMER_SQL.replace(
    'select o_custkey as "Route"', "select n_name || ' ' || o_orderpriority as \"Route\"", 1
).replace(
    "from orders", "from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey", 1
)
query("t3_fit_with_gaps", recursive_sql(PRIORITY_SQL + smoothing_sql()) + FIT_ROWS)(
    lambda s, d: _fit_rows(_order_panel(
        ad.table(s, d, "orders").join(ad.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(ad.table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("key", F.concat_ws(" ", "n_name", "o_orderpriority")), "key")))

# ---- what-if ------------------------------------------------------------------------------------
CONFIG_SQL = SHIPMENTS + f""",
config as (
  select "Route" as route, max("Distance")::double as distance,
    {rnd("sum(l_quantity) / (count(*) * 30)", 4)} as base_lf, {rnd('avg(1 - "ArrDel15")', 4)} as base_otp,
    cast(1 + count(*) % 6 as integer) as daily_flights
  from flights group by 1),
scenarios as (
  select cast(distance as bigint) as scenario_id,
    case when distance % 70 = 0 then 'UNKNOWN' else route end as route,
    cast(distance // 10 % 6 as integer) - 2 as additional_daily_flights,
    case cast(distance // 10 as integer) % 4 when 0 then 'all_day' when 1 then 'peak_only'
      when 2 then 'off_peak' else 'night' end as schedule_change
  from config),
strategies(strategy_rank, strategy, lf_capture, otp_multiplier, strategy_label) as (
  values {", ".join(
      f"({i}, '{k}', {a}::double, {b}::double, '{c}')"
      for i, (k, a, b, c) in enumerate(fv.STRATEGIES))}),
prepared as (
  select s.*, distance, base_lf, base_otp, daily_flights, lf_capture, otp_multiplier,
    strategy_rank, strategy_label, daily_flights + additional_daily_flights as daily_flights_after,
    s.route || ': ' || case when additional_daily_flights >= 0 then '+' else '' end
      || additional_daily_flights || ' daily flight(s), ' || strategy_label as label,
    case when strategy is null then 'unknown schedule_change'
      when c.route is null then 'unknown route'
      when daily_flights + additional_daily_flights <= 0 then 'no flights left' end
      as reject_reason
  from scenarios s left join config c on s.route = c.route
  left join strategies t on s.schedule_change = t.strategy)"""


def route_config(s: SparkSession, d: str) -> DataFrame:
    """Settings per route from the flights themselves."""
    return ad.shipments(s, d).groupBy(F.col("Route").alias("route")).agg(
        F.max("Distance").cast("double").alias("distance"),
        rounded(F.sum("l_quantity") / (F.count("*") * 30), 4).alias("base_lf"),
        rounded(F.avg(1 - F.col("ArrDel15")), 4).alias("base_otp"),
        (1 + F.count("*") % 6).cast("int").alias("daily_flights"),
    )


def scenario_table(config: DataFrame) -> DataFrame:
    """One scenario per route; some name an unknown route or strategy."""
    distance = F.col("distance").cast("long")
    step = F.floor(F.col("distance") / 10).cast("int")
    strategies = F.array(*map(F.lit, ("all_day", "peak_only", "off_peak", "night")))
    return config.select(
        distance.alias("scenario_id"),
        F.when(distance % 70 == 0, "UNKNOWN").otherwise(F.col("route")).alias("route"),
        (step % 6 - 2).alias("additional_daily_flights"),
        F.element_at(strategies, step % 4 + 1).alias("schedule_change"),
    )


def _prepared(s: SparkSession, d: str) -> DataFrame:
    config = stage(route_config(s, d))
    return whatif.prepare_scenarios(scenario_table(config), config)


query("x1_scenario_inputs", with_sql(CONFIG_SQL) + """
select scenario_id, route, additional_daily_flights, schedule_change, label, reject_reason
from prepared""")(lambda s, d: _prepared(s, d).select(
    "scenario_id", "route", "additional_daily_flights", "schedule_change", "label",
    "reject_reason"))
query("j7_rejected_scenarios", with_sql(CONFIG_SQL) + """
select reject_reason, count(*) as n from prepared where reject_reason is not null group by 1"""
)(lambda s, d: whatif.rejected(_prepared(s, d)).groupBy("reject_reason").agg(
    F.count("*").alias("n")))
query("j6_scenarios_by_strategy", with_sql(CONFIG_SQL) + """
select scenario_id, strategy as schedule_change from scenarios, strategies"""
)(lambda s, d: whatif.compare_strategies(scenario_table(route_config(s, d))).select(
    "scenario_id", "schedule_change"))
EFFECTS = {
    "frequency_ratio": "fr", "demand_stimulus": "st", "new_lf_mean":
        "least(greatest(base_lf * st / fr * lf_capture, 0.2::double), 0.97::double)",
    "existing_lf_mean": "base_lf - 0.005::double * abs(additional_daily_flights)",
    "otp_mean": "base_otp - additional_daily_flights * 0.003::double"
                " - (otp_multiplier - 1) * 0.025::double",
}
query("x2_expected_effects", with_sql(CONFIG_SQL) + "select scenario_id, schedule_change, " + ", ".join(
    f"{rnd(v, 6)} as {k}" for k, v in EFFECTS.items()) + """
from (select *, daily_flights_after / daily_flights as fr,
    1 + 0.3::double * (daily_flights_after / daily_flights - 1) as st
  from prepared where reject_reason is null)"""
)(lambda s, d: _rounded(whatif.expected_effects(whatif.accepted(_prepared(s, d))).select(
    "scenario_id", "schedule_change", *EFFECTS), EFFECTS))


def comparison(s: SparkSession, d: str) -> DataFrame:
    """All strategies for one more flight on every route."""
    config = stage(route_config(s, d))
    plus_one = config.select(
        F.col("distance").cast("long").alias("scenario_id"), "route",
        F.lit(1).alias("additional_daily_flights"),
    )
    return whatif.compare(plus_one, config)


PLUS_ONE_SQL = CONFIG_SQL.replace("""
scenarios as (""", """
odd_scenarios as (""", 1).replace("""
prepared as (""", """
scenarios as (
  select cast(distance as bigint) as scenario_id, route, 1 as additional_daily_flights,
    strategy as schedule_change from config, strategies),
prepared as (""", 1)

_P, *_TERMS = fv.ERROR_FUNCTION
_SERIES = "0.0::double"
for _a in reversed(_TERMS):
    _SERIES = f"({_SERIES} + {_a}::double) * t"
# Means, deviations and percentiles of every accepted scenario.
OUTCOMES_SQL = f""",
effects as (
  select *, {EFFECTS["new_lf_mean"]} as new_mean, {EFFECTS["existing_lf_mean"]} as old_mean,
    {EFFECTS["otp_mean"]} as otp_mean, 64970::double * distance as seat_miles
  from (select *, daily_flights_after / daily_flights as fr,
      1 + 0.3::double * (daily_flights_after / daily_flights - 1) as st
    from prepared where reject_reason is null)),
parts as (
  select *, (daily_flights * old_mean + additional_daily_flights * new_mean) / daily_flights_after as lf,
    seat_miles * 0.1025::double * (additional_daily_flights * new_mean + daily_flights * old_mean) as a,
    seat_miles * 0.1025::double * daily_flights * base_lf as b,
    seat_miles * 0.092::double * additional_daily_flights as c
  from effects),
moments as (
  select *, a - b - c as mean_revenue, sqrt(a * a * 0.0025::double + (a - b) * (a - b) * 0.0016::double
    + a * a * 0.0025::double * 0.0016::double + c * c * 0.0009::double) as sd
  from parts),
shares as (
  select *, 1 / (1 + {_P}::double * size) as t
  from (select *, abs(mean_revenue / nullif(sd, 0)) / sqrt(2.0::double) as size from moments)),
summary as (
  select scenario_id, schedule_change, least(greatest(lf, 0.2::double), 0.98::double) as mean_lf,
    least(greatest(otp_mean, 0.4::double), 0.99::double) as mean_otp, mean_revenue,
    case when sd > 0 then case when mean_revenue >= 0 then 1 - {_SERIES} * exp(-size * size) / 2
      else {_SERIES} * exp(-size * size) / 2 end
      when mean_revenue > 0 then 1.0::double else 0.0::double end as p_revenue_positive,
    least(greatest(lf * (1 - {fv.Z_TENTH}::double * 0.05::double), 0.2::double), 0.98::double) as p10_lf,
    least(greatest(lf * (1 + {fv.Z_TENTH}::double * 0.05::double), 0.2::double), 0.98::double) as p90_lf,
    mean_revenue - {fv.Z_TENTH}::double * sd as p10_revenue,
    mean_revenue + {fv.Z_TENTH}::double * sd as p90_revenue
  from shares)"""
COMPARISON_SQL = PLUS_ONE_SQL + OUTCOMES_SQL + """,
comparison as (
  select *, Verdict || ': ' || printf('+%d daily %s flight (%s) → LF %+.1fpp, OTP %+.1fpp, Revenue $%+.1fM/yr',
      "Additional_Daily_Flights", "Route", "Scenario", "LF_Change_pp", "OTP_Change_pp", revenue_m)
      as "Recommendation"
  from (
    select scenario_id, route as "Route", strategy_rank,
      additional_daily_flights as "Additional_Daily_Flights", strategy_label as "Scenario",
      schedule_change as "Schedule", daily_flights as "Daily_Flights_Before",
      daily_flights_after as "Daily_Flights_After", """ + ", ".join(
    f"{rnd(x, n)} as {name}" for x, n, name in (
        ("base_lf * 100", 1, '"Baseline_LF_%"'), ("mean_lf * 100", 1, '"Projected_LF_%"'),
        ("(mean_lf - base_lf) * 100", 1, '"LF_Change_pp"'), ("p10_lf * 100", 1, '"LF_P10_%"'),
        ("p90_lf * 100", 1, '"LF_P90_%"'), ("base_otp * 100", 1, '"Baseline_OTP_%"'),
        ("mean_otp * 100", 1, '"Projected_OTP_%"'), ("(mean_otp - base_otp) * 100", 1, '"OTP_Change_pp"'),
        ("mean_revenue / 1e6", 2, '"Annual_Revenue_Delta_M$"'), ("mean_revenue / 1e6", 1, "revenue_m"),
        ("p10_revenue / 1e6", 2, '"Rev_P10_M$"'), ("p90_revenue / 1e6", 2, '"Rev_P90_M$"'),
    )) + """,
      case when mean_revenue > 0 and (mean_otp - base_otp) * 100 > -3 then 'RECOMMENDED'
        when mean_revenue > 0 then 'PROCEED WITH CAUTION' else 'NOT RECOMMENDED' end as "Verdict"
    from prepared join summary using (scenario_id, schedule_change)))"""
SUMMARY_COLUMNS = (
    "mean_lf", "mean_otp", "p_revenue_positive", "p10_lf", "p90_lf", "mean_revenue",
    "p10_revenue", "p90_revenue",
)


# Every run of every accepted scenario, as many as scenarios have by default: per pair of draws 52 bits
# each of one hash.
def _uniform_sql(pair: int, at: int) -> str:
    key = f"concat_ws(':', '42', scenario_id, strategy_rank, run, '{pair}')"
    return f"(cast('0x' || substr(md5({key}), {at}, 13) as bigint)::double + 0.5) / {2**52}::double"


RUNS_SQL = CONFIG_SQL + f""",
draws as (
  select *, {_uniform_sql(0, 1)} as u0, {_uniform_sql(0, 17)} as u1,
    {_uniform_sql(1, 1)} as u2, {_uniform_sql(1, 17)} as u3
  from prepared, range({fv.DEFAULT_RUNS}) r(run) where reject_reason is null),
noise as (
  select *, 1 + 0.05::double * sqrt(-2 * ln(u0)) * cos({TAU} * u1) as demand,
    1 + 0.04::double * sqrt(-2 * ln(u0)) * sin({TAU} * u1) as yields,
    1 + 0.03::double * sqrt(-2 * ln(u2)) * cos({TAU} * u3) as costs,
    0.012::double * sqrt(-2 * ln(u2)) * sin({TAU} * u3) as shift,
    daily_flights_after / daily_flights as fr,
    1 + 0.3::double * (daily_flights_after / daily_flights - 1) as st
  from draws),
drawn as (
  select *, least(greatest(new_mean * demand, 0.2::double), 0.98::double) as new_lf,
    least(greatest(old_mean * demand, 0.2::double), 0.98::double) as old_lf
  from (select *, {EFFECTS["new_lf_mean"]} as new_mean, {EFFECTS["existing_lf_mean"]} as old_mean,
      {EFFECTS["otp_mean"]} as otp_mean from noise)),
runs as (
  select scenario_id, schedule_change, run,
    least(greatest((daily_flights * old_lf + additional_daily_flights * new_lf)
      / daily_flights_after, 0.2::double), 0.98::double) as lf,
    least(greatest(otp_mean + shift, 0.4::double), 0.99::double) as otp,
    178 * 365 * distance * (
      additional_daily_flights * (0.1025::double * new_lf * yields - 0.092::double * costs)
      + daily_flights * 0.1025::double * (old_lf - base_lf) * yields) as revenue
  from drawn)"""
SUMMARY_SQL = """,
summary as (
  select scenario_id, schedule_change, avg(lf) as mean_lf, avg(otp) as mean_otp,
    avg(revenue) as mean_revenue,
    avg(case when revenue > 0 then 1.0::double else 0.0::double end) as p_revenue_positive,
    quantile_cont(lf, 0.1) as p10_lf, quantile_cont(lf, 0.9) as p90_lf,
    quantile_cont(revenue, 0.1) as p10_revenue, quantile_cont(revenue, 0.9) as p90_revenue
  from runs group by 1, 2)
"""


@query("x2_a17_outcome_histogram", with_sql(RUNS_SQL) + f""",
ends as (select scenario_id, schedule_change, min(lf) as lo, (max(lf) - min(lf)) / 60 as w from runs
  group by 1, 2)
select scenario_id, schedule_change, bin, {rnd("any_value(lo) + any_value(w) * (bin - 1)", 6)}
  as bin_low, {rnd("any_value(lo) + any_value(w) * bin", 6)} as bin_high, count(*) as n
from (select *, case when w = 0 then 1 else least(cast(floor((lf - lo) / w) as integer) + 1, 60) end
    as bin from runs join ends using (scenario_id, schedule_change))
group by 1, 2, 3""")
def _outcomes(s: SparkSession, d: str) -> DataFrame:
    runs = stage(whatif.simulate(_prepared(s, d)))
    return _rounded(whatif.histogram(runs, "lf", 60, whatif.KEY), ["bin_low", "bin_high"])


@query("x3_a12_outcome_summary", with_sql(RUNS_SQL + SUMMARY_SQL)
       + "select scenario_id, schedule_change, " + ", ".join(
           f"{rnd(c, 0 if 'revenue' in c and c[:2] != 'p_' else 6)} as {c}"
           for c in SUMMARY_COLUMNS) + " from summary")
def _summary(s: SparkSession, d: str) -> DataFrame:
    out = whatif.summarise(whatif.simulate(_prepared(s, d)), max_runs=fv.DEFAULT_RUNS)
    return _rounded(_rounded(out, SUMMARY_COLUMNS[:5]), SUMMARY_COLUMNS[5:], 0)


BEST_SQL = """,
ranked as (
  select *, row_number() over (partition by scenario_id
    order by "Annual_Revenue_Delta_M$" desc, strategy_rank) as place from comparison)"""
NARRATIVE_SQL = BEST_SQL + """
select scenario_id, "Route", printf('=== Scenario Analysis: %s %+d Daily Flight(s) ===', "Route",
    any_value("Additional_Daily_Flights"))
  || chr(10) || chr(10) || 'BASELINE STATE:' || chr(10)
  || printf('  Load Factor:  %.1f%%', any_value("Baseline_LF_%")) || chr(10)
  || printf('  OTP:          %.1f%%', any_value("Baseline_OTP_%")) || chr(10) || chr(10)
  || 'SCENARIO COMPARISON:' || chr(10)
  || string_agg(printf('  [%-10s] LF=%.1f%% (%+.1fpp) | OTP=%.1f%% (%+.1fpp) | Rev=%+.1fM',
      upper("Schedule"), "Projected_LF_%", "LF_Change_pp", "Projected_OTP_%", "OTP_Change_pp",
      """ + rnd('"Annual_Revenue_Delta_M$"', 1) + """), chr(10) order by strategy_rank)
  || chr(10) || chr(10) || 'BEST OPTION:' || chr(10) || '  '
  || max("Recommendation") filter (place = 1) as narrative
from ranked group by 1, 2"""


query("x4_comparison_table", with_sql(COMPARISON_SQL) + "select * exclude (revenue_m) from comparison")(comparison)
query("x5_narrative", with_sql(COMPARISON_SQL) + NARRATIVE_SQL)(
    lambda s, d: whatif.narrative(comparison(s, d)))
query("w11_best_strategy", with_sql(COMPARISON_SQL) + BEST_SQL
      + " select * exclude (revenue_m, place) from ranked where place = 1")(
    lambda s, d: whatif.best_strategy(comparison(s, d)))
SCENARIO_SHEET = {
    "Route": "Route", "Schedule Strategy": "Scenario", "Schedule": "Schedule",
    "Flights Before": "Daily_Flights_Before", "Flights After": "Daily_Flights_After",
    "Baseline LF %": "Baseline_LF_%", "Projected LF %": "Projected_LF_%",
    "LF Change (pp)": "LF_Change_pp", "LF P10 %": "LF_P10_%", "LF P90 %": "LF_P90_%",
    "Baseline OTP %": "Baseline_OTP_%", "Projected OTP %": "Projected_OTP_%",
    "OTP Change (pp)": "OTP_Change_pp", "Annual Revenue Delta ($M)": "Annual_Revenue_Delta_M$",
    "Revenue P10 ($M)": "Rev_P10_M$", "Revenue P90 ($M)": "Rev_P90_M$",
    "Recommendation": "Recommendation",
}
query("q25_sheet_scenario_summary", with_sql(COMPARISON_SQL) + "select " + ", ".join(
    f'"{source}" as "{header}"' for header, source in SCENARIO_SHEET.items()) + " from comparison")(
    lambda s, d: reports.sheet_scenario_summary(comparison(s, d)))


# ---- classifier ---------------------------------------------------------------------------------
MATRIX = ("weather_severity", "prev_tail_dep_delay", "legs_today_before", "hour_of_day")


@query("p25_training_matrix", with_sql(SCORED_SQL) + f"""
select l.event_id, l."ArrDel15" as label, {rnd("l.weather_severity", 6)} as weather_severity,
  coalesce(r.p_dep, 0) as prev_tail_dep_delay,
  least(r.before_today, 10)::double as legs_today_before, l."DepHour"::double as hour_of_day
from legs_wx l join rotation r using (event_id) where l."Cancelled" = 0""")
def _matrix(s: SparkSession, d: str) -> DataFrame:
    rows, _ = classifier.prepare_training(leg_features(s, d), keep=["event_id"], features=MATRIX)
    return _rounded(rows, ["weather_severity"])


query("p26_aligned_columns", LG + """
select event_id, "DepHour"::double as "DepHour", coalesce("DepDelay", 0) as "DepDelay",
  0.0::double as unseen from legs""")(lambda s, d: classifier.align_features(
    ad.legs(s, d), ["DepHour", "DepDelay", "unseen"], keep=["event_id"]))


# Delays of the legs are drawn without regard to anything. To have something to learn, the label adds
# minutes for late hours and bad weather to the drawn delay.
MINUTES_AN_HOUR, MINUTES_A_DEGREE = 3.0, 4.0


def _training(s: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    # Strict trailing means: no flight sees its own delay.
    legs = leg_features(s, d, "strict")
    late = F.col("ArrDelay") + MINUTES_AN_HOUR * (F.col("hour_of_day") - 12) + MINUTES_A_DEGREE * F.col("weather_severity")
    legs = legs.withColumn("ArrDel15", (F.coalesce(late, F.lit(0.0)) >= 15).cast("int"))
    rows, names = classifier.prepare_training(legs, keep=["event_id"])
    return stage(classifier.split_rows(rows, ["event_id"])), names


# Band of a key: the first 32 bits of its hash.
BAND_SQL = "cast('0x' || substr(md5('42:' || event_id), 1, 8) as bigint) % 10000"


@query("m2_split", LG + f"""
select part, count(*) as n, {rnd('avg("ArrDel15")', 6)} as late_share
from (select *, case when {BAND_SQL} < 2000 then 'test' when {BAND_SQL} < 3000 then 'validation'
    else 'train' end as part from legs where "Cancelled" = 0)
group by 1""")
def _split(s: SparkSession, d: str) -> DataFrame:
    legs = ad.legs(s, d).where(F.col("Cancelled") == 0)
    return classifier.split_rows(legs, ["event_id"]).groupBy("part").agg(
        F.count("*").alias("n"), rounded(F.avg("ArrDel15"), 6).alias("late_share")
    )


# Rows by class and hash order, with the class's size and the rows of the classes before it.
STRATA = LG + """,
sizes as (select "ArrDel15", count(*) as size from legs where "Cancelled" = 0 group by 1),
strata as (
  select event_id, "ArrDel15", size,
    row_number() over (partition by "ArrDel15" order by md5('42:' || event_id), event_id) as place,
    coalesce((select sum(size) from sizes s where s."ArrDel15" < legs."ArrDel15"), 0) as before
  from legs join sizes using ("ArrDel15") where "Cancelled" = 0)
"""


@query("m2_stratified_split", STRATA + """
select event_id, "ArrDel15", case when place <= floor(size * 0.2::double + 0.5::double) then 'test'
  when place <= floor(size * 0.2::double + 0.5::double) + floor(size * 0.1::double + 0.5::double)
    then 'validation' else 'train' end as part
from strata""")
def _stratified_split(s: SparkSession, d: str) -> DataFrame:
    legs = ad.legs(s, d).where(F.col("Cancelled") == 0).select("event_id", "ArrDel15")
    return classifier.stratified_split(legs, ["event_id"], "ArrDel15")


@query("m5_stratified_folds", STRATA + """
select event_id, "ArrDel15", cast((before + place - 1) % 5 as integer) as fold from strata""")
def _stratified_folds(s: SparkSession, d: str) -> DataFrame:
    legs = ad.legs(s, d).where(F.col("Cancelled") == 0).select("event_id", "ArrDel15")
    return classifier.stratified_folds(legs, ["event_id"], label="ArrDel15")


def _model(s: SparkSession, d: str) -> tuple[classifier.Classifier, DataFrame]:
    rows, names = _training(s, d)
    part = F.col("part")
    model = classifier.train(rows.where(part == "train"), names, rows.where(part == "validation"))
    return model, rows.where(part == "test")


@query("m3_m4_m6_train_and_score")
def _train(s: SparkSession, d: str) -> DataFrame:
    model, test = _model(s, d)
    return model.score(test).select(
        "event_id", "label", "delay_probability", "prediction", "risk_level"
    )


@query("m5_cross_validation")
def _cross_validation(s: SparkSession, d: str) -> DataFrame:
    rows, names = _training(s, d)
    return classifier.cross_validate(rows, names, ["event_id"])


query("m8_feature_importance")(lambda s, d: _model(s, d)[0].importance())
