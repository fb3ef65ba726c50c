"""Monthly demand per route: decomposition, two forecasters, intervals and load factor.

All routes are fitted by one job keyed on the route. A series has one row per month after the
first aggregation, so a group is bounded by the number of months however many rows a route has.
Series follow the calendar from their first to their last month; months between without passengers
are unknown, not zero: they keep their place, and nothing is learned from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import ratio, rounded, whole
from slipstream.operators.staging import stage

SEASON = fv.SEASON_MONTHS
# Points that the trend is extended from at either end.
END_POINTS = SEASON


def monthly_panel(
    capacity: DataFrame,
    key: str = "Route",
    year: str = "Year",
    month: str = "Month",
    passengers: str = "Passengers",
    seats: str = "Seats",
    min_months: int = SEASON,
) -> DataFrame:
    """Ordered series: route, period, month, t (0-based), n (months spanned), x (passengers), seats.

    Every month from the first to the last one known has a row; x and seats of unknown ones are null.
    Routes with fewer than ``min_months`` known months are left out.
    """
    monthly = (
        capacity.where(F.col(passengers).isNotNull())
        .groupBy(F.col(key).alias("route"), F.make_date(year, month, F.lit(1)).alias("period"))
        .agg(
            F.sum(passengers).cast("double").alias("x"), F.sum(seats).cast("double").alias("seats")
        )
    )
    # One row per route and known month: the whole series of a route fits into a row.
    series = monthly.groupBy("route").agg(
        F.min("period").alias("first"), F.max("period").alias("last"), F.count("*").alias("known"),
        F.map_from_entries(F.collect_list(F.struct("period", F.struct("x", "seats")))).alias("months"),
    ).where(F.col("known") >= min_months)
    months = F.sequence("first", "last", F.expr("interval 1 month"))
    return series.select(
        "route", F.size(months).alias("n"), "months", F.posexplode(months).alias("t", "period")
    ).withColumn("found", F.try_element_at("months", "period")).select(
        "route", "period", F.month("period").alias("month"), "t", "n", "found.x", "found.seats"
    )


def short_series(
    capacity: DataFrame, key: str = "Route", year: str = "Year", month: str = "Month",
    min_months: int = SEASON,
) -> DataFrame:
    """Routes that are skipped because they have too few months."""
    return (
        capacity.groupBy(F.col(key).alias("route"))
        .agg(F.count_distinct(year, month).alias("months"))
        .where(F.col("months") < min_months)
    )


def decompose(panel: DataFrame) -> DataFrame:
    """Additive decomposition of series that span two full years: trend, seasonal, resid.

    The trend is a centred twelve-month mean; both ends are extended along straight lines through
    the nearest trend points. The mean takes unknown months from the straight line between the known
    ones around them. The seasonal index is the mean detrended value of the known months per calendar
    month, centred on zero; residuals of unknown months are null. A calendar month that is never
    known inside the trend has no index, and neither seasonal nor residual.
    """
    half = SEASON // 2
    series = Window.partitionBy("route").orderBy("period")
    wide, narrow = series.rowsBetween(-half, half), series.rowsBetween(-half + 1, half - 1)
    every = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t, n = F.col("t"), F.col("n")
    inner = t.between(half, n - half - 1)
    smooth = (F.sum("filled").over(wide) + F.sum("filled").over(narrow)) / F.lit(2.0 * SEASON)

    # The known months before and after an unknown one; the ends of a series are known.
    place = F.when(F.col("x").isNotNull(), F.struct("t", "x"))
    earlier = F.last(place, True).over(series.rowsBetween(Window.unboundedPreceding, -1))
    later = F.first(place, True).over(series.rowsBetween(1, Window.unboundedFollowing))
    between = F.col("e.x") + (F.col("l.x") - F.col("e.x")) * (t - F.col("e.t")) / (F.col("l.t") - F.col("e.t"))

    # Lines through the first and the last trend points. The last valid point stays outside both.
    last = n - half - 1
    head = inner & (t < F.least(F.lit(half + END_POINTS), last))
    tail = inner & (t >= F.greatest(F.lit(half), last - END_POINTS)) & (t < last)

    def line(where: Column) -> Column:
        y = F.when(where, F.col("smooth"))
        at = t.cast("double")
        return F.regr_intercept(y, at).over(every) + F.regr_slope(y, at).over(every) * t

    trended = (
        panel.where(n >= 2 * SEASON)
        .withColumns({"e": earlier, "l": later})
        .withColumn("filled", F.coalesce(F.col("x"), between))
        .withColumn("smooth", F.when(inner, smooth))
        .withColumn(
            "trend",
            F.when(inner, F.col("smooth")).when(t < half, line(head)).otherwise(line(tail)),
        )
        .withColumn("_raw", F.when(inner, F.col("x") - F.col("smooth")))
    )
    index = (
        trended.groupBy("route", "month").agg(F.avg("_raw").alias("_mean"))
        .where("_mean is not null")
        .withColumn(
            "seasonal", F.col("_mean") - F.avg("_mean").over(Window.partitionBy("route"))
        )
        .select("route", "month", "seasonal")
    )
    return (
        trended.join(index, ["route", "month"], "left")
        .withColumn("resid", F.col("x") - F.col("trend") - F.col("seasonal"))
        .select("route", "period", "month", "t", "n", "x", "trend", "seasonal", "resid")
    )


def seats_per_passenger(panel: DataFrame, months: int = 3) -> DataFrame:
    """Mean of seats / passengers over the known ones of the latest months of each route."""
    return (
        panel.where(F.col("t") >= F.col("n") - F.lit(months))
        .groupBy("route").agg(F.avg(ratio("seats", "x")).alias("seats_per_pax"))
    )


def fit_trend_season(panel: DataFrame) -> DataFrame:
    """Straight line plus monthly index per route: last period, n, line, sigma, index array.

    Series shorter than two years get no seasonal index.
    """
    index = decompose(panel).groupBy("route", "month").agg(F.max("seasonal").alias("seasonal"))
    level = panel.join(index, ["route", "month"], "left").withColumn(
        "_y", F.col("x") - F.coalesce(F.col("seasonal"), F.lit(0.0))
    )
    t = F.col("t").cast("double")
    lines = level.groupBy("route").agg(
        F.max("period").alias("last_period"), F.max("n").alias("n"),
        F.regr_slope("_y", t).alias("slope"), F.regr_intercept("_y", t).alias("intercept"),
        F.map_from_entries(F.collect_set(F.struct(
            "month", F.coalesce(F.col("seasonal"), F.lit(0.0)).alias("seasonal")
        ))).alias("season_index"),
        # Unknown months have no y and count in none of these. Sums for the residual spread, so that no second pass over the series is needed.
        F.var_pop("_y").alias("_vy"), F.covar_pop("_y", t).alias("_cov"),
    )
    spread = F.col("_vy") - F.col("slope") * F.col("_cov")
    return lines.withColumn("sigma", F.sqrt(F.greatest(spread, F.lit(0.0)))).drop("_vy", "_cov")


def trend_season_path(fitted: DataFrame, horizon: int) -> DataFrame:
    """Point forecasts of the line-plus-index model: route, h, period, f, sigma."""
    return _ahead(fitted, horizon).select(
        "route", "h", "period",
        (
            F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("h"))
            + F.coalesce(
                F.try_element_at("season_index", F.month("period")), F.lit(0.0)
            )
        ).alias("f"),
        "sigma",
    )


def _ahead(fitted: DataFrame, horizon: int) -> DataFrame:
    return fitted.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "period", F.add_months("last_period", F.col("h"))
    )


DEFAULT_GRID = {
    "alpha": (0.05, 0.2, 0.4, 0.6, 0.8), "beta": (0.01, 0.05, 0.2), "gamma": (0.05, 0.2, 0.4),
}
# The search from the best grid points: how many, its first step, its rounds, and the open bounds.
STARTS, FIRST_STEP, SEARCH_ROUNDS, LOWEST, HIGHEST = 3, 0.1, 20, 0.0001, 0.9999
# Directions of a round: along each axis.
DIRECTIONS = ((-1, 0, 0), (0, -1, 0), (0, 0, -1), (0, 0, 1), (0, 1, 0), (1, 0, 0))
_SETTINGS = ("alpha", "beta", "gamma")


def _smoothed(alpha: Column, beta: Column, gamma: Column) -> Column:
    """Fold of the series ``xs`` from ``_level``, ``_trend`` and ``_first``; the state after it.

    In an unknown month the level follows the trend, the season turns, and nothing else changes.
    """
    one = F.lit(1.0)
    state = F.struct(
        F.col("_level").alias("level"), F.col("_trend").alias("trend"),
        F.transform("_first", lambda x: F.coalesce(x - F.col("_level"), F.lit(0.0))).alias("season"),
        F.lit(0.0).alias("sse"), F.lit(0.0).alias("se"),
    )

    def step(s: Column, x: Column) -> Column:
        ahead = s["level"] + s["trend"]
        oldest = F.element_at(s["season"], 1)
        error = x - (ahead + oldest)
        level = F.coalesce(alpha * (x - oldest) + (one - alpha) * ahead, ahead)
        trend = F.when(x.isNull(), s["trend"]).otherwise(
            beta * (level - s["level"]) + (one - beta) * s["trend"]
        )
        newest = F.coalesce(gamma * (x - ahead) + (one - gamma) * oldest, oldest)
        return F.struct(
            level.alias("level"), trend.alias("trend"),
            F.concat(F.slice(s["season"], 2, SEASON - 1), F.array(newest)).alias("season"),
            (s["sse"] + F.coalesce(error * error, F.lit(0.0))).alias("sse"),
            (s["se"] + F.coalesce(error, F.lit(0.0))).alias("se"),
        )

    return F.aggregate("xs", state, step)


def _tried(alpha: Column, beta: Column, gamma: Column) -> Column:
    return F.struct(
        _smoothed(alpha, beta, gamma)["sse"].alias("sse"),
        alpha.alias("alpha"), beta.alias("beta"), gamma.alias("gamma"),
    )


def _searched(start: Column) -> Column:
    """The best point of a search from ``start``: a step to the best neighbour, or half the step."""
    directions = F.array(*[
        F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(d, _SETTINGS)]) for d in DIRECTIONS
    ])

    def turn(s: Column, _: Column) -> Column:
        def neighbour(d: Column) -> Column:
            return _tried(*[
                F.least(F.greatest(s["best"][n] + d[n] * s["step"], F.lit(LOWEST)), F.lit(HIGHEST))
                for n in _SETTINGS
            ])

        best = F.least(s["best"], F.array_min(F.transform(directions, neighbour)))
        half = F.when(best == s["best"], s["step"] / 2).otherwise(s["step"])
        return F.struct(best.alias("best"), half.alias("step"))

    first = F.struct(start.alias("best"), F.lit(FIRST_STEP).alias("step"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SEARCH_ROUNDS)), first, turn)["best"]


def fit_holt_winters(
    panel: DataFrame, grid: dict[str, Sequence[float]] | None = None, search: bool = True
) -> DataFrame:
    """Additive trend and season smoothing with the least squared error.

    Each series becomes one sorted array, which a fold walks once per setting. The settings of the
    grid are tried first; from the best ``STARTS`` of them a search goes on over (0, 1): it moves to
    the best of its six neighbours, or halves its step if none is better. Series, grid points and starts
    run in parallel, rounds of a search are one expression. The season starts from the first year,
    the level from its mean and the trend from the change of the yearly mean, all of known months.
    """
    grid = grid or DEFAULT_GRID
    series = panel.groupBy("route").agg(
        F.max("period").alias("last_period"), F.max("n").alias("n"), F.count("x").alias("known"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("t", "x"))), lambda p: p["x"]
        ).alias("xs"),
    )
    year1, year2 = F.slice("xs", 1, SEASON), F.slice("xs", SEASON + 1, SEASON)
    start = series.withColumns({
        "_first": year1,
        "_level": _mean(year1),
        "_trend": F.when(
            F.col("n") >= 2 * SEASON, F.coalesce((_mean(year2) - _mean(year1)) / SEASON, F.lit(0.0))
        ).otherwise(F.lit(0.0)),
    })
    tried = start
    for name in _SETTINGS:
        tried = tried.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in grid[name]])))
    # Spread the grid before the fold: it is the expensive part, of rows too small for the adaptive
    # planner to spread by itself.
    tasks = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tried = tried.repartition(tasks, "route", *_SETTINGS).select(
        "route", _tried(*map(F.col, _SETTINGS)).alias("best")
    ).groupBy("route").agg(F.slice(F.array_sort(F.collect_list("best")), 1, STARTS).alias("starts"))
    if search:
        starts = start.join(tried, "route").withColumn("start", F.explode("starts"))
        tried = starts.repartition(tasks, "route", "start").select(
            "route", _searched(F.col("start")).alias("best")
        ).groupBy("route").agg(F.min("best").alias("best"))
    else:
        tried = tried.select("route", F.col("starts")[0].alias("best"))
    fitted = start.join(tried, "route").withColumn(
        "fit", _smoothed(*[F.col("best")[n] for n in _SETTINGS])
    )
    mean_error = F.col("fit.se") / F.col("known")
    spread = F.col("fit.sse") / F.col("known") - mean_error * mean_error
    return fitted.select(
        "route", "last_period", "n", "best.alpha", "best.beta", "best.gamma", "best.sse", "fit.level",
        "fit.trend", "fit.season",
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("sigma"),
    )


def _mean(values: Column) -> Column:
    """Mean of the known values; null if there are none."""
    known = F.filter(values, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(known) > 0, total / F.size(known))


def holt_winters_path(fitted: DataFrame, horizon: int) -> DataFrame:
    """Point forecasts of the smoothing model: route, h, period, f, sigma."""
    position = (F.col("h") - F.lit(1)) % F.lit(SEASON) + F.lit(1)
    return _ahead(fitted, horizon).select(
        "route", "h", "period",
        (
            F.col("level") + F.col("h") * F.col("trend")
            + F.element_at("season", position.cast("int"))
        ).alias("f"),
        "sigma",
    )


def with_intervals(path: DataFrame, seats: DataFrame) -> DataFrame:
    """Forecast table: whole passengers, 80 % and 95 % bands, seats and load factor.

    The bands widen with the square root of the horizon. The mean and the lower bounds stop at
    zero. Seats follow the latest seats-per-passenger ratio, which makes the projected load factor
    the same for every month of a route.
    """
    reach = F.col("sigma") * F.sqrt(F.col("h").cast("double"))
    mean = F.greatest(F.col("f"), F.lit(0.0))

    def bound(z: float, sign: int) -> Column:
        return F.col("f") + F.lit(sign * z) * reach

    floor = lambda c: F.greatest(c, F.lit(0.0))
    seats_needed = mean * F.col("seats_per_pax")
    load = F.when(seats_needed > 0, ratio(mean, seats_needed))
    return path.join(seats, "route", "left").select(
        "period", "route",
        whole(mean).alias("forecast_passengers"),
        whole(floor(bound(fv.Z80, -1))).alias("lower_80"),
        whole(bound(fv.Z80, 1)).alias("upper_80"),
        whole(floor(bound(fv.Z95, -1))).alias("lower_95"),
        whole(bound(fv.Z95, 1)).alias("upper_95"),
        whole(seats_needed).alias("forecast_seats"),
        rounded(load, 4).alias("forecast_lf"),
    )


def forecast(
    capacity: DataFrame, horizon: int = 12, model: str = "holt_winters", key: str = "Route",
    grid: dict[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Forecast every route with at least twelve known months; others are in ``short_series``."""
    # The panel has a row per route and month; what follows reads it several times.
    panel = stage(monthly_panel(capacity, key))
    if model == "holt_winters":
        path = holt_winters_path(fit_holt_winters(panel, grid), horizon)
    elif model == "trend_season":
        path = trend_season_path(fit_trend_season(panel), horizon)
    else:
        raise ValueError("model must be 'holt_winters' or 'trend_season'")
    return with_intervals(path, seats_per_passenger(panel))
