"""What-if evaluation of schedule changes.

Scenarios are rows; the number of scenarios is the scale. For reports, means, ranges and chances follow
in closed form from the moments of demand, yield and cost, one projection per scenario and strategy.
Distributions come from repeated draws (``simulate``): a draw is a function of (seed, scenario,
strategy, run, pair) alone, so results do not change with partitioning, retries or engine restarts.
Runs are produced in place by a generator: no join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import clamp, first_match, literal_table, rounded
from slipstream.operators.features import route_table
from slipstream.operators.ordered import TASK_ROWS, percentiles

KEY = ["scenario_id", "schedule_change"]
# Runs one generator row produces; more runs are spread over several rows first.
BLOCK = 1_000
# Up to this many runs of a scenario are sorted in memory, as one array.
SORTED_RUNS = 100_000


def strategy_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(fv.STRATEGIES)]
    names = ["strategy_rank", "strategy", "lf_capture", "otp_multiplier", "strategy_label"]
    return literal_table(spark, names, rows)


def compare_strategies(scenarios: DataFrame) -> DataFrame:
    """One row per scenario and strategy."""
    every = F.array(*[F.lit(s[0]) for s in fv.STRATEGIES])
    return scenarios.withColumn("schedule_change", F.explode(every))


def prepare_scenarios(scenarios: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Attach route and strategy settings, default values, the label and the reason to reject.

    ``scenarios``: scenario_id, route, additional_daily_flights and optionally schedule_change,
    simulation_runs, label. ``routes``: route, distance, base_lf, base_otp, daily_flights.
    """
    spark = scenarios.sparkSession
    optional = {
        "schedule_change": F.lit(fv.STRATEGIES[0][0]), "simulation_runs": F.lit(fv.DEFAULT_RUNS),
        "label": F.lit(""),
    }
    for name, default in optional.items():
        given = F.col(name) if name in scenarios.columns else F.lit(None)
        scenarios = scenarios.withColumn(name, F.coalesce(given, default))
    # The built-in tables have ten and three rows; a table of routes passed in is not hinted.
    config = F.broadcast(route_table(spark)) if routes is None else routes
    config = config.select(
        F.col("route").alias("_route"), F.col("distance").cast("double").alias("distance"),
        "base_lf", "base_otp", F.col("daily_flights").cast("int").alias("daily_flights"),
    )
    strategies = F.broadcast(strategy_table(spark))
    delta = F.col("additional_daily_flights")
    change = F.format_string(
        "%s: %s%d daily flight(s), %s", F.col("route"), F.when(delta >= 0, "+").otherwise(""),
        delta, F.col("strategy_label"),
    )
    after = F.col("daily_flights") + delta
    reason = first_match([
        (F.col("strategy").isNull(), "unknown schedule_change"),
        (F.col("_route").isNull(), "unknown route"),
        (delta.isNull(), "no flight change given"),
        (after <= 0, "no flights left"),
        (F.col("simulation_runs") <= 0, "no runs"),
    ])
    return (
        scenarios.join(config, scenarios["route"] == config["_route"], "left")
        .join(strategies, F.col("schedule_change") == F.col("strategy"), "left")
        .withColumns({
            "daily_flights_after": after,
            "label": F.when(F.col("label") != "", F.col("label")).when(
                F.col("strategy_label").isNotNull(), change
            ),
            "reject_reason": reason,
        })
        .drop("_route", "strategy")
    )


def accepted(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("reject_reason").isNull())


def rejected(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("reject_reason").isNotNull())


def expected_effects(prepared: DataFrame) -> DataFrame:
    """Deterministic part: frequency ratio, demand stimulus, mean load factors, OTP shift."""
    delta = F.col("additional_daily_flights")
    frequency = F.col("daily_flights_after") / F.col("daily_flights")
    stimulus = F.lit(1.0) + F.lit(fv.DEMAND_ELASTICITY) * (frequency - F.lit(1.0))
    return prepared.withColumns({
        "frequency_ratio": frequency,
        "demand_stimulus": stimulus,
        "new_lf_mean": clamp(
            F.col("base_lf") * stimulus / frequency * F.col("lf_capture"), *fv.NEW_FLIGHT_LF_RANGE
        ),
        "existing_lf_mean": F.col("base_lf") - F.lit(fv.DILUTION_PER_FLIGHT) * F.abs(delta),
        "otp_mean": (
            F.col("base_otp") - delta * F.lit(fv.CONGESTION_OTP_LOSS)
            - (F.col("otp_multiplier") - F.lit(1.0)) * F.lit(fv.SCHEDULE_OTP_WEIGHT)
        ),
    })


def normal_cdf(z: Column) -> Column:
    """Share of a standard normal variable below ``z``, to seven digits."""
    p, *terms = fv.ERROR_FUNCTION
    size = F.abs(z) / F.lit(2.0) ** 0.5
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * size)
    series = F.lit(0.0)
    for a in reversed(terms):
        series = (series + F.lit(a)) * t
    tail = series * F.exp(-size * size) / F.lit(2.0)
    return F.when(z >= 0, F.lit(1.0) - tail).otherwise(tail)


def outcomes(prepared: DataFrame) -> DataFrame:
    """Load factor, punctuality and yearly revenue change per accepted scenario and strategy.

    Demand, yield and cost vary independently around 1 with the known deviations, and one demand
    moves new and existing flights together. Load factor is then ``m * demand`` and revenue is
    ``a * demand * yield - b * yield - c * cost``, whose mean and variance are known exactly: no run
    is drawn. Ranges are the 10th and 90th percentiles of normal variables with these moments, and
    the limits on load factor and punctuality apply to the results.
    """
    delta, flights = F.col("additional_daily_flights"), F.col("daily_flights")
    seat_miles = F.lit(float(fv.SEATS_PER_DEPARTURE * fv.DAYS_PER_YEAR)) * F.col("distance")
    fare = seat_miles * F.lit(fv.REVENUE_PER_SEAT_MILE)
    base = expected_effects(accepted(prepared)).withColumns({
        "_lf": (flights * F.col("existing_lf_mean") + delta * F.col("new_lf_mean"))
        / F.col("daily_flights_after"),
        "_a": fare * (delta * F.col("new_lf_mean") + flights * F.col("existing_lf_mean")),
        "_b": fare * flights * F.col("base_lf"),
        "_c": seat_miles * F.lit(fv.COST_PER_SEAT_MILE) * delta,
    })
    a, kept, c = F.col("_a"), F.col("_a") - F.col("_b"), F.col("_c")
    demand, yields, cost = (F.lit(x * x) for x in (fv.DEMAND_SIGMA, fv.YIELD_SIGMA, fv.COST_SIGMA))
    variance = a * a * demand + kept * kept * yields + a * a * demand * yields + c * c * cost
    base = base.withColumns({"_mean": kept - c, "_sd": F.sqrt(variance)})
    z = F.lit(fv.Z_TENTH)
    return base.select(
        *KEY, clamp(F.col("_lf"), *fv.LF_RANGE).alias("mean_lf"),
        clamp(F.col("otp_mean"), *fv.OTP_RANGE).alias("mean_otp"),
        F.col("_mean").alias("mean_revenue"),
        F.when(F.col("_sd") > 0, normal_cdf(F.col("_mean") / F.nullif("_sd", F.lit(0.0))))
        .otherwise((F.col("_mean") > 0).cast("double")).alias("p_revenue_positive"),
        *[clamp(F.col("_lf") * (F.lit(1.0) + sign * z * F.lit(fv.DEMAND_SIGMA)), *fv.LF_RANGE).alias(n)
          for n, sign in (("p10_lf", -1), ("p90_lf", 1))],
        *[(F.col("_mean") + sign * z * F.col("_sd")).alias(n)
          for n, sign in (("p10_revenue", -1), ("p90_revenue", 1))],
    )


def uniform_pair(seed: int, pair: int, scenario: str, strategy: str, run: str) -> list[Column]:
    """Two uniform draws in (0, 1) that depend on nothing but their keys: 52 bits each of one hash."""
    keys = [F.col(c).cast("string") for c in (scenario, strategy, run)]
    digits = F.md5(F.concat_ws(":", F.lit(str(seed)), *keys, F.lit(str(pair))))
    return [
        (F.conv(F.substring(digits, at, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
        for at in (1, 17)
    ]


def normal_pair(seed: int, pair: int, *keys: str) -> tuple[Column, Column]:
    """Two independent standard normal draws for (scenario, strategy number, run)."""
    first, second = uniform_pair(seed, pair, *keys)
    radius = F.sqrt(F.lit(-2.0) * F.ln(first))
    angle = F.lit(2.0) * F.pi() * second
    return radius * F.cos(angle), radius * F.sin(angle)


def simulate(prepared: DataFrame, seed: int = 42) -> DataFrame:
    """One row per run: run, load factor, punctuality and yearly revenue change."""
    runs = F.col("simulation_runs")
    base = expected_effects(accepted(prepared)).where(runs > 0)
    blocks = base.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), ((runs - 1) / BLOCK).cast("int")))
    )
    # Spread scenarios and blocks over the cores before they are multiplied into runs: the rows are
    # few and small here, so without a number the engine would merge them into one task.
    spread = prepared.sparkSession.sparkContext.defaultParallelism
    blocks = blocks.repartition(spread, *[F.col(k) for k in KEY], F.col("_block"))
    first = F.col("_block") * BLOCK
    drawn = blocks.withColumn(
        "run", F.explode(F.sequence(first, F.least(first + BLOCK, runs) - 1))
    )
    draw_key = ("scenario_id", "strategy_rank", "run")
    z_demand, z_yield = normal_pair(seed, 0, *draw_key)
    z_cost, z_otp = normal_pair(seed, 1, *draw_key)
    drawn = drawn.withColumns({
        "_demand": F.lit(1.0) + F.lit(fv.DEMAND_SIGMA) * z_demand,
        "_yield": F.lit(1.0) + F.lit(fv.YIELD_SIGMA) * z_yield,
        "_cost": F.lit(1.0) + F.lit(fv.COST_SIGMA) * z_cost,
        "_otp_noise": F.lit(fv.OTP_SIGMA) * z_otp,
    }).withColumns({
        # One demand draw moves new and existing flights together.
        "_new_lf": clamp(F.col("new_lf_mean") * F.col("_demand"), *fv.LF_RANGE),
        "_old_lf": clamp(F.col("existing_lf_mean") * F.col("_demand"), *fv.LF_RANGE),
    })
    delta, flights = F.col("additional_daily_flights"), F.col("daily_flights")
    seat_miles = F.lit(float(fv.SEATS_PER_DEPARTURE * fv.DAYS_PER_YEAR)) * F.col("distance")
    added = delta * seat_miles * (
        F.lit(fv.REVENUE_PER_SEAT_MILE) * F.col("_new_lf") * F.col("_yield")
        - F.lit(fv.COST_PER_SEAT_MILE) * F.col("_cost")
    )
    kept = (
        flights * seat_miles * F.lit(fv.REVENUE_PER_SEAT_MILE)
        * (F.col("_old_lf") - F.col("base_lf")) * F.col("_yield")
    )
    mixed = (flights * F.col("_old_lf") + delta * F.col("_new_lf")) / F.col("daily_flights_after")
    return drawn.select(
        *KEY, "run",
        clamp(mixed, *fv.LF_RANGE).alias("lf"),
        clamp(F.col("otp_mean") + F.col("_otp_noise"), *fv.OTP_RANGE).alias("otp"),
        (added + kept).alias("revenue"),
    )


def summarise(runs: DataFrame, task_rows: int = TASK_ROWS, max_runs: int | None = None) -> DataFrame:
    """Means and 10th / 90th percentiles per scenario and strategy.

    ``max_runs`` is the largest number of runs of one scenario, if known. A small number is sorted
    in place, within the same aggregate as the means; otherwise the percentiles are found by rank,
    in pieces where a scenario has very many runs.
    """
    means = [
        F.avg("lf").alias("mean_lf"), F.avg("otp").alias("mean_otp"),
        F.avg("revenue").alias("mean_revenue"),
        F.avg((F.col("revenue") > 0).cast("double")).alias("p_revenue_positive"),
    ]
    names = {"lf": ("p10_lf", "p90_lf"), "revenue": ("p10_revenue", "p90_revenue")}
    if max_runs is not None and max_runs <= min(task_rows, SORTED_RUNS):
        lists = runs.groupBy(*KEY).agg(
            *means, *[F.sort_array(F.collect_list(c)).alias(f"_{c}") for c in names]
        )
        return lists.withColumns({
            n: _interpolated(f"_{c}", p)
            for c, pair in names.items() for n, p in zip(pair, (0.1, 0.9))
        }).drop(*[f"_{c}" for c in names])
    out = runs.groupBy(*KEY).agg(*means)
    for c, pair in names.items():
        out = out.join(
            percentiles(runs, KEY, c, dict(zip(pair, (0.1, 0.9))), task_rows=task_rows), KEY
        )
    return out


def _interpolated(values: str, p: float) -> Column:
    """Percentile of a sorted array by linear interpolation."""
    at = f"({p}D * (size({values}) - 1))"
    low = f"get({values}, int(floor({at})))"
    high = f"get({values}, int(ceil({at})))"
    return F.expr(f"{low} + ({high} - {low}) * ({at} - floor({at}))")


def verdict(revenue: Column, otp_pp: Column) -> Column:
    return first_match(
        [
            ((revenue > 0) & (otp_pp > -3.0), "RECOMMENDED"),
            (revenue > 0, "PROCEED WITH CAUTION"),
        ],
        "NOT RECOMMENDED",
    )


def comparison_table(prepared: DataFrame, summary: DataFrame) -> DataFrame:
    """Report row per scenario and strategy: changes, ranges, verdict and its sentence."""
    joined = accepted(prepared).join(summary, KEY)

    def pct(c: str) -> Column:
        return rounded(F.col(c) * 100.0, 1)

    def millions(c: str) -> Column:
        return rounded(F.col(c) / 1e6, 2)

    lf_pp = (F.col("mean_lf") - F.col("base_lf")) * 100.0
    otp_pp = (F.col("mean_otp") - F.col("base_otp")) * 100.0
    delta = F.col("additional_daily_flights")
    out = joined.withColumn("Verdict", verdict(F.col("mean_revenue"), otp_pp))
    sentence = F.format_string(
        fv.RECOMMENDATION_TEXT,
        F.col("Verdict"), F.when(delta >= 0, "+").otherwise(""), delta, F.col("route"),
        F.col("strategy_label"), rounded(lf_pp, 1), rounded(otp_pp, 1),
        rounded(F.col("mean_revenue") / 1e6, 1),
    )
    return out.select(
        "scenario_id", F.col("route").alias("Route"), "strategy_rank",
        delta.alias("Additional_Daily_Flights"),
        F.col("strategy_label").alias("Scenario"), F.col("schedule_change").alias("Schedule"),
        F.col("daily_flights").alias("Daily_Flights_Before"),
        F.col("daily_flights_after").alias("Daily_Flights_After"),
        pct("base_lf").alias("Baseline_LF_%"), pct("mean_lf").alias("Projected_LF_%"),
        rounded(lf_pp, 1).alias("LF_Change_pp"),
        pct("p10_lf").alias("LF_P10_%"), pct("p90_lf").alias("LF_P90_%"),
        pct("base_otp").alias("Baseline_OTP_%"), pct("mean_otp").alias("Projected_OTP_%"),
        rounded(otp_pp, 1).alias("OTP_Change_pp"),
        millions("mean_revenue").alias("Annual_Revenue_Delta_M$"),
        millions("p10_revenue").alias("Rev_P10_M$"), millions("p90_revenue").alias("Rev_P90_M$"),
        "Verdict", sentence.alias("Recommendation"),
    )


def best_strategy(comparison: DataFrame) -> DataFrame:
    """Per scenario the row with the highest revenue change; the earlier strategy wins ties."""
    key = F.struct(F.col("Annual_Revenue_Delta_M$"), -F.col("strategy_rank"))
    return (
        comparison.groupBy("scenario_id").agg(F.max_by(F.struct(*comparison.columns), key).alias("b"))
        .select("b.*")
    )


def narrative(comparison: DataFrame) -> DataFrame:
    """One text per scenario: baseline, the three strategies in order, the best option."""
    line = F.format_string(
        fv.STRATEGY_TEXT,
        F.upper("Schedule"), F.col("Projected_LF_%"), F.col("LF_Change_pp"),
        F.col("Projected_OTP_%"), F.col("OTP_Change_pp"),
        rounded(F.col("Annual_Revenue_Delta_M$"), 1),
    )
    key = F.struct(F.col("Annual_Revenue_Delta_M$"), -F.col("strategy_rank"))
    # At most one line per strategy and scenario.
    grouped = comparison.groupBy("scenario_id").agg(
        F.first("Route").alias("route"), F.first("Additional_Daily_Flights").alias("k"),
        F.first("Baseline_LF_%").alias("lf"), F.first("Baseline_OTP_%").alias("otp"),
        F.array_sort(F.collect_list(F.struct("strategy_rank", line.alias("line")))).alias("l"),
        F.max_by("Recommendation", key).alias("best"),
    )
    lines = F.array_join(F.transform("l", lambda s: s["line"]), "\n")
    text = F.concat_ws(
        "\n",
        F.format_string(fv.NARRATIVE_HEAD, "route", "k", "lf", "otp"), lines,
        F.format_string(fv.NARRATIVE_END, "best"),
    )
    return grouped.select("scenario_id", F.col("route").alias("Route"), text.alias("narrative"))


def compare(scenarios: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Comparison table of all strategies for each scenario row."""
    prepared = prepare_scenarios(compare_strategies(scenarios), routes)
    return comparison_table(prepared, outcomes(prepared))


def histogram(df: DataFrame, value: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value (per ``by``).

    Columns: by, bin (1-based), bin_low, bin_high, n. The largest value belongs to the last bin.
    """
    by = by or []
    known = df.where(F.col(value).isNotNull())
    ends = known.groupBy(*by).agg(
        F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi")
    )
    if by:
        placed = known.join(ends, by)
    else:
        placed = known.withColumns({
            "_lo": ends.select("_lo").scalar(), "_hi": ends.select("_hi").scalar()
        })
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    spot = F.when(width == 0, F.lit(1)).otherwise(
        F.least(
            F.floor((F.col(value) - F.col("_lo")) / F.nullif(width, F.lit(0.0))).cast("int") + 1,
            F.lit(bins),
        )
    )
    return (
        placed.groupBy(*by, spot.alias("bin"), "_lo", "_hi")
        .agg(F.count("*").alias("n"))
        .select(
            *by, "bin",
            (F.col("_lo") + width * (F.col("bin") - 1)).alias("bin_low"),
            (F.col("_lo") + width * F.col("bin")).alias("bin_high"), "n",
        )
    )


