"""Mean departure delay of all flights in the two hours up to each departure.

Departures lie on whole hours, so the window (t - 2 h, t] is exactly the hours t - 1 and t. Flights
are therefore added up per hour first and the totals are joined back; no window runs over the
flights as one sequence.

``trailing_mean_at`` takes departures at any time. A value enters the window at its time and leaves
it one span later, so the sum over the window is a running sum of what enters minus what leaves. Every
row is worked on twice, however many rows a window holds; a RANGE frame would add up each window anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.functions.columns import ratio
from slipstream.operators.ordered import TASK_ROWS, attach, running_totals
from slipstream.operators.staging import stage

MODES = ("peers", "running", "strict")


def trailing_mean_delay(
    flights: DataFrame,
    mode: str = "peers",
    tie_break: Sequence[str] = (),
    counted: Column | None = None,
    day: str = "FlightDate",
    hour: str = "DepHour",
    value: str = "DepDelay",
    output: str = "rolling_avg_dep_delay",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the trailing mean as ``output``; hours without any known delay give 0.

    ``peers``: all flights of the hour count, the flight itself included (a RANGE frame).
    ``running``: of the own hour only flights up to this one in ``tie_break`` order.
    ``strict``: only the hour before, so that no flight sees its own delay.
    ``counted`` limits which flights enter the mean, for example one origin.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    at = (
        F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) * F.lit(24)
        + F.coalesce(F.col(hour), F.lit(12))
    ).cast("long")
    known = F.col(value) if counted is None else F.when(counted, F.col(value))
    marked = flights.withColumns({"_at": at, "_known": known})

    hours = marked.groupBy("_at").agg(F.count("_known").alias("n"), F.sum("_known").alias("s"))
    # Every hour lends its totals to itself and to the next hour.
    lent = hours.select(
        F.explode(F.array(
            F.struct(F.col("_at").alias("_at"), F.lit(0).alias("age")),
            F.struct((F.col("_at") + 1).alias("_at"), F.lit(1).alias("age")),
        )).alias("e"), "n", "s",
    )
    totals = lent.groupBy(F.col("e._at").alias("_hour_key")).agg(*[
        F.coalesce(F.sum(F.when(F.col("e.age") == age, F.col(c))), F.lit(0)).alias(f"_{c}{age}")
        for age in (0, 1) for c in ("n", "s")
    ])
    # At most one row per hour of the calendar. Written so that the optimizer knows its size.
    totals = stage(totals)

    if mode == "running":
        if not tie_break:
            raise ValueError("mode 'running' needs tie_break columns")
        marked = running_totals(
            marked, ["_at"], [F.col(c) for c in tie_break],
            {
                "_nr": F.col("_known").isNotNull().cast("long"),
                "_sr": F.coalesce(F.col("_known"), F.lit(0.0)),
            },
            task_rows,
        )
    joined = marked.join(totals, marked["_at"] == totals["_hour_key"], "left")
    own = {
        "peers": ("_n0", "_s0"), "running": ("_nr", "_sr"), "strict": (None, None),
    }[mode]
    n, s = F.col("_n1"), F.col("_s1")
    if own[0]:
        n, s = n + F.col(own[0]), s + F.col(own[1])
    return joined.withColumn(output, F.coalesce(ratio(s, n), F.lit(0.0))).select(
        *flights.columns, output
    )


# Values enter sums as decimals: what leaves then cancels what entered, in any order of the rows.
EXACT = "decimal(18,6)"


def trailing_mean_at(
    flights: DataFrame,
    at: str,
    span: dt.timedelta = dt.timedelta(hours=2),
    keys: Sequence[str] = (),
    mode: str = "peers",
    counted: Column | None = None,
    value: str = "DepDelay",
    output: str = "rolling_avg_dep_delay",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the mean over ``(time - span, time]`` of the rows with equal ``keys`` as ``output``.

    ``peers``: rows of the same time count, the row itself included. ``strict``: only earlier rows do.
    Without any known value the mean is 0, also for rows without a time, which count nowhere. Null keys
    are equal to each other. Values are taken to six decimals; those that are not finite or have more
    than twelve digits before the point are unknown. ``counted`` limits which rows enter the mean.
    """
    if mode not in ("peers", "strict"):
        raise ValueError("mode must be peers or strict")
    known = F.col(value) if counted is None else F.when(counted, F.col(value))
    names = [f"_trail_key{i}" for i in range(len(keys))]
    marked = [F.col(k).alias(n) for k, n in zip(keys, names)]
    steps = flights.where(F.col(at).isNotNull()).select(
        *marked, F.col(at).alias("_trail_at"), known.try_cast(EXACT).alias("v")
    ).select(*names, "v", F.explode(F.array(
        F.struct(F.col("_trail_at"), F.lit(1).alias("sign")),
        F.struct((F.col("_trail_at") + F.lit(span)).alias("_trail_at"), F.lit(-1).alias("sign")),
    )).alias("e"))
    enters = F.col("e.sign") == 1
    zero = F.lit(0).cast(EXACT)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), zero)

    # One row per key and instant, combined before the shuffle.
    instants = stage(steps.groupBy(*names, F.col("e._trail_at").alias("_trail_at")).agg(
        F.max(enters).alias("_trail_here"),
        F.count(F.when(enters, F.col("v"))).alias("_trail_n_in"),
        F.count(F.when(~enters, F.col("v"))).alias("_trail_n_out"),
        total(F.when(enters, F.col("v"))).alias("_trail_s_in"),
        total(F.when(~enters, F.col("v"))).alias("_trail_s_out"),
    ))
    running = running_totals(instants, names, [F.col("_trail_at")], {
        "_trail_n": F.col("_trail_n_in") - F.col("_trail_n_out"),
        "_trail_s": F.col("_trail_s_in") - F.col("_trail_s_out"),
    }, task_rows).where("_trail_here")
    n, s = F.col("_trail_n"), F.col("_trail_s")
    if mode == "strict":
        n, s = n - F.col("_trail_n_in"), s - F.col("_trail_s_in")
    means = running.select(*names, "_trail_at", F.coalesce(ratio(s, n), F.lit(0.0)).alias("_trail_mean"))
    rows = flights.select("*", *marked, F.col(at).alias("_trail_at"))
    return attach(rows, means, [*names, "_trail_at"]).select(
        *flights.columns, F.coalesce("_trail_mean", F.lit(0.0)).alias(output)
    )
