"""Features along the sequence of legs that one vehicle flies.

All of them need the earlier legs of the same vehicle in time order. One hash exchange on the
vehicle and one sort on (vehicle, day, hour, tie-breaks) serve every column: the per-day windows
partition on (vehicle, day), which the same exchange and the same sort satisfy. A vehicle with more
legs than one task should handle is cut into time pieces (see ``ordered``).

Legs without a vehicle have no earlier leg; each forms a group of its own, so that many of them do
not meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipstream.functions.columns import clamp, flag
from slipstream.operators.ordered import PIECE, TASK_ROWS, attach, split_groups

FEATURES = (
    "prev_tail_dep_delay", "prev_tail_arr_delay", "legs_today_before",
    "cumulative_tail_delay_today", "hours_since_last_flight", "quick_turn_flag",
    "tail_delay_streak",
)
DEFAULT_AIR_MINUTES = 90.0
DEFAULT_HOUR = 12
DEFAULT_GAP_HOURS = 4.0
MAX_GAP_HOURS = 16.0


def rotation_features(
    legs: DataFrame,
    tie_break: Sequence[str],
    vehicle: str = "Tail_Number",
    day: str = "FlightDate",
    hour: str = "DepHour",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the seven rotation features to ``legs``.

    ``tie_break`` orders legs of one vehicle in the same hour; together with vehicle, day and hour
    it must identify a leg, so that the result does not depend on the row order of the input.
    """
    arrival_delay = F.col("ArrDelay") if "ArrDelay" in legs.columns else F.lit(None).cast("double")
    late = F.col("ArrDel15") == 1 if "ArrDel15" in legs.columns else F.lit(False)
    air = F.col("AirTime") if "AirTime" in legs.columns else F.lit(None).cast("double")
    hour_of = F.coalesce(F.col(hour), F.lit(DEFAULT_HOUR))
    prepared = legs.withColumns({
        "_hour": hour_of,
        "_lone": F.when(F.col(vehicle).isNull(), F.struct(day, hour, *tie_break)),
        # Minutes since an arbitrary origin: enough for differences, cheap to compare.
        "_dep": F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) * 1440.0 + hour_of * 60.0,
        "_late": F.coalesce(late, F.lit(False)),
        "_delay": F.coalesce(F.col("DepDelay"), F.lit(0.0)),
    }).withColumns({
        "_leg": F.struct(
            F.col("DepDelay").alias("dep_delay"),
            arrival_delay.alias("arr_delay"),
            (F.col("_dep") + F.col("_delay") + F.coalesce(air, F.lit(DEFAULT_AIR_MINUTES))).alias(
                "arrived"
            ),
        )
    })
    order = [F.col(c) for c in (day, "_hour", *tie_break)]
    split = split_groups(prepared.where(F.col(vehicle).isNotNull()), [vehicle], order, task_rows)
    if split.cut is None:
        # No oversized vehicle: one pass over all legs, those without a vehicle included.
        done = _local(prepared, [vehicle, "_lone"], day, order)
    else:
        marks = [c for c in prepared.columns]
        unassigned = prepared.where(F.col(vehicle).isNull())
        ordinary = _local(
            split.ordinary.unionByName(unassigned), [vehicle, "_lone"], day, order
        )
        pieces = _carry(split.cut, vehicle, day, order)
        done = ordinary.select(*marks, *_RAW).unionByName(pieces.select(*marks, *_RAW))
    return _finish(done).select(*legs.columns, *FEATURES)


# Intermediate columns that both ways produce.
_RAW = ("_before", "_legs", "_debt", "_streak")


def _local(df: DataFrame, group: list[str], day: str, order: list[Column]) -> DataFrame:
    """Window columns of the legs of one group; day windows reuse the exchange and the sort."""
    along = Window.partitionBy(*group).orderBy(*order)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    today = Window.partitionBy(*group, day).orderBy(*order[1:])
    earlier_today = today.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_rn", F.row_number().over(along))
        .withColumns({
            "_before": F.lag("_leg").over(along),
            # Position of the last punctual leg; the streak is the distance to it.
            "_broken": F.max(F.when(~F.col("_late"), F.col("_rn"))).over(earlier),
            "_legs": F.row_number().over(today) - F.lit(1),
            "_debt": F.coalesce(F.sum("_delay").over(earlier_today), F.lit(0.0)),
        })
        .withColumn("_streak", F.col("_rn") - F.lit(1) - F.coalesce(F.col("_broken"), F.lit(0)))
    )


def _carry(cut: DataFrame, vehicle: str, day: str, order: list[Column]) -> DataFrame:
    """Window columns of oversized vehicles: per piece, plus what earlier pieces hand over."""
    local = _local(cut, [PIECE, vehicle], day, order)
    last_break = F.max(F.when(~F.col("_late"), F.col("_rn")))
    ends = local.groupBy(vehicle, PIECE).agg(
        F.max_by("_leg", F.col("_rn")).alias("_last"),
        F.count("*").alias("_size"),
        (F.count("*") - F.coalesce(last_break, F.lit(0))).alias("_open"),
        flag(last_break.isNotNull()).alias("_breaks"),
    )
    by_piece = Window.partitionBy(vehicle).orderBy(PIECE)
    # Pieces since the last one with a punctual leg: their open ends add up to one streak.
    ends = ends.withColumn(
        "_island", F.sum("_breaks").over(by_piece.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn(
        "_open_total",
        F.sum("_open").over(
            Window.partitionBy(vehicle, "_island").orderBy(PIECE).rowsBetween(
                Window.unboundedPreceding, 0
            )
        ),
    ).select(
        vehicle, PIECE,
        F.lag("_last").over(by_piece).alias("_in_last"),
        F.coalesce(F.lag("_open_total").over(by_piece), F.lit(0)).alias("_in_streak"),
    )
    by_day = Window.partitionBy(vehicle, day).orderBy(PIECE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    days = (
        local.groupBy(vehicle, day, PIECE)
        .agg(F.count("*").alias("_size"), F.sum("_delay").alias("_sum"))
        .select(
            vehicle, day, PIECE,
            F.coalesce(F.sum("_size").over(by_day), F.lit(0)).alias("_in_legs"),
            F.coalesce(F.sum("_sum").over(by_day), F.lit(0.0)).alias("_in_debt"),
        )
    )
    joined = attach(attach(local, ends, [vehicle, PIECE]), days, [vehicle, day, PIECE])
    return joined.withColumns({
        "_before": F.coalesce(F.col("_before"), F.col("_in_last")),
        "_legs": (F.col("_legs") + F.col("_in_legs")).cast("int"),
        "_debt": F.col("_debt") + F.col("_in_debt"),
        "_streak": (
            F.col("_streak") + F.when(F.col("_broken").isNull(), F.col("_in_streak")).otherwise(0)
        ).cast("int"),
    })


def _finish(df: DataFrame) -> DataFrame:
    gap = (F.col("_dep") - F.col("_before.arrived")) / F.lit(60.0)
    zero = F.lit(0.0)
    return df.withColumn(
        "hours_since_last_flight",
        F.when(gap.between(0.0, MAX_GAP_HOURS), gap).otherwise(F.lit(DEFAULT_GAP_HOURS)),
    ).withColumns({
        "prev_tail_dep_delay": F.coalesce(F.col("_before.dep_delay"), zero),
        "prev_tail_arr_delay": clamp(F.coalesce(F.col("_before.arr_delay"), zero), -30.0, 300.0),
        "legs_today_before": clamp("_legs", 0, 10),
        "cumulative_tail_delay_today": clamp("_debt", -30.0, 300.0),
        "quick_turn_flag": flag(F.col("hours_since_last_flight") < 1.0),
        "tail_delay_streak": clamp("_streak", 0, 10),
    })
