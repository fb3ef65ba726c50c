"""As-of join: every row meets the latest earlier row of another table with the same keys.

Both sides are put into one sequence per key, ordered by time, and the last row of the right side is
carried along. That takes one exchange on the keys, whatever the distance in time, where a join on a
range of times would pair every row with all earlier ones. Keys with more rows than one task should
handle are cut into time pieces (see ``ordered``); a piece starts with the last row that the pieces
before it have seen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.operators.ordered import PIECE, TASK_ROWS, attach, split_groups

_AT, _SIDE, _SPREAD, _FOUND, _ROW = "_asof_at", "_asof_side", "_asof_spread", "_asof_found", "_asof_row"


def _given(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    by: Sequence[str],
    tolerance: dt.timedelta | None = None,
    tie_break: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Every row of ``left`` once, with the columns of the latest row of ``right`` up to its time.

    ``by`` are key columns that both tables have. Of several right rows with one key and time, the one
    that is largest in ``tie_break`` and then in its other columns counts (nulls lowest). A right row
    that is older than ``tolerance`` does not count. Rows without a match, also those without a key or
    a time, get nulls. Equal left rows stay equal rows. Columns of the right side that the left side
    has already are an error.
    """
    taken = [*tie_break, *[c for c in right.columns if c not in by and c not in tie_break]]
    clash = sorted(set(taken) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")

    latest = right.where(_given(right_at, *by)).groupBy(*by, F.col(right_at).alias(_AT)).agg(
        F.max(F.struct(*taken)).alias(_FOUND)
    )
    # Rows of one instant are told apart by a hash, so that a hot instant can be cut as well.
    plain = [f.name for f in left.schema if isinstance(f.dataType, T.AtomicType)]
    asked = left.where(_given(left_at, *by)).select(
        *by, F.col(left_at).alias(_AT), F.lit(1).alias(_SIDE), F.xxhash64(*plain).alias(_SPREAD),
        F.struct(*left.columns).alias(_ROW),
    )
    sequence = latest.withColumns({_SIDE: F.lit(0), _SPREAD: F.lit(0).cast("long")}).unionByName(
        asked, allowMissingColumns=True
    )
    split = split_groups(sequence, by, [F.col(_AT), F.col(_SIDE), F.col(_SPREAD)], task_rows)
    carry = F.last(_FOUND, ignorenulls=True)

    def along(*group: str):
        return Window.partitionBy(*(group or [F.lit(0)])).orderBy(_AT, _SIDE).rowsBetween(
            Window.unboundedPreceding, 0
        )

    parts = []
    if split.ordinary is not None:
        parts.append(split.ordinary.withColumn(_FOUND, carry.over(along(*by))))
    if split.cut is not None:
        # One row per piece and key; only rows of the right side have an order here.
        seen = split.cut.groupBy(PIECE, *by).agg(
            F.max_by(_FOUND, F.when(F.col(_SIDE) == 0, F.col(_AT))).alias("_asof_last")
        )
        before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(PIECE).rowsBetween(
            Window.unboundedPreceding, -1
        )
        seen = seen.select(PIECE, *by, F.last("_asof_last", ignorenulls=True).over(before).alias("_asof_in"))
        local = split.cut.withColumn(_FOUND, carry.over(along(PIECE, *by)))
        parts.append(attach(local, seen, [PIECE, *by]).withColumn(
            _FOUND, F.coalesce(_FOUND, "_asof_in")
        ).drop(PIECE, "_asof_in"))
    joined = reduce(DataFrame.unionByName, parts).where(F.col(_SIDE) == 1)

    near = F.col(_FOUND).isNotNull()
    if tolerance is not None:
        near = near & (F.col(_AT) <= F.col(f"{_FOUND}.{right_at}") + F.lit(tolerance))
    matched = joined.select(
        *[F.col(f"{_ROW}.{c}").alias(c) for c in left.columns],
        *[F.when(near, F.col(f"{_FOUND}.{c}")).alias(c) for c in taken],
    )
    types = {f.name: f.dataType for f in right.schema}
    lone = left.where(~_given(left_at, *by)).select(
        *left.columns, *[F.lit(None).cast(types[c]).alias(c) for c in taken]
    )
    order = [*left.columns, *[c for c in right.columns if c in taken]]
    return matched.unionByName(lone).select(*order)
