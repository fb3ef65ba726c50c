"""Aggregate expressions of the punctuality reports.

Conditions and columns are SQL text: an aggregate is then one parsed expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slipstream.functions.columns import ColumnOrName, as_column, ratio

OPERATED = "Cancelled = 0"
LATE = "Cancelled = 0 and ArrDel15 = 1"
PUNCTUAL = "Cancelled = 0 and ArrDel15 = 0"


def count_where(condition: str) -> Column:
    return F.expr(f"count_if({condition})")


def mean_where(value: str, condition: str) -> Column:
    return F.expr(f"avg(case when {condition} then {value} end)")


def sum_where(value: str, condition: str) -> Column:
    """Sum over matching rows; rows that do not match add zero."""
    return F.expr(f"sum(case when {condition} then {value} else 0.0D end)")


def punctuality() -> Column:
    """Share of operated flights that arrived less than 15 minutes late."""
    return F.expr(f"double(count_if({PUNCTUAL})) / nullif(count_if({OPERATED}), 0)")


def percent_of_rows(condition: str) -> Column:
    return F.expr(f"avg(double({condition})) * 100.0D")


def weighted_mean(value: ColumnOrName, weight: ColumnOrName) -> Column:
    return ratio(F.sum(as_column(value) * as_column(weight)), F.sum(as_column(weight)))
