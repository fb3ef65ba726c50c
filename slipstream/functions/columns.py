"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _templated(template: str, c: ColumnOrName) -> Column | None:
    """The SQL template applied to a plain column name: one parsed expression is much cheaper to
    build than a chain of function calls. None for anything but a plain name."""
    return F.expr(template.format(c)) if isinstance(c, str) and c.isidentifier() else None


def number(c: ColumnOrName) -> Column:
    """Text or number to double; bad text and NaN become null."""
    made = _templated("nullif(try_cast({0} as double), double('NaN'))", c)
    if made is not None:
        return made
    return F.nullif(as_column(c).try_cast("double"), F.lit(float("nan")))


def clamp(c: ColumnOrName, low, high) -> Column:
    """Limit to [low, high] and keep null (``least``/``greatest`` alone would drop it)."""
    value = as_column(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def rounded(c: ColumnOrName, digits: int) -> Column:
    """Round half up on the decimal value, so 0.285 gives 0.29 on every engine."""
    made = _templated(f"cast(round(cast({{0}} as decimal(28,10)), {digits}) as double)", c)
    if made is not None:
        return made
    return F.round(as_column(c).cast("decimal(28,10)"), digits).cast("double")


def whole(c: ColumnOrName) -> Column:
    """Round to the nearest whole number, halves to even."""
    return F.bround(as_column(c), 0).cast("long")


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ratio(top: ColumnOrName, bottom: ColumnOrName) -> Column:
    """Division that gives null on zero."""
    return as_column(top).cast("double") / F.nullif(as_column(bottom).cast("double"), F.lit(0.0))


def year_month(year: str, month: str) -> Column:
    return F.format_string("%d-%02d", year, month)


def first_match(pairs, default=None) -> Column:
    """Value of the first condition that holds, in the order given."""
    (condition, value), *rest = pairs
    chain = reduce(lambda acc, p: acc.when(p[0], F.lit(p[1])), rest, F.when(condition, F.lit(value)))
    return chain if default is None else chain.otherwise(F.lit(default))


def right_closed_bin(c: ColumnOrName, edges, labels) -> Column:
    """Label of the interval (edge, next edge] that holds the value; null outside all of them."""
    value = as_column(c)
    inside = [(value <= F.lit(high), label) for high, label in zip(edges[1:], labels)]
    return F.when(value > F.lit(edges[0]), first_match(inside))


def season(month: ColumnOrName, labels: tuple[str, str, str, str]) -> Column:
    """Label of the season; ``labels`` are for winter, spring, summer and fall."""
    # Months 12, 1, 2 -> 0; 3-5 -> 1; 6-8 -> 2; 9-11 -> 3.
    index = ((as_column(month) % F.lit(12)) / F.lit(3)).cast("int")
    return F.element_at(F.array(*map(F.lit, labels)), index + F.lit(1))


def cyclic(c: ColumnOrName, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = F.lit(2.0) * F.pi() * as_column(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def literal_table(spark: SparkSession, names, rows) -> DataFrame:
    """Small fixed table as a plan of literals (no Python rows in the job)."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def nullif_zero(c: ColumnOrName) -> Column:
    return F.nullif(as_column(c).cast("double"), F.lit(0.0))
