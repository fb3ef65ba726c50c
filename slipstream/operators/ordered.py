"""Ordered computations that stay parallel when one group holds most of the rows.

A window runs each group in one task. That is the right plan while groups are small, so the
helpers first count rows per group (one pruned column, combined before the shuffle). Groups above
``task_rows`` are cut instead: the rows are range-partitioned on (group, order), each range is a
*piece*, windows run per piece, and one summary row per (group, piece) carries the state of the
earlier pieces forward. Rows are never dropped and both ways give the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipstream.operators.staging import stage

# Largest number of rows of one group that a single task works through.
TASK_ROWS = 5_000_000
# Most pieces of one table; beyond it pieces grow instead, so that a shuffle keeps a sane width.
MAX_PIECES = 20_000

PIECE = "_piece"


@dataclass
class Split:
    """Rows of ordinary groups, and rows of oversized groups cut into pieces (or None)."""

    ordinary: DataFrame | None
    cut: DataFrame | None


def _cut(df: DataFrame, group: Sequence[str], order: Sequence[Column], rows: int, task_rows: int):
    pieces = min(MAX_PIECES, max(1, -(-rows // task_rows)))
    placed = df.repartitionByRange(pieces, *[F.col(g) for g in group], *order)
    # Written at once: the range bounds come from a sample, so piece numbers must be fixed here.
    return stage(placed.withColumn(PIECE, F.spark_partition_id()))


def split_groups(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], task_rows: int = TASK_ROWS
) -> Split:
    """Separate oversized groups of ``df`` and cut them into pieces along ``order``."""
    if not group:
        return Split(None, _cut(df, (), order, df.count(), task_rows))
    keys = list(group)
    # At most (all rows / task_rows) keys can be oversized, so this table is small.
    oversized = stage(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > task_rows))
    rows = oversized.agg(F.sum("_n")).first()[0]
    if rows is None:
        return Split(df, None)
    # Null keys must match too, hence the null-safe comparison.
    marks = oversized.select(*[F.col(k).alias(f"_big_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(marks[f"_big_{k}"])
    big = df.join(marks, same, "left_semi")
    return Split(df.join(marks, same, "left_anti"), _cut(big, keys, order, rows, task_rows))


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add inclusive running sums of ``sums`` within ``group`` along ``order``.

    ``order`` must be unique within a group. Without ``group`` the whole table is one sequence.
    """
    df = df.withColumns({f"_in_{name}": value for name, value in sums.items()})
    split = split_groups(df, group, order, task_rows)
    results = []
    if split.ordinary is not None:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        results.append(
            split.ordinary.withColumns({name: F.sum(f"_in_{name}").over(w) for name in sums})
        )
    if split.cut is not None:
        results.append(_running_totals_in_pieces(split.cut, group, order, list(sums)))
    out = results[0] if len(results) == 1 else results[0].unionByName(results[1])
    return out.drop(*[f"_in_{name}" for name in sums])


def _running_totals_in_pieces(
    cut: DataFrame, group: Sequence[str], order: Sequence[Column], names: list[str]
) -> DataFrame:
    inside = Window.partitionBy(PIECE, *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    # One row per piece and group; a group has at most as many rows here as there are pieces.
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(PIECE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        cut.groupBy(PIECE, *group)
        .agg(*[F.sum(f"_in_{n}").alias(f"_piece_{n}") for n in names])
        .select(
            PIECE, *group, *[F.sum(f"_piece_{n}").over(before).alias(f"_before_{n}") for n in names]
        )
    )
    local = cut.withColumns({n: F.sum(f"_in_{n}").over(inside) for n in names})
    return attach(local, carried, [PIECE, *group]).withColumns({
        n: F.when(F.col(f"_before_{n}").isNull(), F.col(n)).otherwise(
            F.col(n) + F.col(f"_before_{n}")
        )
        for n in names
    }).drop(PIECE, *[f"_before_{n}" for n in names])


def attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a summary to its rows on keys that may be null."""
    marks = summary.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(marks[f"_key_{k}"])
    return rows.join(marks, same, "left").drop(*[f"_key_{k}" for k in keys])


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: dict[str, float],
    few_values: bool = False,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per key, one column per point.

    A key whose values are all null has null percentiles.

    Equal values are counted before the shuffle. ``few_values`` says that a group holds a bounded
    number of distinct values (clamped whole minutes, months); then one aggregate is enough.
    """
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    if few_values:
        return counted.groupBy(*keys).agg(*[
            F.percentile(value, F.lit(p), F.col("_n")).alias(name) for name, p in points.items()
        ])
    # Used for the size check, the ranks and the totals: written once instead of made three times.
    every = stage(counted)
    counted = every.where(F.col(value).isNotNull())
    ranked = running_totals(counted, keys, [F.col(value)], {"_upto": F.col("_n")}, task_rows)
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    ranked = attach(ranked, sizes, keys) if keys else ranked.withColumn("_size", sizes.scalar())
    parts = []
    for name, p in points.items():
        position = F.lit(float(p)) * (F.col("_size") - F.lit(1))
        share = F.max(position - F.floor(position))
        low = F.min(F.when(F.col("_upto") > F.floor(position), F.col(value)))
        high = F.min(F.when(F.col("_upto") > F.ceil(position), F.col(value)))
        parts.append((low + (high - low) * share).alias(name))
    found = ranked.groupBy(*keys).agg(*parts)
    return attach(every.select(*keys).distinct(), found, keys) if keys else found
