"""Mergeable summaries: keep them per small period, merge them for any larger one.

Exact distinct counts and percentiles of a year need the year's rows again. A sketch per route and
month is a few kilobytes whatever the rows, and merging sketches gives the sketch of the union, so
any period or group of routes is answered from the small table. Building is one aggregation with
partial sketches per task: a hot route sends its reducer one sketch per task.

Errors: a distinct count is off by about ``1.04 / sqrt(2 ** lg_k)`` of itself (one standard
deviation), a quantile's rank by about ``rank_error(k)`` of all rows (99 of 100 answers).
Nulls enter no sketch. A group without known values gives a distinct count of 0 and null quantiles.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12  # registers of a distinct sketch, as a power of two
K = 800  # size of a quantile sketch


def rank_error(k: int = K) -> float:
    """Normalised rank error of a quantile sketch of size ``k``, one-sided, at 99 % confidence."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard deviation of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def build(
    df: DataFrame, keys: Sequence[str], distinct: Iterable[str] = (), values: Iterable[str] = (),
    lg_k: int = LG_K, k: int = K,
) -> DataFrame:
    """Per group: n_rows, ``<c>_distinct`` per column of ``distinct``, ``<c>_ranks`` per column of ``values``."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"{c}_distinct") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"{c}_ranks") for c in values],
    )


def merge(sketches: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """The same columns for coarser ``keys``; merged sketches merge again."""
    made = [c for c in sketches.columns if c not in keys]
    return sketches.groupBy(*keys).agg(*[
        F.hll_union_agg(c).alias(c) if c.endswith("_distinct")
        else F.kll_merge_agg_double(c, F.lit(k)).alias(c)
        for c in made if c.endswith(("_distinct", "_ranks"))
    ], F.sum("n_rows").alias("n_rows"))


def answers(
    sketches: DataFrame, keys: Sequence[str], quantiles: dict[str, tuple[str, float]] | None = None
) -> DataFrame:
    """keys, n_rows, ``<c>_distinct`` as a count, and each of ``quantiles``: name -> (column, share)."""
    found = {}
    for name, (column, share) in (quantiles or {}).items():
        ranks = F.col(f"{column}_ranks")
        known = F.kll_sketch_get_n_double(ranks) > 0
        found[name] = F.when(known, F.kll_sketch_get_quantile_double(ranks, F.lit(float(share))))
    counts = [
        F.hll_sketch_estimate(c).alias(c) for c in sketches.columns if c.endswith("_distinct")
    ]
    return sketches.select(*keys, "n_rows", *counts, *[v.alias(n) for n, v in found.items()])
