"""Connected components of a link table, by alternating star contraction.

Both steps replace the links of a node by links to its smallest neighbour: first towards larger
neighbours, then towards smaller ones, until nothing changes. A round is a partial-and-final
minimum and a join on the node; links of a hot node are split by the adaptive skew join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.common import written


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def spanning(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between names that join what the links (a, b) of positions join: at most one a name."""
    known, place = np.unique(names, return_inverse=True)
    root = known[forest(len(known), place[a], place[b])]
    return known[root != known], root[root != known]


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40)),
    ).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    ).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links(a, b)``; component is the smallest id reachable.

    Links may repeat, point either way or from an id to itself; null ends are ignored. An empty
    table gives an empty table. Ids that occur in self-links only are not returned.
    """
    now = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(now)
    while before[0]:
        now = written(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component"))
    ).distinct()
