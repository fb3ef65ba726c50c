from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream.operators.ordered import percentiles, running_totals


def data(n=300, seed=1):
    rng = random.Random(seed)
    return [
        (i, "HOT" if i % 3 else rng.choice(["A", "B", None]), rng.randrange(0, 50) / 4.0)
        for i in range(n)
    ]


@pytest.mark.parametrize("task_rows", [5, 40, 10_000])
@pytest.mark.parametrize("group", [["g"], []])
def test_running_totals(spark, group, task_rows):
    rows = data()
    df = spark.createDataFrame(rows, "id long, g string, x double")
    out = running_totals(
        df, group, [F.col("id").desc()], {"n": F.lit(1), "s": F.col("x")}, task_rows
    ).collect()
    seen_n, seen_s, want = Counter(), Counter(), {}
    for i, g, x in sorted(rows, reverse=True):
        key = g if group else "all"
        seen_n[key] += 1
        seen_s[key] += x
        want[i] = (seen_n[key], seen_s[key])
    assert {r.id: (r.n, r.s) for r in out} == want


@pytest.mark.parametrize("few_values", [True, False])
@pytest.mark.parametrize("task_rows", [4, 10_000])
def test_percentiles(spark, few_values, task_rows):
    rows = data() + [(1000, "LONE", 7.0), (1001, "NULLS", None)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    points = {"low": 0.0, "p10": 0.1, "mid": 0.5, "p75": 0.75, "high": 1.0}
    got = {
        r.g: tuple(r[n] for n in points)
        for r in percentiles(df, ["g"], "x", points, few_values, task_rows).collect()
    }
    assert got.keys() == {g for _, g, _ in rows}
    # A key without values stays, with null percentiles.
    assert got.pop("NULLS") == (None,) * len(points)
    for g in got:
        values = [x for _, h, x in rows if h == g and x is not None]
        assert got[g] == pytest.approx(np.percentile(values, [p * 100 for p in points.values()]))


def test_percentiles_of_a_whole_column(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(40)], "x double")
    (r,) = percentiles(df, [], "x", {"p": 0.9}, task_rows=7).collect()
    assert r.p == pytest.approx(np.percentile([i * i for i in range(40)], 90))


def test_without_groups_no_window_over_all_rows(spark):
    from conftest import executed_plan_of

    df = spark.range(100).withColumn("x", F.lit(1.0))
    out = running_totals(df, [], [F.col("id")], {"s": F.col("x")}, 10)
    assert "_piece" in executed_plan_of(out)
    assert out.agg(F.max("s")).first()[0] == 100.0
