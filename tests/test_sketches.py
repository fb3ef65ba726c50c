from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slipstream.operators import sketches


def test_merged_answers_are_inside_the_stated_errors(spark):
    n = 60_000
    rows = spark.range(n).selectExpr(
        "id % 2 as route", "id % 12 as month", "id % 5000 as tail", "double(id * 7919 % 60000) as delay")
    parts = sketches.build(rows, ["route", "month"], ["tail"], ["delay"])
    whole = sketches.merge(parts, [])
    direct = sketches.build(rows, [], ["tail"], ["delay"])
    asked = {"p10": ("delay", 0.1), "p75": ("delay", 0.75)}
    for made in (whole, direct, sketches.merge(sketches.merge(parts, ["route"]), [])):
        (r,) = sketches.answers(made, [], asked).collect()
        assert r.n_rows == n
        assert r.tail_distinct == pytest.approx(5000, rel=5 * sketches.distinct_error())
        assert (r.p10 / n, r.p75 / n) == pytest.approx((0.1, 0.75), abs=2 * sketches.rank_error())


def test_unknown_values_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [("a", None, None), ("a", "x", 1.0), ("b", None, None), (None, "x", 3.0)], "k string, d string, v double")
    asked = {"mid": ("v", 0.5)}
    made = sketches.merge(sketches.build(rows, ["k"], ["d"], ["v"]), ["k"])
    got = {r.k: (r.n_rows, r.d_distinct, r.mid) for r in sketches.answers(made, ["k"], asked).collect()}
    assert got == {"a": (2, 1, 1.0), "b": (1, 0, None), None: (1, 1, 3.0)}
    none = sketches.build(rows.where(F.lit(False)), ["k"], ["d"], ["v"])
    assert sketches.answers(none, ["k"], asked).count() == 0
