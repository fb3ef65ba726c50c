from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slipstream.operators.asof import as_of_join
from slipstream.operators.weather_join import join_weather_as_of

START = dt.datetime(2024, 3, 30)
LEFT = "id long, k string, at timestamp_ntz"
RIGHT = "k string, seen timestamp_ntz, v double, w string"
TOLERANCE = dt.timedelta(minutes=7, microseconds=1)


def tables(seed=5, n=200):
    rng = random.Random(seed)

    def time():
        # Few distinct minutes make ties; microseconds decide at the edge of the tolerance.
        return None if rng.random() < 0.05 else START + dt.timedelta(
            minutes=rng.randrange(90), microseconds=rng.randrange(2)
        )

    def key():
        return rng.choice(["hot", "hot", "hot", "a", "b", None])

    left = [(i % (n - 20), key(), time()) for i in range(n)]
    left += left[:10]  # repeated rows
    right = [(key(), time(), rng.choice([None, 1.0, 2.0]), rng.choice("xy")) for _ in range(40)]
    return left, right + [("only right", START, 1.0, "x")]


def lowest_null(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def expected(left, right, tolerance, by=True):
    out = []
    for i, k, at in left:
        fit = [
            r for r in right
            if at is not None and r[1] is not None and r[1] <= at and (not by or (k is not None and r[0] == k))
        ]
        best = max(fit, key=lambda r: (r[1], lowest_null((r[3], r[2]))), default=None)
        if best is not None and tolerance is not None and at > best[1] + tolerance:
            best = None
        out.append((i, k, at, *(best[1:] if best else (None, None, None))))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("task_rows", [1, 7, 50, 10_000])
@pytest.mark.parametrize("tolerance", [TOLERANCE, None])
def test_matches_loops(spark, task_rows, tolerance):
    left, right = tables()
    got = as_of_join(
        spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT),
        "at", "seen", ["k"], tolerance, ["w"], task_rows,
    )
    assert got.columns == ["id", "k", "at", "seen", "v", "w"]
    assert collected(got) == expected(left, right, tolerance)


@pytest.mark.parametrize("task_rows", [11, 10_000])
def test_without_key_is_one_sequence(spark, task_rows):
    left, right = tables(9)
    right_frame = spark.createDataFrame(right, RIGHT).drop("k")
    got = as_of_join(spark.createDataFrame(left, LEFT), right_frame, "at", "seen", [], TOLERANCE, ["w"], task_rows)
    assert collected(got) == expected(left, right, TOLERANCE, by=False)


def test_empty_sides(spark):
    left, right = tables()
    none_right = spark.createDataFrame([], RIGHT)
    got = as_of_join(spark.createDataFrame(left, LEFT), none_right, "at", "seen", ["k"])
    assert collected(got) == expected(left, [], None)
    assert as_of_join(spark.createDataFrame([], LEFT), none_right, "at", "seen", ["k"]).count() == 0


def test_equal_names_are_refused(spark):
    frame = spark.createDataFrame([], LEFT)
    with pytest.raises(ValueError, match="id"):
        as_of_join(frame, frame.withColumnRenamed("at", "seen"), "at", "seen", ["k"])


def test_one_exchange_on_the_key(spark):
    left, right = tables()
    got = as_of_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "at", "seen", ["k"])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" in plan


def test_weather_defaults(spark):
    flights = spark.createDataFrame(
        [(1, "HUB", START), (2, "HUB", START + dt.timedelta(hours=3)), (3, "X", START)],
        "id long, Origin string, at timestamp_ntz",
    )
    weather = spark.createDataFrame(
        [("HUB", START - dt.timedelta(hours=1), 2.0, 1), ("HUB", START - dt.timedelta(hours=2), 9.0, 0)],
        "station string, valid timestamp_ntz, vsby double, low_visibility_flag int",
    )
    got = {r.id: (r.vsby, r.low_visibility_flag) for r in join_weather_as_of(flights, weather, "at").collect()}
    assert got == {1: (2.0, 1), 2: (10.0, 0), 3: (10.0, 0)}
    later = join_weather_as_of(flights, weather, "at", dt.timedelta(hours=4)).where(F.col("id") == 2)
    assert later.first().vsby == 2.0
