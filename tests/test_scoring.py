from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from slipstream.operators import quality, scoring


def rows_at_random(n=200, seed=2):
    rng = random.Random(seed)
    # Coarse scores, so ties are frequent and one score holds a third of all rows.
    return [
        (int(rng.random() < 0.4), 0.5 if i % 3 == 0 else rng.randrange(11) / 10)
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def pair_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("task_rows", [2, 5, 1000])
def test_auc_counts_ties_half(spark, task_rows):
    rows = rows_at_random()
    (r,) = scoring.evaluation(frame(spark, rows), task_rows=task_rows).collect()
    assert r.auc_roc == pytest.approx(pair_auc(rows))


def test_average_precision_by_steps(spark):
    rows = rows_at_random(seed=8)
    ap, last_recall, positives = 0.0, 0.0, sum(y for y, _ in rows)
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(y for y, s in rows if s >= t)
        flagged = sum(1 for _, s in rows if s >= t)
        ap += (tp / positives - last_recall) * tp / flagged
        last_recall = tp / positives
    (r,) = scoring.evaluation(frame(spark, rows)).collect()
    assert r.average_precision == pytest.approx(ap)


def test_one_class_has_no_auc(spark):
    (r,) = scoring.evaluation(frame(spark, [(0, 0.2), (0, 0.9)])).collect()
    assert (r.auc_roc, r.average_precision, r.f1_score) == (None, None, 0.0)
    assert (r.true_negatives, r.false_positives) == (1, 1)


def test_curves_start_and_end(spark):
    steps = scoring.score_steps(frame(spark, [(1, 0.9), (0, 0.4), (1, 0.4), (None, 0.1)]))
    roc = {r.threshold: (r.fpr, r.tpr) for r in scoring.roc_points(steps).collect()}
    assert roc == {None: (0.0, 0.0), 0.9: (0.0, 0.5), 0.4: (1.0, 1.0)}
    pr = {r.threshold: (r.precision, r.recall) for r in scoring.pr_points(steps).collect()}
    assert pr == {None: (1.0, 0.0), 0.9: (1.0, 0.5), 0.4: (pytest.approx(2 / 3), 1.0)}


def test_report_of_a_class_that_is_never_predicted(spark):
    predicted = scoring.with_prediction(frame(spark, [(1, 0.1), (0, 0.2), (0, 0.3)]))
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support)
           for r in scoring.class_report(predicted).collect()}
    assert got["1"] == (0.0, 0.0, 0.0, 1)
    assert got["0"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    assert got["accuracy"][0] == pytest.approx(2 / 3)
    assert got["weighted avg"][2] == pytest.approx(1.6 / 3)


def test_heuristic_score_and_bands(spark):
    df = spark.createDataFrame(
        [(0.74, 0.0, 0, 10, 1, 0.0), (0.7, 8.0, 1, 16, 4, 200.0), (1.0, 0.0, 0, 1, 0, -30.0)],
        "otp double, sev double, ts int, h int, dow int, prev double")
    c = F.col
    out = df.select(scoring.heuristic_score(
        c("otp"), c("sev"), c("ts"), c("h"), c("dow"), c("prev")).alias("delay_probability"))
    out = out.withColumn("band", scoring.risk_band())
    assert [(pytest.approx(r[0]), r[1]) for r in out.collect()] == [
        (0.26, "Low"), (0.95, "High"), (0.05, "Low")]


def test_gates(spark):
    metrics = spark.createDataFrame([(0.8, 0.35)], "auc_roc double, f1_score double")
    (r,) = scoring.quality_gates(metrics, F.lit(0.6), F.lit(0.2)).collect()
    assert (r.auc_ok, r.f1_ok, r.storm_ok, r.release) == (True, False, True, False)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    for name, auc in (("b", 0.7), ("a", 0.8), ("c", 0.8)):
        m = spark.createDataFrame(
            [(auc, 0.5, 0.6)], "auc_roc double, f1_score double, average_precision double")
        quality.log_run(spark, path, name, m, {"depth": 6, "skip": [1], "on": True}, 43)
    runs = quality.read_runs(spark, path)
    (best,) = quality.best_run(runs).collect()
    assert (best.run_id, best.auc_roc, best.n_features) == ("a", 0.8, 43)
    assert best.params == {"depth": "6", "on": "True"}
    assert quality.best_run(runs.where("false")).collect() == []


def test_data_checks(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", None), ("B", 9.0)], "k string, x double")
    rates = {r.column_name: (r.rows, r.nulls) for r in quality.null_rates(df, ["k", "x"]).collect()}
    assert rates == {"k": (3, 0), "x": (3, 1)}
    broken = quality.rule_violations(df, {"small": F.col("x") < 5}).collect()
    assert [tuple(r) for r in broken] == [("small", 1)]
    expected = spark.createDataFrame([("A",), ("C",)], "k string")
    assert [r.k for r in quality.missing_keys(expected, df, "k").collect()] == ["C"]
    assert quality.missing_columns(df, ["k", "z"]) == ["z"]
