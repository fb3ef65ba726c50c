"""Exact evaluation of scores, and the heuristic score.

Rows are added up per distinct score first; everything after that works on one row per score. The
cumulative counts along the scores come from range-partitioned pieces, not from one global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import clamp, first_match, flag, ratio
from slipstream.operators.ordered import TASK_ROWS, running_totals
from slipstream.operators.staging import stage


def score_steps(
    scored: DataFrame, label: str = "label", score: str = "score", task_rows: int = TASK_ROWS
) -> DataFrame:
    """One row per distinct score, highest first: its counts and the counts at or above it.

    Columns: score, pos, neg, tp, fp, n_pos, n_neg.
    """
    known = F.col(label).isNotNull() & F.col(score).isNotNull()
    per_score = (
        scored.where(known)
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    # Counted, sampled for the ranges and shuffled: written once instead of made three times.
    steps = running_totals(
        stage(per_score), [], [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}, task_rows
    )
    return steps.withColumns({
        "n_pos": steps.select(F.sum("pos")).scalar(), "n_neg": steps.select(F.sum("neg")).scalar(),
    })


def roc_points(steps: DataFrame) -> DataFrame:
    """ROC curve: threshold, fpr, tpr; the starting point (0, 0) has no threshold."""
    points = steps.select(
        F.col("score").alias("threshold"),
        ratio("fp", "n_neg").alias("fpr"), ratio("tp", "n_pos").alias("tpr"),
    )
    return points.unionByName(_anchor(steps, fpr=0.0, tpr=0.0))


def pr_points(steps: DataFrame) -> DataFrame:
    """Precision-recall curve; the end point (precision 1, recall 0) has no threshold."""
    points = steps.select(
        F.col("score").alias("threshold"),
        ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
        ratio("tp", "n_pos").alias("recall"),
    )
    return points.unionByName(_anchor(steps, precision=1.0, recall=0.0))


def _anchor(steps: DataFrame, **values: float) -> DataFrame:
    return steps.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        *[F.lit(v).alias(k) for k, v in values.items()],
    )


def ranking_metrics(steps: DataFrame) -> DataFrame:
    """AUC (trapezoids, so ties count half) and average precision; null for a single class."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    step_sum = F.sum(F.col("pos") * ratio("tp", F.col("tp") + F.col("fp")))
    positives, negatives = F.sum("pos"), F.sum("neg")
    return steps.agg(
        ratio(area, positives.cast("double") * negatives).alias("auc_roc"),
        ratio(step_sum, positives).alias("average_precision"),
        F.coalesce(positives, F.lit(0)).alias("positives"),
        F.coalesce(negatives, F.lit(0)).alias("negatives"),
    )


def with_prediction(
    scored: DataFrame, score: str = "score", threshold: float = fv.DECISION_THRESHOLD
) -> DataFrame:
    return scored.withColumn("prediction", flag(F.col(score) >= threshold))


def confusion(predicted: DataFrame, label: str = "label") -> DataFrame:
    """Counts per (actual, predicted) with the name of the outcome."""
    actual, guess = F.col("actual"), F.col("predicted")
    outcome = first_match(
        [
            ((actual == 0) & (guess == 1), "False Positive"),
            ((actual == 1) & (guess == 0), "False Negative"),
            ((actual == 1) & (guess == 1), "True Positive"),
        ],
        "True Negative",
    )
    return (
        predicted.groupBy(F.col(label).alias("actual"), F.col("prediction").alias("predicted"))
        .agg(F.count("*").alias("n"))
        .withColumn("error_type", outcome)
    )


def class_report(predicted: DataFrame, label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows."""
    actual, guess = F.col(label), F.col("prediction")
    counts = predicted.agg(
        F.count_if((actual == 1) & (guess == 1)).alias("tp"),
        F.count_if((actual == 0) & (guess == 1)).alias("fp"),
        F.count_if((actual == 1) & (guess == 0)).alias("fn"),
        F.count_if((actual == 0) & (guess == 0)).alias("tn"),
    )

    def row(name: str, hit: Column, wrongly: Column, missed: Column) -> Column:
        # No prediction or no member of a class counts as 0, not as missing.
        precision = F.coalesce(ratio(hit, hit + wrongly), F.lit(0.0))
        recall = F.coalesce(ratio(hit, hit + missed), F.lit(0.0))
        f1 = F.coalesce(ratio(hit * 2, hit * 2 + wrongly + missed), F.lit(0.0))
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1_score"), (hit + missed).alias("support"),
        )

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    both = counts.select(
        row("0", tn, fn, fp).alias("c0"), row("1", tp, fp, fn).alias("c1"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )
    total = F.col("c0.support") + F.col("c1.support")

    def mean(field: str, weighted: bool) -> Column:
        a, b = F.col(f"c0.{field}"), F.col(f"c1.{field}")
        if not weighted:
            return (a + b) / F.lit(2.0)
        return ratio(a * F.col("c0.support") + b * F.col("c1.support"), total)

    def average(name: str, weighted: bool) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[mean(f, weighted).alias(f) for f in ("precision", "recall", "f1_score")],
            total.alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        *[F.col("accuracy").alias(f) for f in ("precision", "recall", "f1_score")],
        total.alias("support"),
    )
    rows = F.array(
        F.col("c0"), F.col("c1"), accuracy, average("macro avg", False),
        average("weighted avg", True),
    )
    return both.select(F.inline(rows))


def evaluation(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    threshold: float = fv.DECISION_THRESHOLD,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """One row: AUC, average precision, F1 and the four confusion counts."""
    ranking = ranking_metrics(score_steps(scored, label, score, task_rows))
    late, guess = F.col(label) == 1, F.col(score) >= threshold
    cells = scored.agg(
        F.count_if(~late & ~guess).alias("true_negatives"),
        F.count_if(~late & guess).alias("false_positives"),
        F.count_if(late & ~guess).alias("false_negatives"),
        F.count_if(late & guess).alias("true_positives"),
    )
    hits = F.col("true_positives") * 2
    f1 = ratio(hits, hits + F.col("false_positives") + F.col("false_negatives"))
    return cells.select(
        ranking.select("auc_roc").scalar().alias("auc_roc"),
        ranking.select("average_precision").scalar().alias("average_precision"),
        F.coalesce(f1, F.lit(0.0)).alias("f1_score"),
        "true_negatives", "false_positives", "false_negatives", "true_positives",
    )


def quality_gates(
    metrics: DataFrame, storm_probability: Column, clear_probability: Column,
    min_auc: float = fv.MIN_AUC, min_f1: float = fv.MIN_F1,
) -> DataFrame:
    """Release gates as booleans over an ``evaluation`` row and two scored reference flights."""
    gated = metrics.select(
        "auc_roc", "f1_score",
        (F.col("auc_roc") >= min_auc).alias("auc_ok"), (F.col("f1_score") >= min_f1).alias("f1_ok"),
        (storm_probability > clear_probability).alias("storm_ok"),
    )
    passed = [F.coalesce(F.col(c), F.lit(False)) for c in ("auc_ok", "f1_ok", "storm_ok")]
    return gated.withColumn("release", passed[0] & passed[1] & passed[2])


def risk_band(probability: str = "delay_probability") -> Column:
    p = F.col(probability)
    return first_match([(p < fv.RISK_LOW, "Low"), (p < fv.RISK_HIGH, "Medium")], "High")


def heuristic_score(
    base_otp: Column, severity: Column, thunderstorm: Column, hour: Column, weekday: Column,
    previous_delay: Column,
) -> Column:
    """Delay probability without a model, limited to 0.05..0.95."""
    points = (
        F.lit(1.0) - base_otp
        + severity * F.lit(0.025)
        + thunderstorm * F.lit(0.12)
        + flag(hour >= 16) * F.lit(0.06)
        + flag(weekday >= 4) * F.lit(0.04)
        + previous_delay * F.lit(0.002)
    )
    return clamp(points, 0.05, 0.95)
