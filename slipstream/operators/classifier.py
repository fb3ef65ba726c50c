"""Delay classifier on Spark ML: split, boosted trees, calibration, scoring, importance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import literal_table
from slipstream.operators.ordered import TASK_ROWS, attach, running_totals
from slipstream.operators.scoring import risk_band
from slipstream.operators.staging import ensure_checkpoints

LABEL = "label"
# Trees are added, up to the configured number, while a tree lowers the error on held-out rows by more
# than this share.
EARLY_STOP = 0.0001
HELD = "held"
# Folds are fitted side by side as long as the rows they keep in memory together stay below this number.
FOLD_ROWS = 20_000_000


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the trained columns as doubles; absent columns and missing values are 0."""
    def column(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0.0).alias(name)
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name)

    return df.select(*keep, *[column(f) for f in features])


def prepare_training(
    df: DataFrame, target: str = "ArrDel15", keep: Sequence[str] = (),
    features: Sequence[str] = fv.FEATURES,
) -> tuple[DataFrame, list[str]]:
    """Operated flights with a known target: label, kept columns, and the features that exist."""
    available = [f for f in features if f in df.columns]
    rows = df.where(F.col(target).isNotNull())
    if "Cancelled" in df.columns:
        rows = rows.where(F.col("Cancelled") == 0)
    rows = rows.withColumn(LABEL, F.col(target).cast("int"))
    return align_features(rows, available, [*keep, LABEL]), available


def hash_band(seed: int, buckets: int, *keys: str) -> Column:
    """Bucket 0..buckets-1 from a row's key: the same in every run, and no shuffle."""
    first = F.conv(F.substring(_mixed(seed, keys), 1, 8), 16, 10).cast("long")
    return (first % F.lit(buckets)).cast("int")


def _mixed(seed: int, keys: Sequence[str]) -> Column:
    """Hash of a row's key as text, the same on other engines."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def split_rows(
    df: DataFrame, keys: Sequence[str], validation: float = 0.10, test: float = 0.20, seed: int = 42
) -> DataFrame:
    """Add ``part``: train, validation or test. Class shares agree in expectation."""
    band = hash_band(seed, 10_000, *keys)
    return df.withColumn(
        "part",
        F.when(band < int(test * 10_000), "test")
        .when(band < int((test + validation) * 10_000), "validation")
        .otherwise("train"),
    )


def _ranked(
    df: DataFrame, keys: Sequence[str], label: str, seed: int, task_rows: int
) -> DataFrame:
    """Rank of each row within its class, in hash order of its key, and the class's size and offset."""
    # One row per class.
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    places = running_totals(
        df.withColumn("_mixed", _mixed(seed, keys)), [label], [F.col("_mixed"), *[F.col(k) for k in keys]],
        {"_place": F.lit(1)}, task_rows,
    )
    return attach(places, sizes, [label])


def stratified_split(
    df: DataFrame, keys: Sequence[str], label: str = LABEL, validation: float = 0.10,
    test: float = 0.20, seed: int = 42, task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``part``: of every class exactly the given shares, rounded to whole rows.

    ``keys`` identify a row; the part follows from their hash and the class alone, whatever the
    partitioning. Rows are ranked within their class; classes above ``task_rows`` are ranked in
    pieces. ``df`` is read three times: stage it first if it is costly. A null label is a class.
    """
    ranked = _ranked(df, keys, label, seed, task_rows)

    def quota(share: float) -> Column:
        return F.floor(F.col("_size") * F.lit(float(share)) + F.lit(0.5))

    return ranked.withColumn(
        "part",
        F.when(F.col("_place") <= quota(test), "test")
        .when(F.col("_place") <= quota(test) + quota(validation), "validation")
        .otherwise("train"),
    ).select(*df.columns, "part")


def stratified_folds(
    df: DataFrame, keys: Sequence[str], folds: int = 5, label: str = LABEL, seed: int = 42,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``fold``: fold sizes, also those of each class, are at most one row apart."""
    ranked = _ranked(df, keys, label, seed, task_rows)
    # Each class goes on where the one before it ended.
    fold = (F.col("_offset") + F.col("_place") - 1) % F.lit(folds)
    return ranked.withColumn("fold", fold.cast("int")).select(*df.columns, "fold")


@dataclass
class Classifier:
    """Fitted trees with the calibration on top."""

    features: list[str]
    trees: GBTClassificationModel
    calibration: LogisticRegressionModel | None = None

    def _stages(self) -> list:
        assembler = VectorAssembler(inputCols=self.features, outputCol="features")
        return [assembler, self.trees]

    def score(self, df: DataFrame) -> DataFrame:
        """Add delay_probability, prediction and risk_level; every other column is kept."""
        aligned = df.withColumns({
            f"_f_{f}": (
                F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in df.columns else F.lit(0.0)
            )
            for f in self.features
        })
        vector = VectorAssembler(inputCols=[f"_f_{f}" for f in self.features], outputCol="features")
        out = self.trees.transform(vector.transform(aligned))
        if self.calibration is None:
            p = vector_to_array("probability")[1]
        else:
            slope = float(self.calibration.coefficients[0])
            z = F.lit(slope) * margin() + F.lit(float(self.calibration.intercept))
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return (
            out.withColumn("_p", p)
            .select(*df.columns, F.col("_p").alias("delay_probability"))
            .withColumns({
                "prediction": (F.col("delay_probability") >= fv.DECISION_THRESHOLD).cast("int"),
                "risk_level": risk_band(),
            })
        )

    def importance(self) -> DataFrame:
        """Feature and importance, most important first."""
        weights = self.trees.featureImportances.toArray()
        rows = [(f, float(w)) for f, w in zip(self.features, weights)]
        table = literal_table(SparkSession.active(), ["feature", "importance"], rows)
        return table.orderBy(F.col("importance").desc(), "feature")

    def save(self, path: str) -> None:
        """Write the fitted stages; ``load`` gives a classifier with equal scores."""
        stages = self._stages() + ([self.calibration] if self.calibration else [])
        PipelineModel(stages).write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> "Classifier":
        stages = PipelineModel.load(path).stages
        return cls(stages[0].getInputCols(), stages[1], stages[2] if len(stages) > 2 else None)


def margin() -> Column:
    return vector_to_array("rawPrediction")[1]


def tree_learner(features: Sequence[str], early_stop: bool = False, **overrides) -> GBTClassifier:
    """Boosted trees; with ``early_stop`` rows whose ``held`` is true only decide when to stop."""
    settings = {
        "maxIter": fv.TREES, "maxDepth": fv.TREE_DEPTH, "stepSize": fv.LEARNING_RATE,
        "subsamplingRate": fv.ROW_SAMPLE, "featureSubsetStrategy": str(fv.FEATURE_SAMPLE),
        "minInstancesPerNode": fv.MIN_LEAF_ROWS, "seed": 42,
    }
    if early_stop:
        settings |= {"validationIndicatorCol": HELD, "validationTol": EARLY_STOP}
    settings.update(overrides)
    return GBTClassifier(
        # Where a row stands in a tree of this depth is found faster than a stored place is kept up: a
        # place costs one more table of all rows in memory per level. The trees are the same.
        featuresCol="features", labelCol=LABEL, weightCol="weight", cacheNodeIds=False,
        checkpointInterval=10, **settings,
    )


def _vectors(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    weight = F.when(F.col(LABEL) == 1, F.lit(fv.POSITIVE_WEIGHT)).otherwise(F.lit(1.0))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler.transform(df).select(
        F.col(LABEL).cast("double").alias(LABEL), "features", weight.alias("weight"), *keep
    )


def train(
    train_rows: DataFrame, features: Sequence[str], validation_rows: DataFrame | None = None,
    calibrate: bool = True, **overrides,
) -> Classifier:
    """Fit the trees; calibrate their margin on the validation rows (else on the training rows).

    With validation rows the trees stop early: the configured number is the upper limit.
    """
    ensure_checkpoints(train_rows.sparkSession)
    rows, early = _vectors(train_rows, features).withColumn(HELD, F.lit(False)), False
    if validation_rows is not None and not validation_rows.isEmpty():
        early = True
        rows = rows.union(_vectors(validation_rows, features).withColumn(HELD, F.lit(True)))
    trees = tree_learner(features, early, **overrides).fit(rows)
    model = Classifier(list(features), trees)
    if calibrate:
        held_out = validation_rows if early else train_rows
        raw = trees.transform(_vectors(held_out, features)).withColumn("_margin", margin())
        margins = VectorAssembler(inputCols=["_margin"], outputCol="margin").transform(raw)
        model.calibration = LogisticRegression(
            featuresCol="margin", labelCol=LABEL, predictionCol="_cal", rawPredictionCol="_cal_raw",
            probabilityCol="_cal_p",
        ).fit(margins.select(LABEL, "margin"))
    return model


def cross_validate(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], folds: int = 5, seed: int = 42,
    **overrides,
) -> DataFrame:
    """(fold, n, trees, auc): what a fold's rows say about trees fitted without them.

    A row's fold follows from its key, and so does whether it is held out, in the other folds, to
    stop the trees early. The AUC is that of the exact curve.
    """
    ensure_checkpoints(df.sparkSession)
    placed = df.withColumns({
        "fold": hash_band(seed, folds, *keys), HELD: hash_band(seed + 1, 10, *keys) == 0,
    })
    vectors = _vectors(placed, features, ["fold", HELD]).persist()
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC", numBins=0)

    def tested_fold(fold: int) -> tuple[int, int, int, float]:
        trees = tree_learner(features, True, **overrides).fit(vectors.where(F.col("fold") != fold))
        tested = trees.transform(vectors.where(F.col("fold") == fold))
        return fold, tested.count(), trees.getNumTrees, float(evaluator.evaluate(tested))

    # A tree is a chain of small jobs, which on small tables leave most cores idle: the folds fill them.
    # The count also makes the kept rows once, before the folds ask for them.
    together = max(1, min(folds, FOLD_ROWS // max(vectors.count(), 1)))
    with ThreadPool(together) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(tested_fold), range(folds), chunksize=1)
    vectors.unpersist()
    return literal_table(df.sparkSession, ["fold", "n", "trees", "auc"], rows)
