from __future__ import annotations

import random
import threading

import pytest
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.operators import classifier

QUICK = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}
USED = ["hour_of_day", "thunderstorm_flag", "is_summer", "route_distance"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(500):
        hour, storm, summer = rng.randrange(5, 23), rng.randrange(2), rng.randrange(2)
        p = 0.05 + 0.02 * (hour - 5) + 0.3 * storm + 0.1 * summer
        data.append((
            i, hour, storm, summer, rng.randrange(100, 2500) if i % 9 else None,
            None if i == 0 else int(rng.random() < p), int(i == 1),
        ))
    return spark.createDataFrame(
        data, "id long, hour_of_day int, thunderstorm_flag int, is_summer int, "
              "route_distance int, ArrDel15 int, Cancelled int")


@pytest.fixture(scope="module")
def fitted(rows):
    table, names = classifier.prepare_training(rows, keep=["id"])
    table = classifier.split_rows(table, ["id"]).cache()
    model = classifier.train(
        table.where("part = 'train'"), names, table.where("part = 'validation'"), **QUICK)
    return model, table


def test_training_rows(rows):
    table, names = classifier.prepare_training(rows, keep=["id"])
    assert names == [f for f in fv.FEATURES if f in USED]
    # Without the flight of unknown outcome and the cancelled one; nulls are 0.
    assert table.count() == 498
    assert table.where(F.col("route_distance").isNull()).count() == 0
    assert dict(table.dtypes)["hour_of_day"] == "double"


def test_split_is_stable(fitted):
    _, table = fitted
    parts = {r.id: r.part for r in table.collect()}
    again = classifier.split_rows(table.drop("part").repartition(7), ["id"]).collect()
    assert {r.id: r.part for r in again} == parts
    shares = [list(parts.values()).count(p) / len(parts) for p in ("train", "validation", "test")]
    assert shares == pytest.approx([0.7, 0.1, 0.2], abs=0.06)


def test_scores(fitted):
    model, table = fitted
    scored = model.score(table).collect()
    for r in scored:
        assert 0 <= r.delay_probability <= 1
        assert r.prediction == int(r.delay_probability >= 0.5)
        assert r.risk_level == ("Low" if r.delay_probability < 0.3 else
                                "Medium" if r.delay_probability < 0.55 else "High")
    storm = [r.delay_probability for r in scored if r.thunderstorm_flag == 1]
    clear = [r.delay_probability for r in scored if r.thunderstorm_flag == 0]
    assert sum(storm) / len(storm) > sum(clear) / len(clear)


def test_missing_feature_counts_as_zero(fitted):
    model, table = fitted
    one = table.limit(20).cache()
    absent = {r.id: r.delay_probability for r in model.score(one.drop("route_distance")).collect()}
    zero = {r.id: r.delay_probability
            for r in model.score(one.withColumn("route_distance", F.lit(0.0))).collect()}
    assert absent == pytest.approx(zero)


def test_save_and_load(fitted, tmp_path):
    model, table = fitted
    path = str(tmp_path / "model")
    model.save(path)
    again = classifier.Classifier.load(path)
    want = {r.id: r.delay_probability for r in model.score(table).collect()}
    assert {r.id: r.delay_probability for r in again.score(table).collect()} == pytest.approx(want)


def test_importance(fitted):
    got = fitted[0].importance().collect()
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)
    assert sum(r.importance for r in got) == pytest.approx(1)


def test_without_calibration(fitted):
    _, table = fitted
    model = classifier.train(table.where("part = 'train'"), USED, calibrate=False, **QUICK)
    assert model.calibration is None
    assert model.score(table.limit(5)).where("delay_probability between 0 and 1").count() == 5


def test_cross_validation(rows):
    table, names = classifier.prepare_training(rows, keep=["id"])
    folds = classifier.cross_validate(table, names, ["id"], folds=3, maxIter=4, maxDepth=3).collect()
    assert [r.fold for r in folds] == [0, 1, 2] and sum(r.n for r in folds) == 498
    assert all(1 <= r.trees <= 4 for r in folds)
    assert 0.5 < sum(r.auc for r in folds) / 3 < 1


def test_folds_are_fitted_side_by_side(rows, monkeypatch):
    # Each fit waits until all three have begun.
    begun = threading.Barrier(3, timeout=60)
    learner = classifier.tree_learner

    def meeting(features, early_stop=False, **overrides):
        begun.wait()
        return learner(features, early_stop, **overrides)

    table, names = classifier.prepare_training(rows, keep=["id"])
    settings = {"folds": 3, "maxIter": 3, "maxDepth": 3}
    monkeypatch.setattr(classifier, "FOLD_ROWS", 1)
    want = [tuple(r) for r in classifier.cross_validate(table, names, ["id"], **settings).collect()]
    monkeypatch.undo()
    monkeypatch.setattr(classifier, "tree_learner", meeting)
    got = [tuple(r) for r in classifier.cross_validate(table, names, ["id"], **settings).collect()]
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_trees_keep_no_table_of_places(rows):
    table, names = classifier.prepare_training(rows, keep=["id"])
    vectors = classifier._vectors(table, names).cache()
    learner = classifier.tree_learner(names, maxIter=3, maxDepth=4)
    assert not learner.getCacheNodeIds()
    with_places = learner.copy({learner.cacheNodeIds: True})
    lines = [m.toDebugString.split("\n")[1:] for m in (learner.fit(vectors), with_places.fit(vectors))]
    assert lines[0] == lines[1] and len(lines[0]) > 10


def _classes(spark, parts=3):
    # One class holds most rows, one has a single row, one is null.
    rows = [(i, 0 if i % 10 else 1) for i in range(500)] + [(900, 2), *[(i, None) for i in range(1000, 1013)]]
    return spark.createDataFrame(rows, "id long, label int").repartition(parts)


@pytest.mark.parametrize("task_rows", [20, 10_000])
def test_strata_have_exact_shares(spark, task_rows):
    found, folds = [], []
    for parts in (1, 4, 17):
        frame = _classes(spark, parts)
        found.append({r.id: (r.label, r.part) for r in classifier.stratified_split(frame, ["id"], task_rows=task_rows).collect()})
        folds.append({r.id: (r.label, r.fold) for r in classifier.stratified_folds(frame, ["id"], 4, task_rows=task_rows).collect()})
    assert found[0] == found[1] == found[2] and folds[0] == folds[1] == folds[2]
    assert len(found[0]) == len(folds[0]) == 514
    for label, n in ((0, 450), (1, 50), (2, 1), (None, 13)):
        of = [part for got, part in found[0].values() if got == label]
        assert len(of) == n
        assert (of.count("test"), of.count("validation")) == (int(n * 0.2 + 0.5), int(n * 0.1 + 0.5))
        sizes = [list(folds[0].values()).count((label, k)) for k in range(4)]
        assert max(sizes) - min(sizes) <= 1
    totals = [sum(k == fold for _, fold in folds[0].values()) for k in range(4)]
    assert max(totals) - min(totals) <= 1
