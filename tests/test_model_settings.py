"""The model entries fit with the operators' own settings."""

from __future__ import annotations

import pytest

from slipstream import fixed_values as fv
from slipstream.operators import classifier
from slipstream.registry import model_queries
from slipstream.registry.base import BUILDERS


class Stop(Exception):
    pass


@pytest.mark.parametrize("name", ["m3_m4_m6_train_and_score", "m5_cross_validation", "m8_feature_importance"])
def test_model_entries_use_defaults(spark, small, monkeypatch, name):
    used = {}

    class Recorder:
        def __init__(self, **settings):
            used.update(settings)

        def fit(self, rows):
            raise Stop

    rows = spark.createDataFrame([(1, "train", 1, 0.5), (2, "validation", 0, 0.1)], f"event_id long, part string, {classifier.LABEL} int, x double")
    monkeypatch.setattr(model_queries, "_training", lambda s, d: (rows, ["x"]))
    monkeypatch.setattr(classifier, "GBTClassifier", Recorder)
    monkeypatch.setattr(classifier, "BinaryClassificationEvaluator", lambda **_: None)
    with pytest.raises(Stop):
        BUILDERS[name](spark, small)
    assert (used["maxIter"], used["maxDepth"], used["stepSize"]) == (fv.TREES, fv.TREE_DEPTH, fv.LEARNING_RATE)
    assert used["validationIndicatorCol"] == classifier.HELD and used["validationTol"] == classifier.EARLY_STOP


def test_cross_validation_stops_early_and_learns(spark, small):
    folds = BUILDERS["m5_cross_validation"](spark, small).collect()
    assert [r.fold for r in folds] == list(range(5)) and all(1 <= r.trees <= fv.TREES for r in folds)
    assert sum(r.auc for r in folds) / 5 > 0.6
