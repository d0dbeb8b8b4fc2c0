"""Learning queries fit every model at its preset size, and the search takes every point of every grid."""

from __future__ import annotations

import pytest

from ledgerlark.operators import explain, models
from ledgerlark.plans import QUERIES, operations


class Stop(Exception):
    """Raised in place of the fits."""


def given(monkeypatch, module, function, name, spark, folder):
    """The arguments with which a query calls a function."""
    seen = []

    def record(*args, **options):
        seen.append((args, options))
        raise Stop

    monkeypatch.setattr(module, function, record)
    with pytest.raises(Stop):
        QUERIES[name](spark, folder)
    return seen[0]


def at_preset(estimator, name):
    if name == "boosted_trees":
        return estimator.options == models.PRESETS[name]
    return all(estimator.getOrDefault(p) == v for p, v in models.PRESETS[name].items() if p != "C")


def test_boosting_scores(spark, folder, monkeypatch):
    monkeypatch.setattr(models.BoostedPerClass, "_fit", lambda self, df: (_ for _ in ()).throw(Stop(at_preset(self, "boosted_trees"))))
    with pytest.raises(Stop, match="True"):
        QUERIES["gbt_scores"](spark, folder)


def test_comparison(spark, folder, monkeypatch):
    (builds, *_), _ = given(monkeypatch, models, "validate", "model_comparison", spark, folder)
    assert sorted(builds) == sorted(models.PRESETS) and all(at_preset(e, name) for name, e in builds.items())


def test_search(spark, folder, monkeypatch):
    (_, _, points, folds), _ = given(monkeypatch, models, "search", "param_search", spark, folder)
    assert len(folds) == 3
    assert sorted(map(repr, points)) == sorted(repr({"model": m, **p}) for m, grid in models.GRIDS.items() for p in models.grid_points(grid))


def test_folds(spark, folder, monkeypatch):
    (df, builds, folds), options = given(monkeypatch, models, "fit_folds", "cv_metrics", spark, folder)
    assert sorted(builds) == sorted(models.PRESETS) and len(folds) == 5 and options["expanding"]
    assert all(at_preset(build(df), name) for name, build in builds.items())


def test_imputation_rounds(spark, folder, monkeypatch):
    _, options = given(monkeypatch, models, "iterative_impute", "iterative_impute", spark, folder)
    assert "rounds" not in options


def test_attribution_orders(spark, folder, monkeypatch):
    args, options = given(monkeypatch, explain, "sampled_shapley", "sampled_shapley", spark, folder)
    assert "permutations" not in options
    assert args[3].stages[-1].getOrDefault("maxIter") == models.PRESETS["logistic"]["maxIter"]


def test_stream_model(spark, folder, monkeypatch):
    _, options = given(monkeypatch, operations, "LogisticRegression", "stream_scores", spark, folder)
    assert options["maxIter"] == models.PRESETS["logistic"]["maxIter"]
