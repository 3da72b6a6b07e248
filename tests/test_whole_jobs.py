"""Registered queries run the whole job, and their tables have the properties that whole jobs have."""

from __future__ import annotations

import inspect
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors

from checks import family_models
from marlstone.operators import features, models, textclass


def test_vectors_drop_no_term(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(30)], "doc_id long, text string")
    _, front = textclass.vector_stages(docs, "text", [], 64)
    counted = Pipeline(stages=front[:-1]).fit(docs).transform(docs)
    assert [sum(r["_counts"].toArray()) for r in counted.collect()] == [39.0] * 30


def test_classifiers_are_compared_at_full_settings(spark, folder, monkeypatch):
    seen = {}
    monkeypatch.setattr(textclass, "compare_classifiers", lambda docs, **settings: seen.update(settings))
    family_models.QUERIES["m34_classifier_comparison"](spark, folder)
    assert seen == {}


def test_classifier_comparison(spark):
    data = [(i, f"{'cat' if i % 2 else 'dog'} word{i % 7} thing{i % 5}", "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, label string")
    rows = {r["name"]: r for r in textclass.compare_classifiers(docs, vocabulary=1 << 12, trees=20, iterations=20).collect()}
    assert list(rows) == ["MultinomialNB", "LogisticRegression", "RandomForest", "SVC"]
    assert all(0 <= r[c] <= 1 for r in rows.values() for c in ("accuracy", "precision", "recall", "f1"))
    assert rows["MultinomialNB"]["accuracy"] == rows["LogisticRegression"]["accuracy"] == rows["SVC"]["accuracy"] == 1.0


def test_model_queries_run_at_full_settings(spark, folder, monkeypatch):
    seen = {}
    monkeypatch.setattr(family_models, "_bundle", lambda s, d, name: name)
    monkeypatch.setattr(models, "best_elimination", lambda table: None)
    monkeypatch.setattr(models, "elimination_table", lambda bundles, *a, **k: seen.update(m24=(bundles, a, k)))
    monkeypatch.setattr(models, "grid_search", lambda bundle, key, *a, **k: seen.update(m25=(bundle, a, k)))
    for name in ("m24_elimination", "m25_grid_search"):
        family_models.QUERIES[name](spark, folder)
    assert seen == {"m24": (list(features.bundles()), (), {}), "m25": ("leakage_aware_lr", (), {})}


def test_eliminations_share_rounds(monkeypatch):
    weights, fits = [(7 * i) % 23 - 11.5 for i in range(23)], []
    monkeypatch.setattr(models, "_sliced", lambda df, slots: slots)
    bundle = SimpleNamespace(names=[str(i) for i in range(23)], part=lambda name: None)
    monkeypatch.setattr(models, "logistic", lambda slots, features_col: fits.append(slots) or SimpleNamespace(
        coefficients=SimpleNamespace(toArray=lambda: [weights[i] for i in slots])))
    got = models.eliminations(bundle, [23, 22, 19, 10, 5, 3])
    order = sorted(range(23), key=lambda i: (weights[i] ** 2, i))
    assert got == {n: sorted(order[23 - n:]) for n in (23, 22, 19, 10, 5, 3)} and len(fits) == 5
    assert models.eliminate(bundle, 10) == got[10]


@pytest.fixture(scope="module")
def bundle(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(160, 4))
    y = (x[:, 0] + 0.3 * rng.normal(size=160) > 0).astype(float)
    parts = ["train", "train", "train", "validation"] * 40
    rows = [(i, parts[i], float(y[i]), Vectors.dense(x[i]), 1.0) for i in range(160)]
    data = spark.createDataFrame(rows, ["vid", "data_split", "y", "features", "weight"]).repartition(2).persist()
    return models.Bundle("small", list("abcd"), [], data, None, list("abcd"))


def test_elimination_table(bundle):
    rows = models.elimination_table([bundle], (1, 2, 9)).collect()
    assert [r["selected_transformed_features"] for r in rows] == [1, 2, 4]
    assert all(r["bundle"] == "small" and r["total_transformed_features"] == 4 and r["f1"] > 0.8 for r in rows)
    assert models.best_elimination(models.elimination_table([bundle], (1,))).count() == 1


def test_grid_search(bundle):
    rows = models.grid_search(bundle, "vid", (0.5,), ("l1", "l2"), (None,), folds=2).collect()
    assert {(r["penalty"], r["C"], r["class_weight"]) for r in rows} == {("l1", 0.5, "None"), ("l2", 0.5, "None")}
    assert all(r["cv_mean_f1"] > 0.8 and r["cv_mean_roc_auc"] > 0.9 and r["cv_std_f1"] >= 0 for r in rows)


def test_forests_and_boosting_run_at_full_settings(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "tune_forest", lambda data, pipeline, *a, **k: seen.append((a, k)) or (None, None))
    monkeypatch.setattr(models, "severity_pipeline", lambda c, n, **k: seen.append(k))
    family_models._tuned(spark, folder)
    assert seen == [{}, ((), {})]
    boosted = models.risk_pipeline(*family_models.RISK).getStages()[-1]
    seen.clear()
    monkeypatch.setattr(models, "risk_pipeline", lambda c, n, **k: seen.append(k) or (_ for _ in ()).throw(KeyError))
    with pytest.raises(KeyError):
        family_models._boosted(spark, folder)
    assert seen == [{}] and (boosted.getMaxIter(), boosted.getMaxDepth()) == (100, 8)


def test_default_grid_of_forests_is_the_full_one():
    defaults = {k: v.default for k, v in inspect.signature(models.tune_forest).parameters.items()}
    assert (defaults["trees"], defaults["depths"], defaults["folds"]) == ((50, 100, 200), (5, 10, 15), 5)
