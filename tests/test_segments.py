"""The segment job: its files, the saved model, and assignments that SQL finds to be the nearest centres."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marlstone.operators import corpus, explore, metrics, models, split
from marlstone.plans import segments

COLUMNS = ("id", "colour", "cluster", "risk_score")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    data = [(i, rng.choice(["red", "blue", None]), rng.random() + 6 * (i % 3), float(rng.randrange(24))) for i in range(240)]
    return spark.createDataFrame(data, "id long, colour string, risk_score double, hour double").repartition(3, "id").persist()


def test_segment_job(spark, rows, tmp_path):
    tried = segments.train(rows, str(tmp_path), ["colour"], ["risk_score", "hour"], (2, 3, 4), COLUMNS)
    assert sorted(tried) == [2, 3, 4]
    record = spark.read.json(f"{tmp_path}/metrics").first().asDict(recursive=True)
    assert record["features"] == {"categorical": ["colour"], "numeric": ["risk_score", "hour"]}
    assert {x["k"]: x["silhouette"] for x in record["sweep"]} == tried
    assert tried[record["best_k"]] == max(tried.values())
    written = spark.read.option("header", True).csv(f"{tmp_path}/assignments")
    assert written.columns == list(COLUMNS)
    saved = {int(r["id"]): int(r["cluster"]) for r in written.collect()}
    again = {r["id"]: r["cluster"] for r in segments.assign(spark, rows, str(tmp_path), COLUMNS).collect()}
    assert again == saved and len(saved) == 240
    sizes = spark.read.option("header", True).csv(f"{tmp_path}/profiles").select(F.col("size").cast("int")).collect()
    assert sum(r["size"] for r in sizes) == 240


def test_assignments_are_the_nearest_centres_and_give_the_cost(spark, rows, tmp_path):
    from pyspark.ml import Pipeline

    data = Pipeline(stages=models.feature_stages(["colour"], ["risk_score", "hour"], scale=True)).fit(rows).transform(rows)
    sweep, fitted = models.sweep_clusters(data, (3, 5))
    for k, cost in ((r["k"], r["wssse"]) for r in sweep.collect()):
        folder = f"{tmp_path}/{k}"
        given = models.assignments(fitted[k], data.withColumn("v", vector_to_array("features")), ("id", "cluster", "v"))
        given.write.parquet(folder)
        centres = [(c, [float(x) for x in v]) for c, v in enumerate(fitted[k].clusterCenters())]
        spark.createDataFrame(centres, "c int, v array<double>").write.parquet(f"{folder}-centres")
        near = duckdb.sql(
            f"WITH d AS (SELECT p.id, p.cluster, q.c, list_distance(p.v, q.v) ** 2 AS d FROM '{folder}/*.parquet' p, '{folder}-centres/*.parquet' q) "
            "SELECT count(*), count(*) FILTER (mine <= least + 1e-9), sum(mine) FROM "
            "(SELECT id, min(d) AS least, min(d) FILTER (c = cluster) AS mine FROM d GROUP BY id)").fetchall()[0]
        assert near[:2] == (240, 240) and near[2] == pytest.approx(cost, abs=0.01)


def test_binary_metrics_of_odd_tables(spark):
    shape = "y int, p double"
    none = metrics.binary_metrics(spark.createDataFrame([], shape)).first()
    assert (none["tp"], none["f1"], none["roc_auc"], none["brier_score"]) == (0, 0.0, None, None)
    odd = metrics.binary_metrics(spark.createDataFrame([(1, 0.9), (1, 0.9), (0, 0.9), (0, 0.1), (None, 0.4), (1, None)], shape)).first()
    assert (odd["tp"], odd["fp"], odd["tn"], odd["fn"]) == (2, 1, 1, 0)
    assert odd["brier_score"] == pytest.approx((0.01 * 2 + 0.81 + 0.01) / 4)


def test_confusion_square_is_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(f"a{i}", f"a{i}") for i in range(5)], "label string, prediction string")
    assert metrics.confusion_square(df).count() == 25
    monkeypatch.setattr(metrics, "SQUARE_LABELS", 4)
    with pytest.raises(Exception, match="more than 4 labels"):
        metrics.confusion_square(df).collect()


def test_labels_and_weights(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",), (None,)], "kind string")
    assert [(r["kind"], r["index"]) for r in split.label_index(df, "kind").orderBy("index").collect()] == [("b", 0.0), ("a", 1.0), ("c", 2.0)]
    weights = {r["kind"]: (r["inverse_weight"], r["balanced_weight"]) for r in split.class_weights(df, "kind").collect()}
    assert weights["b"] == (1.0, 5 / 8) and weights["a"] == (2.0, 5 / 4)


def test_merge_reads_the_new_side_once(spark):
    shape = "publication_url string, seq long, title string, organisations array<string>"
    old = spark.createDataFrame([("u", 1, "old", ["x"]), ("v", 2, "kept", None)], shape)
    new = spark.createDataFrame([("u", 1, "first", ["z", "y"]), ("u", 2, None, ["y"]), ("w", 3, "w", []), ("t", 4, "t", None)], shape)
    merged = corpus.merge(old, new)
    got = {r["publication_url"]: (r["title"], r["organisations"]) for r in merged.collect()}
    assert got == {"u": ("first", ["x", "y", "z"]), "v": ("kept", None), "w": ("w", []), "t": ("t", [])}
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2


def test_default_breaks_of_a_column_without_values(spark):
    row = explore.histogram_breaks(spark.createDataFrame([(None,)], "v double"), "v").collect()
    assert [(r["bin_low"], r["bin_high"], r["count"]) for r in row] == [(0.0, 1.0, 0)]
