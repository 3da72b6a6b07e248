import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from marlstone.functions import numerics
from marlstone.operators import explore, inference, models, stats, textclass


def sample(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 6)) * [1, 2, 3, 1, 2, 1] + 5
    y = x @ np.array([1.0, -2, 0.5, 0, 3, 1]) + 4 + rng.normal(size=n)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id bigint, x1 double, x2 double, x3 double, x4 double, x5 double, x6 double, y double"), x, y


def test_least_squares_matches_numpy(spark):
    df, x, y = sample(spark)
    design = np.column_stack([np.ones(len(x)), x, x[:, 0] * x[:, 1], x[:, 2] * x[:, 3], x[:, 1] * x[:, 5]])
    want, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
    f = stats.fit(df, "m5")
    assert np.allclose(f.coefficients, want, rtol=1e-6) and math.isclose(f.rss, float(rss[0]), rel_tol=1e-9)
    assert np.allclose(f.inverse, np.linalg.inv(design.T @ design), rtol=1e-5) and np.allclose(f.gram, design.T @ design, rtol=1e-6)
    hat = design @ np.linalg.inv(design.T @ design) @ design.T
    rows = stats.cooks_distance(df, f).orderBy("row_id").collect()
    e = y - design @ want
    h = np.diag(hat)
    assert np.allclose([r["leverage"] for r in rows], h)
    assert np.allclose([r["cooks_d"] for r in rows], e**2 * h / (10 * f.sigma2 * (1 - h) ** 2))
    inside = stats.prediction_interval(df, f).filter("y between lower and upper").count() / len(y)
    assert 0.92 < inside < 0.99


def test_draw_distance_is_the_residual_sum(spark):
    df, x, y = sample(spark)
    f = stats.fit(df, "m5")
    design = np.column_stack([np.ones(len(x)), x, x[:, 0] * x[:, 1], x[:, 2] * x[:, 3], x[:, 1] * x[:, 5]])
    top = stats.largest_coefficients(f)
    for r in stats.prior_draws(spark, f, top, stats.relative_widths(f, top), 5).collect():
        theta = f.coefficients.copy()
        theta[top] = [r["theta_1"], r["theta_2"]]
        assert math.isclose(r["distance"], float(((y - design @ theta) ** 2).sum()), rel_tol=1e-7)
    accepted, limit = stats.rejection_sample(spark, f, 2000, 1000)
    rate = accepted.count() / 2000
    assert 0.005 < rate < 0.05 and accepted.filter(F.col("distance") > limit).count() == 0


def test_distributions():
    assert math.isclose(numerics.chi2_upper_tail(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(numerics.chi2_upper_tail(18.307038053275146, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(numerics.t_two_sided(2.2281388519649385, 10), 0.05, rel_tol=1e-6)
    assert math.isclose(numerics.t_quantile(0.95, 10), 2.2281388519649385, rel_tol=1e-6)
    assert math.isclose(numerics.t_quantile(0.95, 60000), 1.96, rel_tol=1e-4)


def test_series(spark):
    df, _, y = sample(spark)
    m = y - y.mean()
    got = {r["lag"]: r["acf"] for r in stats.autocorrelation(df, "row_id", "y", 5, block=64).collect()}
    assert all(math.isclose(got[k], float((m[k:] * m[: len(m) - k]).sum() / (m * m).sum()), rel_tol=1e-9) for k in range(6))
    points = stats.qq_points(df, "y").orderBy("i").collect()
    assert all(abs(r["theoretical"] - NormalDist().inv_cdf((r["i"] - 0.5) / len(y))) < 1e-7 for r in points)
    mass = explore.density(df, "y", 256).agg((F.sum("density") * (F.max("x") - F.min("x")) / 255).alias("m")).first()["m"]
    assert abs(mass - 1) < 0.01


def test_pretty_breaks():
    assert explore.pretty_breaks(0.3, 9.7, 100)[0] <= 0.3 and explore.pretty_breaks(0.3, 9.7, 100)[-1] >= 9.7
    assert explore.pretty_breaks(0, 100, 100) == [float(v) for v in range(0, 101, 10)] or len(explore.pretty_breaks(0, 100, 100)) > 3


def test_logit_and_measures(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=600)
    y = (rng.random(600) < 1 / (1 + np.exp(-(0.5 + 1.5 * x)))).astype(float)
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y)], "x double, y double, weight double")
    )
    model = models.logistic(df, c=1e6)
    b = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(b[0] + b[1] * x)))
        design = np.column_stack([np.ones(600), x])
        b += np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]), design.T @ (y - p))
    assert abs(model.coefficients[0] - b[1]) < 1e-3 and abs(model.intercept - b[0]) < 1e-3
    ll = float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    row = inference.log_likelihoods(models.scored(model, df)).first()
    assert abs(row["log_likelihood"] - ll) < 1e-3
    measures = inference.fit_measures(ll, row["null_log_likelihood"], 600, 1)
    assert measures[2] > 0 and 0 < measures[4] < 1 and measures[5] < measures[6] < 1


def test_text_weights_are_unit_length(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(40)
    norms = textclass.weighted_terms(docs, "doc_id", "text").groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s"))
    assert norms.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0
