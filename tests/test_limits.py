"""Cases beyond former limits: deep links, infinities, extreme magnitudes, large coefficients, id gaps, moving splits."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions import numerics, text
from marlstone.operators import inference, models, scale, split, stats


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


@pytest.mark.parametrize("base, href, want", [
    ("http://h/a/b/c/d/e/f", "../../../../../x", "http://h/x"),
    ("http://h/a/b/c/d/e/f", "./../../../../x", "http://h/a/x"),
    ("http://h/a/b", "../../../../x?q=../y#z", "http://h/x?q=../y#z"),
    ("http://h/a/b/", "c/d/..", "http://h/a/b/c/"),
    ("http://h/a/b/", ".", "http://h/a/b/"),
    ("http://h", "../x", "http://h/x"),
    ("http://h/" + "a/" * 60, "../" * 59 + "x", "http://h/a/x"),
])
def test_links_of_any_depth(spark, base, href, want):
    assert one(spark, text.absolute_url(F.lit(base), F.lit(href))) == want


def test_quantiles_with_infinities_and_all_magnitudes(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([
        10.0 ** rng.uniform(-300, 300, 3000), -(10.0 ** rng.uniform(-300, 300, 3000)), [np.inf] * 40, [-np.inf] * 3,
        np.zeros(50), rng.normal(1e15, 1, 500), [5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308],
    ])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(4)
    probs = [0.0, 0.1, 0.3333, 0.5, 0.77, 0.999, 1.0]
    got = scale.exact_quantiles(df, ["v"], probs, bins=64, settle=20)["v"]
    s = np.sort(values)
    for p, g in zip(probs, got):
        k = p * (len(s) - 1)
        low, high = s[int(k)], s[min(int(k) + 1, len(s) - 1)]
        want = low if low == high or k == int(k) else low + (high - low) * (k - int(k))
        assert g == want or math.isclose(g, want, rel_tol=1e-9) or (math.isnan(g) and math.isnan(want))


def test_student_tail_for_all_sizes():
    # Known values, and the normal tail that large degrees of freedom approach.
    assert math.isclose(numerics.t_two_sided(2.2281388519649385, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(numerics.t_two_sided(12.706204736432095, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(numerics.t_two_sided(0.001, 3), 0.9992649, rel_tol=1e-6)
    for df in (1e4, 1e7, 1e10):
        for t in (0.5, 1.96, 6.0):
            normal = math.erfc(t / math.sqrt(2))
            assert math.isclose(numerics.t_two_sided(t, df), normal, rel_tol=max(1e-6, 400 / df))
    assert numerics.t_two_sided(0.0, 5) == 1 and numerics.t_two_sided(math.inf, 5) == 0


def test_odds_ratios_of_large_coefficients(spark):
    fit = inference.LogitFit("m", ["a", "b", "c"], [800.0, -800.0, 1.0], 0.0, [1.0, 1.0, float("nan"), 1.0], [0.1] * 4, -1.0, -2.0, 10, [])
    rows = {r["feature"]: r for r in inference.odds_ratios(spark, fit).collect()}
    assert rows["a"]["odds_ratio"] == math.inf and rows["a"]["ci_upper_95"] == math.inf
    assert rows["b"]["odds_ratio"] == 0.0 and math.isclose(rows["c"]["odds_ratio"], math.e)


def test_splits_do_not_move(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("label"))
    sides = []
    for rows in (df, df.repartition(13), df.orderBy(F.desc("id"))):
        train, test = split.bernoulli_split(rows, "id", "label")
        ours = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
        assert not ours[0] & ours[1] and len(ours[0] | ours[1]) == 5000
        other = split.random_split(rows, "id", 0.6, 7)
        sides.append((ours, {r["id"] for r in other[0].collect()}))
        assert abs(len(sides[-1][1]) - 3000) < 150
    assert sides[0] == sides[1] == sides[2]


def test_nearest_of_many_centroids(spark):
    points = spark.createDataFrame([(i, [float(i) + 0.2, 0.0]) for i in range(50)], "k long, v array<double>")
    centres = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(12_000)], "label long, v array<double>")
    got = {r["k"]: r["cluster"] for r in models.nearest_centroid(points, centres, "v", "k", "label").collect()}
    assert got == {i: i for i in range(50)}


@pytest.mark.parametrize("block", [3, 1_000_000])
def test_autocorrelation_over_gaps(spark, block):
    rng = np.random.default_rng(1)
    ids = np.array([1, 2, 5, 6, 7, 9, 14, 15, 30, 31])
    e = rng.normal(size=10)
    df = spark.createDataFrame(list(zip(ids.tolist(), e.tolist())), "id long, v double")
    got = {r["lag"]: r["acf"] for r in stats.autocorrelation(df, "id", "v", 8, block).collect()}
    c = e - e.mean()
    by_id = dict(zip(ids.tolist(), c))
    for k in range(9):
        want = sum(c_ * by_id[i - k] for i, c_ in by_id.items() if i - k in by_id) / (c @ c)
        assert math.isclose(got[k], want, abs_tol=1e-12)


def test_empty_band_and_empty_cell_stay(spark):
    from marlstone.operators import metrics

    scored = spark.createDataFrame([(1, 0.1), (0, 0.2), (1, 0.6)], "y int, p double")
    bands = {r["band"]: (r["vehicles"], r["avg_probability"]) for r in metrics.risk_band_summary(scored).collect()}
    assert bands["High"] == (0, None) and bands["Medium"] == (1, 0.6) and bands["Low"][0] == 2
    told = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "b"), ("b", "b")], "label string, prediction string")
    cells = {(r["actual"], r["predicted"]): r["count"] for r in metrics.confusion_square(told).collect()}
    assert cells == {("a", "a"): 1, ("a", "b"): 0, ("b", "a"): 1, ("b", "b"): 2}


def test_rooted_links_take_their_steps(spark):
    from marlstone.functions import text

    one = lambda e: spark.range(1).select(e).first()[0]
    link = lambda href: one(text.absolute_url(F.lit("http://h/x/y"), F.lit(href)))
    assert [link(h) for h in ("/a/../b", "/../../c", "/a/b/..", "/a/./b?x=/../y", "/")] == [
        "http://h/b", "http://h/c", "http://h/a/", "http://h/a/b?x=/../y", "http://h/"]
