import random

import numpy as np
from pyspark.sql import functions as F

from marlstone.operators import metrics, scale, split


def skewed(spark, n=20_000):
    """A third of the rows share one value and one key."""
    rnd = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rnd.randrange(500)}", 7.0 if i % 3 == 0 else rnd.random() * 100) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, key string, v double")


def test_quantiles_match_sorting(spark):
    df = skewed(spark).unionByName(spark.createDataFrame([(-1, None, None), (-2, "n", float("nan"))], "id bigint, key string, v double"))
    data = np.array([r["v"] for r in skewed(spark).collect()])
    probs = [0.0, 0.02, 0.25, 0.5, 0.9, 1.0]
    got = scale.exact_quantiles(df, ["v"], probs, bins=8, settle=50)["v"]
    assert np.allclose(got, np.quantile(data, probs))
    assert scale.exact_quantiles(df.filter("v IS NULL"), ["v"], [0.5])["v"] == [None]


def test_row_numbers_and_totals_match_one_sorted_pass(spark):
    df = skewed(spark, 3_000)
    got = {r["id"]: r["n"] for r in scale.number_rows(df, "v", "n", ties=["id"]).collect()}
    order = sorted(df.collect(), key=lambda r: (r["v"], r["id"]))
    assert got == {r["id"]: i + 1 for i, r in enumerate(order)}
    down = {r["id"]: r["t"] for r in scale.running_totals(df, "v", {"id": "t"}, descending=True, ties=["id"]).collect()}
    total, want = 0, {}
    for r in sorted(df.collect(), key=lambda r: (-r["v"], r["id"])):
        total += r["id"]
        want[r["id"]] = total
    assert down == want


def test_lookup_join_keeps_every_row(spark):
    df = skewed(spark)
    terms = df.groupBy("key").agg(F.count("*").alias("heat")).filter("key <> 'k7'").withColumn("payload", F.length("key"))
    got = scale.lookup_join(df, terms, "key", "heat", "id")
    assert got.count() == df.count()
    assert got.filter("payload IS NULL").select("key").distinct().collect() == [("k7",)]
    assert got.filter("payload <> length(key)").count() == 0


def test_broadcast_only_when_small(spark):
    hint = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(scale.broadcast_within(spark.range(5), 10))
    assert not hint(scale.broadcast_within(spark.range(50), 10))


def test_stratified_split_is_exact_and_disjoint(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    rows = split.stratified_split(df, "id", "y").groupBy("y", "data_split").count().collect()
    sizes = {(r["y"], r["data_split"]): r["count"] for r in rows}
    assert sizes == {(0, "test"): 180, (0, "validation"): 144, (0, "train"): 576, (1, "test"): 20, (1, "validation"): 16, (1, "train"): 64}


def test_auc_against_pairs(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(2), round(rnd.random(), 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, y int, p double")
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(metrics.ranking_quality(df).first()["roc_auc"] - auc) < 1e-12
    table = {round(r["threshold"], 3): r for r in metrics.threshold_table(df).collect()}
    for t in (0.2, 0.5, 0.7, 0.8):
        tp = sum(y and p >= 0.2 + 0.005 * round((t - 0.2) / 0.005) for _, y, p in rows)
        called = sum(p >= 0.2 + 0.005 * round((t - 0.2) / 0.005) for _, _, p in rows)
        assert abs(table[t]["precision"] - (tp / called if called else 0)) < 1e-12


def test_heavy_values_are_cut_by_their_ties(spark):
    rows = [(i, 7.0 if i % 2 else float(i % 5000), f"g{0 if i % 3 else i % 40}") for i in range(60_000)]
    rows += [(-1, None, "g0"), (-2, None, None)]
    df = spark.createDataFrame(rows, "id bigint, v double, g string")
    for descending in (False, True):
        ranged = scale.ordered_ranges(df, "v", ["id"], descending)
        sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
        assert sum(sizes) == len(rows) and max(sizes) < 0.05 * len(rows)
        key = lambda r: (r[1] is None, r[1] or 0, r[0])
        down = lambda r: (r[1] is not None, -(r[1] or 0), r[0])
        want = sorted(rows, key=down if descending else key)
        got = {r["id"]: r["n"] for r in scale.number_rows(df, "v", "n", descending, ["id"]).collect()}
        assert got == {r[0]: k + 1 for k, r in enumerate(want)}
        totals = {r["id"]: r["t"] for r in scale.running_totals(df, "v", {"id": "t"}, descending, ["id"]).collect()}
        assert totals == dict(zip([r[0] for r in want], np.cumsum([r[0] for r in want]).tolist()))
    groups: dict = {}
    for r in sorted(rows, key=key):
        groups.setdefault(r[2], []).append(r[0])
    got = {r["id"]: r["n"] for r in scale.number_rows(df, "v", "n", ties=["id"], partition=["g"]).collect()}
    assert got == {i: k + 1 for ids in groups.values() for k, i in enumerate(ids)}


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(scale, "RANGE_ROWS", 100)
    ranged = scale.ordered_ranges(spark.range(10_000).withColumn("v", F.lit(1)), "v", ["id"])
    assert ranged.select("_range").distinct().count() > 80


def test_numbering_takes_one_exchange(spark):
    plan = scale.number_rows(spark.range(1000).withColumn("v", F.lit(1.0)), "v", ties=["id"])._jdf.queryExecution().executedPlan().toString()
    own = [line for line in plan.split("InMemoryRelation")[0].splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert not own


def test_splits_cut_without_sorting_the_table(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 4).alias("c"), F.lit("x").alias("_r"))
    out = split.stratified_split(df, "k", "c")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.split("ResultQueryStage")[-1] and "Window" not in plan
    hashed = [(r["k"], r["c"], r["h"]) for r in df.withColumn("h", F.md5(F.concat(F.col("k").cast("string"), F.lit("|42")))).collect()]
    want = {}
    for c in {c for _, c, _ in hashed}:
        own = [k for k, x, h in sorted(hashed, key=lambda r: r[2]) if x == c]
        test = int(len(own) * 0.2 + 0.5)
        valid = test + int((len(own) - test) * 0.2 + 0.5)
        want.update({k: "test" if i < test else "validation" if i < valid else "train" for i, k in enumerate(own)})
    assert {r["k"]: r["data_split"] for r in out.collect()} == want
    ranked = [k for k, _, h in sorted(hashed, key=lambda r: r[2])]
    train = {r["k"] for r in split.hashed_split(df, "k", 0.3).collect() if r["data_split"] == "train"}
    assert train == set(ranked[:1500])
    assert split.stratified_split(df.limit(0), "k", "c").count() == 0 and split.hashed_split(df.limit(0), "k").count() == 0
    assert {r[0] for r in split.hashed_split(df, "k", 0.0).select("data_split").distinct().collect()} == {"test"}
