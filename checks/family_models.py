"""Fitted models, and the parts of them that SQL can check."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import family_clean
from checks.views import table, view, with_views
from marlstone.functions import fixed
from marlstone.operators import clean, dashboard, features, inference, metrics, models, split, textclass
from marlstone.session import scratch_folder, settle, settle_packed

SEVERITY = (("weather", "visibility", "road_type", "cause"), ("risk_score", "hour"))
RISK = (("weather", "road_type", "accident_severity"), ("temperature", "hour"))
SEGMENT = (("weather", "visibility", "road_type"), ("risk_score", "hour", "casualties", "temperature"))


def accidents(s, d):
    df = clean.clean_accidents(view(s, d, "incidents"), modes=["weather", "visibility"])
    return clean.engineer_accidents(df)


def _forest(s, d):
    data, names = models.labelled(settle(accidents(s, d)))
    train, test = split.bernoulli_split(data, "accident_id", "accident_severity")
    fitted = models.severity_pipeline(*SEVERITY).fit(train)
    return fitted, fitted.transform(test), names


def _searched(s, d):
    data, names = models.labelled(settle(accidents(s, d)))
    train, test = split.bernoulli_split(data, "accident_id", "accident_severity")
    return *models.tune_forest(train, models.severity_pipeline(*SEVERITY)), test, names


def _tuned(s, d):
    return _searched(s, d)[1]


def _winner(s, d):
    best, _, test, names = _searched(s, d)
    return best, best.transform(test), names


def _boosted(s, d):
    train, test = split.random_split(settle(accidents(s, d)), "accident_id")
    fitted = models.risk_pipeline(*RISK).fit(train)
    return fitted, fitted.transform(test)


def _segments(s, d):
    from pyspark.ml import Pipeline

    df = accidents(s, d)
    df = settle(df.withColumn("traffic_density", F.when(F.col("hour").between(7, 18), "high").otherwise("low")))
    data = Pipeline(stages=models.feature_stages(*SEGMENT, scale=True)).fit(df).transform(df)
    return data, *models.sweep_clusters(data, (2, 3, 4, 5, 6))


def _assigned(s, d):
    data, sweep, fitted = _segments(s, d)
    return models.assignments(fitted[models.best_k(sweep)], data)


def _profile(s, d):
    data, sweep, fitted = _segments(s, d)
    averages = {k: v for k, v in models.SEGMENT_AVERAGES.items() if v[0] in SEGMENT[1]}
    return models.cluster_profile(fitted[models.best_k(sweep)].transform(data), averages, ["weather", "visibility", "road_type"])


def _grouped(s, d):
    """The incidents with a fixed cluster number, for the profile tables."""
    return view(s, d, "incidents").withColumn("prediction", (F.col("accident_id") % 4).cast("int"))


AVERAGES = {"avg_risk_score": ("risk_score", 3), "avg_casualties": ("casualties", 2), "avg_hour": ("hour", 1)}


@lru_cache(maxsize=8)
def _divided(s, d):
    """The engineered vehicles with their split, cleaned once for all bundles; the split is the same in each."""
    return split.stratified_split(settle(family_clean.engineered(s, d)), "vid", clean.VEHICLE_TARGET)


@lru_cache(maxsize=8)
def _bundle(s, d, name):
    return models.prepare_bundle(_divided(s, d), name, "vid")


def _evaluated(s, d, name="engineered_full_lr"):
    return models.evaluate_bundle(_bundle(s, d, name))


def _all_metrics(s, d):
    out = None
    for name in ("baseline_cleaned_lr", "engineered_full_lr", "leakage_aware_lr"):
        one = _evaluated(s, d, name)["metrics"]
        out = one if out is None else out.unionByName(one)
    return out


def _priority(s, d):
    b = _bundle(s, d, "engineered_full_lr")
    r = models.evaluate_bundle(b)
    return models.priority_table(b, r["model"], r["threshold"], "vid")


def _served(s, d):
    """A text classifier that is saved, loaded and applied to the held-out texts as they arrive."""
    marked = settle_packed(split.stratified_split(
        texts(s, d).select("doc_id", "text", "label"), "doc_id", "label", test=0.25, validation=0.0, seed=42))
    train, held_out = marked.filter("data_split = 'train'"), marked.filter("data_split = 'test'").drop("data_split")
    base = scratch_folder(s)
    textclass.save_classifier(s, f"{base}/model", *textclass.fit_classifier(train, "doc_id", "text", "label"))
    held_out.write.parquet(f"{base}/arriving")
    arriving = s.readStream.schema(held_out.schema).option("maxFilesPerTrigger", 1000).parquet(f"{base}/arriving")
    model = textclass.SavedClassifier(s, f"{base}/model")
    model.classify_stream(arriving, "doc_id", "text", f"{base}/answers", f"{base}/progress").awaitTermination()
    answers = s.read.parquet(f"{base}/answers").drop("batch")
    return held_out.select("doc_id", "label").join(answers, "doc_id")


def _odds(s, d):
    """The odds ratios of every bundle."""
    tables = [inference.odds_ratios(s, _logit(s, d, name)).withColumn("model", F.lit(name)) for name in features.bundles()]
    return reduce(DataFrame.unionByName, tables)


def _logit(s, d, name="engineered_full_lr"):
    return inference.fit_logit(_divided(s, d), name, "vid")


def texts(s, d):
    return table(s, d, "documents").select("doc_id", "text", F.col("lang").alias("label"))


def _tfidf(s, d):
    return textclass.weighted_terms(texts(s, d), "doc_id", "text")


def _encoded(s, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = view(s, d, "incidents").select("accident_id", "cause", F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"))
    out = Pipeline(stages=models.feature_stages(["cause"], ["risk_score"])).fit(df).transform(df)
    v = vector_to_array("features")
    return out.select("accident_id", F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.size(v).alias("size"))


def _prepared(s, d):
    """Mean of every slot of the prepared training rows: 0 for scaled numbers, a share for categories."""
    from pyspark.ml.functions import vector_to_array

    b = _bundle(s, d, "engineered_full_lr")
    v = b.part("train").select(F.explode(F.arrays_zip(F.array(*[F.lit(n) for n in b.names]).alias("n"), vector_to_array("features").alias("v"))).alias("x"))
    return v.groupBy(F.col("x.n").alias("feature")).agg(F.round(F.abs(F.avg("x.v")), 6).alias("mean"))


def _centroids(s, d):
    e = table(s, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    means = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.round(F.avg("x"), 6).alias("m"))
    packed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p"))
    centres = packed.select("label", F.transform("p", lambda q: q["m"]).alias("v"))
    return models.nearest_centroid(e, centres, "v", "vec_id", "label").select("vec_id", "cluster", F.round("distance", 5).alias("distance"))


QUERIES = {
    "m4_feature_stages": _encoded,
    "m5_preprocessor": _prepared,
    "m7_forest_metrics": lambda s, d: (lambda r: metrics.metric_table(models.named_predictions(r[1], r[2])))(_forest(s, d)),
    "m8_forest_grid": _tuned,
    "m7_m8_winner_metrics": lambda s, d: (lambda r: metrics.metric_table(models.named_predictions(r[1], r[2])))(_winner(s, d)),
    "m10_m8_winner_importance": lambda s, d: (lambda r: models.importance_table(r[1], r[0].stages[-1].featureImportances))(_winner(s, d)),
    "m10_dx6_importance": lambda s, d: (lambda r: models.importance_table(r[1], r[0].stages[-1].featureImportances))(_forest(s, d)),
    "m11_boosted_metrics": lambda s, d: metrics.regression(_boosted(s, d)[1], "risk_score", "prediction"),
    "dx14_boosted_importance": lambda s, d: (lambda r: models.importance_table(r[1], r[0].stages[-1].featureImportances))(_boosted(s, d)),
    "m13_dx9_cluster_sweep": lambda s, d: _segments(s, d)[1],
    "m14_nearest_centroid": _centroids,
    "m14_assignments": _assigned,
    "ag14_cluster_profile_fitted": _profile,
    "ag14_j2_wn1_cluster_profile": lambda s, d: models.cluster_profile(_grouped(s, d), AVERAGES, ["weather", "road_type"]),
    "dx10_risk_by_cluster": lambda s, d: dashboard.risk_by_cluster(models.cluster_profile(_grouped(s, d), AVERAGES, [])),
    "dx11_cluster_table": lambda s, d: models.cluster_profile(_grouped(s, d), AVERAGES, ["cause"]).select("cluster", "size", "avg_risk_score", "top_cause"),
    "dx12_scatter_bins": lambda s, d: dashboard.scatter_bins(_grouped(s, d), "hour", "risk_score", "prediction", 4.0, 0.25),
    "dx12_casualty_bins": lambda s, d: dashboard.scatter_bins(_grouped(s, d), "casualties", "risk_score", "prediction", 1.0, 0.25),
    "m15_m21_bundle_metrics": _all_metrics,
    "m16_coefficients": lambda s, d: _evaluated(s, d)["coefficients"],
    "m20_tuned_summary": lambda s, d: models.tuned_summary(_all_metrics(s, d)),
    "m22_l2_sweep": lambda s, d: models.sweep_strengths(_bundle(s, d, "engineered_full_lr"), "l2"),
    "m23_l1_sweep": lambda s, d: models.sweep_strengths(_bundle(s, d, "engineered_full_lr"), "l1"),
    "m24_elimination": lambda s, d: models.best_elimination(models.elimination_table([_bundle(s, d, name) for name in features.bundles()])),
    "m25_grid_search": lambda s, d: models.grid_search(_bundle(s, d, "leakage_aware_lr"), "vid"),
    "m26_priority_table": _priority,
    "m28_m29_odds_ratios": _odds,
    "m30_goodness_of_fit": lambda s, d: inference.goodness_of_fit(s, [_logit(s, d, name) for name in features.bundles()]),
    "m30_log_likelihoods": lambda s, d: inference.log_likelihoods(view(s, d, "scored").withColumn("p", F.col("p") * 0.98 + 0.01)).select(
        "n_obs", F.round("log_likelihood", 4).alias("log_likelihood"), F.round("null_log_likelihood", 4).alias("null_log_likelihood")
    ),
    "m31_tfidf": lambda s, d: _tfidf(s, d).select("doc_id", "term", "tf", F.round("weight", 9).alias("weight")),
    "m32_m33_naive_bayes": lambda s, d: textclass.naive_bayes_holdout(texts(s, d)).select("doc_id", "label", "prediction", F.round("score", 6).alias("score")),
    "m33_served_classifier": lambda s, d: _served(s, d).select("doc_id", "label", "prediction", F.round("score", 6).alias("score")),
    "m34_classifier_comparison": lambda s, d: textclass.compare_classifiers(texts(s, d)),
}


def _i(sql, extra=""):
    return with_views(sql, "incidents", extra=extra)


_TOP = "(SELECT {c} FROM incidents x WHERE x.accident_id % 4 = g.cluster GROUP BY 1 ORDER BY count(*) DESC, 1 NULLS FIRST LIMIT 1)"


def _profile_sql(select, tops=()):
    from checks.sqltext import d

    cols = f"{d('avg(risk_score)', 3)} AS avg_risk_score, {d('avg(casualties)', 2)} AS avg_casualties, {d('avg(hour)', 1)} AS avg_hour"
    ctes = f"g AS (SELECT CAST(accident_id % 4 AS INTEGER) AS cluster, count(*) AS size, {cols} FROM incidents GROUP BY 1)"
    for c in tops:
        ctes += (
            f", t_{c} AS (SELECT cluster, {c} AS top_{c} FROM (SELECT CAST(accident_id % 4 AS INTEGER) AS cluster, {c}, "
            f"row_number() OVER (PARTITION BY accident_id % 4 ORDER BY count(*) DESC, {c} NULLS FIRST) AS rn FROM incidents GROUP BY accident_id % 4, {c}) WHERE rn = 1)"
        )
    joins = "".join(f" JOIN t_{c} USING (cluster)" for c in tops)
    return _i(f"SELECT {select} FROM g{joins}", ctes)


_STOP = ", ".join(f"'{w}'" for w in fixed.STOPWORDS)


def _counts(source, name, extra=""):
    w = f"list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda t: t NOT IN ({_STOP}))"
    return (
        f"{name}_w AS MATERIALIZED (SELECT doc_id{extra}, {w} AS w FROM {source}), "
        f"{name} AS MATERIALIZED (SELECT doc_id{extra}, term, count(*) AS tf FROM (SELECT doc_id{extra}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) AS term FROM {name}_w) GROUP BY ALL)"
    )


_SPLIT = (
    "marked AS MATERIALIZED (SELECT doc_id, text, lang AS label, row_number() OVER (PARTITION BY lang ORDER BY md5(concat(CAST(doc_id AS VARCHAR), '|42'))) AS r, "
    "count(*) OVER (PARTITION BY lang) AS c FROM documents), train AS (SELECT * FROM marked WHERE r > round(c * 0.25)), test AS (SELECT * FROM marked WHERE r <= round(c * 0.25))"
)
_IDF = "SELECT term, ln((1 + (SELECT count(*) FROM {docs})) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM {c} GROUP BY 1"

ORACLES = {
    "m4_feature_stages": _i("SELECT accident_id, round(1 + coalesce(risk_score, 0), 9) AS total, CAST((SELECT count(DISTINCT cause) FROM incidents) + 1 AS INTEGER) AS size FROM incidents"),
    "m14_nearest_centroid": "WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), "
    "m AS (SELECT label, i, round(avg(CAST(x AS DOUBLE)), 6) AS m FROM e GROUP BY 1, 2), d AS (SELECT e.vec_id, m.label, sum(pow(CAST(e.x AS DOUBLE) - m.m, 2)) AS d FROM e JOIN m ON m.i = e.i GROUP BY 1, 2) "
    "SELECT vec_id, arg_min(label, d) AS cluster, round(min(d), 5) AS distance FROM d GROUP BY 1",
    "ag14_j2_wn1_cluster_profile": _profile_sql("cluster, size, avg_risk_score, avg_casualties, avg_hour, top_weather, top_road_type", ("weather", "road_type")),
    "dx10_risk_by_cluster": _profile_sql("cluster, avg_risk_score"),
    "dx11_cluster_table": _profile_sql("cluster, size, avg_risk_score, top_cause", ("cause",)),
    "dx12_scatter_bins": _i(
        "SELECT CAST(accident_id % 4 AS INTEGER) AS prediction, CAST(floor(hour / 4.0) * 4 AS DOUBLE) AS hour, CAST(floor(risk_score / 0.25) * 0.25 AS DOUBLE) AS risk_score, count(*) AS n "
        "FROM incidents GROUP BY 1, 2, 3"
    ),
    "dx12_casualty_bins": _i(
        "SELECT CAST(accident_id % 4 AS INTEGER) AS prediction, CAST(casualties AS DOUBLE) AS casualties, CAST(floor(risk_score / 0.25) * 0.25 AS DOUBLE) AS risk_score, count(*) AS n "
        "FROM incidents GROUP BY 1, 2, 3"
    ),
    "m30_log_likelihoods": with_views(
        "SELECT count(*) AS n_obs, round(sum(y * ln(p * 0.98 + 0.01) + (1 - y) * ln(1 - (p * 0.98 + 0.01))), 4) AS log_likelihood, "
        "round(count(*) * (avg(y) * ln(avg(y)) + (1 - avg(y)) * ln(1 - avg(y))), 4) AS null_log_likelihood FROM scored", "scored"
    ),
    "m31_tfidf": "WITH " + _counts("documents", "c") + ", idf AS (" + _IDF.format(docs="documents", c="c") + "), "
    "w AS (SELECT doc_id, term, tf, tf * idf AS w FROM c JOIN idf USING (term)), n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1) "
    "SELECT doc_id, term, tf, round(w / norm, 9) AS weight FROM w JOIN n USING (doc_id)",
    "m32_m33_naive_bayes": "WITH " + _SPLIT + ", " + _counts("train", "c", ", label") + ", " + _counts("test", "t") + ", idf AS MATERIALIZED (" + _IDF.format(docs="train", c="c") + "), "
    "w AS (SELECT doc_id, label, term, tf * idf AS w FROM c JOIN idf USING (term)), n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1), "
    "mass AS (SELECT label, term, sum(w / norm) AS m FROM w JOIN n USING (doc_id) GROUP BY 1, 2), tot AS (SELECT label, sum(m) AS t FROM mass GROUP BY 1), "
    "v AS (SELECT count(*) AS v FROM idf), pri AS (SELECT label, ln(count(*) / CAST((SELECT count(*) FROM train) AS DOUBLE)) AS p FROM train GROUP BY 1), "
    "tw AS (SELECT doc_id, term, tf * idf AS w FROM t JOIN idf USING (term)), tn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM tw GROUP BY 1), "
    "dots AS (SELECT tw.doc_id, tot.label, sum(tw.w * ln((coalesce(m, 0) + 1) / (tot.t + v.v))) / any_value(norm) AS dot FROM tw JOIN tn USING (doc_id) CROSS JOIN tot CROSS JOIN v "
    "LEFT JOIN mass ON mass.term = tw.term AND mass.label = tot.label GROUP BY 1, 2), "
    "s AS (SELECT d.doc_id, pri.label, round(pri.p + coalesce(dots.dot, 0), 9) AS s FROM test d CROSS JOIN pri LEFT JOIN dots ON dots.doc_id = d.doc_id AND dots.label = pri.label), "
    "best AS (SELECT doc_id, label, s FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, label) AS rn FROM s) WHERE rn = 1) "
    "SELECT test.doc_id, test.label, best.label AS prediction, round(best.s, 6) AS score FROM test JOIN best USING (doc_id)",
}
# The classifier answers the same texts whether it is at hand or saved and loaded.
ORACLES["m33_served_classifier"] = ORACLES["m32_m33_naive_bayes"]
