"""Splits, metrics, curves, bands, windows and sorts over fixed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as q
from checks.views import table, view, with_views
from marlstone.functions import features as X
from marlstone.operators import dashboard, metrics, scale, split


def scored(s, d):
    return view(s, d, "scored")


def predicted(s, d):
    """A fixed three-class prediction over the incidents: the next severity for every seventh row."""
    df = view(s, d, "incidents").select("accident_id", "city", F.col("accident_severity").alias("label"))
    other = F.when(F.col("label") == "minor", "major").when(F.col("label") == "major", "fatal").otherwise("minor")
    return df.withColumn("prediction", F.when(F.col("accident_id") % 7 == 0, other).otherwise(F.col("label")))


def estimated(s, d):
    """A fixed estimate of the price."""
    return table(s, d, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 1500.0 + F.col("l_discount") * 100.0).alias("estimate"),
    )


def candidates(s, d):
    """A bounded candidate table derived from the events: one row per type and day of month."""
    return table(s, d, "events").groupBy(F.col("event_type").alias("bundle"), F.dayofmonth("ts").alias("size")).agg(
        F.round(F.avg("value") / 100, 2).alias("f1"), F.round(F.max("value") / 1000, 2).alias("roc_auc")
    )


r9 = lambda *cs: [F.round(c, 9).alias(c) for c in cs]

QUERIES = {
    "j1_rows_not_in_train": lambda s, d: split.not_in(
        split.assert_key(scored(s, d).select("row_id", "y"), "row_id"), scored(s, d).filter("row_id % 10 < 8"), "row_id"
    ),
    "m1_bernoulli_split": lambda s, d: split.bernoulli_split(
        view(s, d, "incidents").select("accident_id", "accident_severity"), "accident_id", "accident_severity"
    )[1].groupBy("accident_severity").agg(F.count("*").alias("test_rows")),
    "m2_random_split": lambda s, d: split.random_split(scored(s, d), "row_id", 0.8)[0].groupBy("y").agg(F.count("*").alias("n")),
    "m2_hashed_split": lambda s, d: split.hashed_split(scored(s, d).select("row_id", "y"), "row_id", 0.7, 42),
    "m3_stratified_split": lambda s, d: split.stratified_split(scored(s, d).select("row_id", "y"), "row_id", "y", seed=42),
    "m3_stratified_folds": lambda s, d: split.stratified_folds(scored(s, d).select("row_id", "y"), "row_id", "y", 3, 42),
    "m6_label_index": lambda s, d: split.label_index(view(s, d, "incidents"), "accident_severity"),
    "ag12_confusion": lambda s, d: metrics.confusion(predicted(s, d)),
    "ag13_confusion_square": lambda s, d: metrics.confusion_square(predicted(s, d)),
    "dx5_confusion_heatmap": lambda s, d: metrics.confusion_wide(
        metrics.confusion_square(predicted(s, d)), ["fatal", "major", "minor"]
    ),
    "m9_per_class_metrics": lambda s, d: metrics.per_class(predicted(s, d)).select("label", "support", *r9("precision", "recall", "f1")),
    "m9_overall_metrics": lambda s, d: metrics.overall(predicted(s, d)).select(
        *r9("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")
    ),
    "st3_metric_table": lambda s, d: metrics.metric_table(predicted(s, d)),
    "m35_classification_report": lambda s, d: metrics.report(predicted(s, d)).select("label", "support", *r9("precision", "recall", "f1")),
    "dx7_class_metrics": lambda s, d: dashboard.class_metrics(metrics.per_class(predicted(s, d))).withColumn("value", F.round("value", 9)),
    "dx8_overall_metrics": lambda s, d: dashboard.overall_metrics(metrics.metric_table(predicted(s, d))),
    "m12_ag34_regression_metrics": lambda s, d: metrics.regression(estimated(s, d), "actual", "estimate").select(
        F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"), F.round("mae", 4).alias("mae")
    ),
    "pf19_dx13_residual_table": lambda s, d: metrics.residual_table(estimated(s, d), ["l_orderkey"], "actual", "estimate"),
    "ag32_residual_sum": lambda s, d: metrics.residual_sum(estimated(s, d), "actual", "estimate").select("n", F.round("rss", 0).alias("rss")),
    "m41_error_width": lambda s, d: metrics.error_width(estimated(s, d), "actual", "estimate").select(F.round("half_width", 5).alias("half_width")),
    "wn8_roc_points": lambda s, d: metrics.roc_points(scored(s, d)).select("threshold", *r9("fpr", "tpr")),
    "wn9_pr_points": lambda s, d: metrics.pr_points(scored(s, d)).select("threshold", *r9("precision", "recall")),
    "m18_ranking_quality": lambda s, d: metrics.ranking_quality(scored(s, d)).select(*r9("roc_auc", "pr_auc")),
    "m18_m19_binary_metrics": lambda s, d: metrics.binary_metrics(scored(s, d), 0.5).select(
        "threshold", "tn", "fp", "fn", "tp",
        *r9("accuracy", "precision", "recall", "specificity", "f1", "roc_auc", "pr_auc", "brier_score"),
    ),
    "j11_m17_threshold_table": lambda s, d: metrics.threshold_table(scored(s, d)).select(*r9("threshold", "precision", "recall", "f1")),
    "sl6_best_threshold": lambda s, d: metrics.best_threshold(metrics.threshold_table(scored(s, d))).select(*r9("threshold", "precision", "recall", "f1")),
    "pf20_threshold_prediction": lambda s, d: scored(s, d).select("row_id", X.at_threshold("p", 0.39).alias("predicted")),
    "pf21_risk_band": lambda s, d: scored(s, d).select("row_id", X.risk_band("p").alias("band")),
    "j12_ag25_risk_band_summary": lambda s, d: metrics.risk_band_summary(scored(s, d)).select(
        "band", "vehicles", *r9("avg_probability", "actual_positive_rate")
    ),
    "sl3_priority_list": lambda s, d: metrics.priority_list(scored(s, d).select("row_id", "y", "p"), 0.39),
    "m20_st2_model_comparison": lambda s, d: metrics.binary_metrics(scored(s, d), 0.5).select(F.lit("a").alias("model"), "tp", "fp")
    .unionByName(metrics.binary_metrics(scored(s, d), 0.25).select(F.lit("b").alias("model"), "tp", "fp")),
    "wn2_best_per_bundle": lambda s, d: metrics.best_per_group(candidates(s, d), "bundle", ["f1", "roc_auc"], ["size"]),
    "wn4_tied_ranks": lambda s, d: metrics.rank_candidates(candidates(s, d), "f1"),
    "wn3_wn11_row_numbers": lambda s, d: scale.number_rows(
        table(s, d, "events").select("event_id", "value"), "value", descending=True, ties=["event_id"]
    ),
    "wn5_first_per_class": lambda s, d: split.first_per_class(
        table(s, d, "documents").select("lang", "doc_id", "text"), "lang", "doc_id", 40, "text"
    ).select("lang", "doc_id"),
    "sl2_mixed_sort": lambda s, d: candidates(s, d).orderBy(F.desc("f1"), F.desc("roc_auc"), F.asc("size"), F.asc("bundle")).limit(25),
    "sl4_top_by_magnitude": lambda s, d: table(s, d, "customer").select("c_custkey", "c_acctbal").orderBy(
        F.desc(F.abs("c_acctbal")), "c_custkey").limit(12),
    "sl5_best_of_candidates": lambda s, d: candidates(s, d).groupBy("bundle").agg(
        F.max_by("size", F.struct("f1", -F.col("size"))).alias("best_size"), F.max("f1").alias("best_f1")
    ),
    "sl9_preview": lambda s, d: table(s, d, "events").select("event_id", "value").orderBy("event_id").limit(300),
}


def _share(key):
    """The rows whose hash of key and seed is below the share of the training side."""
    return f"('0x' || substr(md5(concat(CAST({key} AS VARCHAR), '|42')), 1, 12))::BIGINT / 281474976710656.0 < 0.8"


def _s(sql, extra=""):
    return with_views(sql, "scored", extra=extra)


_PRED = (
    "predicted AS (SELECT accident_id, accident_severity AS label, CASE WHEN accident_id % 7 = 0 THEN CASE accident_severity "
    "WHEN 'minor' THEN 'major' WHEN 'major' THEN 'fatal' ELSE 'minor' END ELSE accident_severity END AS prediction FROM incidents)"
)
_CLASSES = (
    ", per_class AS (SELECT label, s AS support, CASE WHEN c = 0 THEN 0 ELSE h / c END AS precision, CASE WHEN s = 0 THEN 0 ELSE h / s END AS recall, "
    "2.0::DOUBLE * h / (c + s) AS f1 FROM (SELECT l.label, count(*) FILTER (p.label = l.label) AS s, "
    "count(*) FILTER (p.prediction = l.label) AS c, CAST(count(*) FILTER (p.label = l.label AND p.prediction = l.label) AS DOUBLE) AS h "
    "FROM (SELECT label FROM predicted UNION SELECT prediction FROM predicted) l, predicted p GROUP BY 1)), "
    "overall AS (SELECT sum(recall * support) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS weighted_f1, "
    "sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall FROM per_class)"
)


def _p(sql, classes=True):
    return with_views(sql, "incidents", extra=_PRED + (_CLASSES if classes else ""))


_EST = "WITH e AS (SELECT l_orderkey, l_extendedprice AS actual, l_quantity * 1500::DOUBLE + l_discount * 100::DOUBLE AS estimate FROM lineitem) "
_CURVE = (
    "curve AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, "
    "sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM (SELECT p AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM scored GROUP BY 1))"
)
_QUALITY = (
    "SELECT round(sum(neg * (tp - pos + pos / 2)) / (any_value(ap) * any_value(an)), 9) AS roc_auc, "
    "round(sum(pos * tp / (tp + fp)) / any_value(ap), 9) AS pr_auc FROM curve"
)


def _counts(t):
    return (
        f"SELECT CAST({t} AS DOUBLE) AS threshold, CAST(count(*) FILTER (y = 0 AND p < {t}) AS DOUBLE) AS tn, CAST(count(*) FILTER (y = 0 AND p >= {t}) AS DOUBLE) AS fp, "
        f"CAST(count(*) FILTER (y = 1 AND p < {t}) AS DOUBLE) AS fn, CAST(count(*) FILTER (y = 1 AND p >= {t}) AS DOUBLE) AS tp, avg(pow(p - y, 2)) AS b FROM scored"
    )


_TABLE = (
    "t AS (SELECT CAST(0.2 AS DOUBLE) + CAST(0.005 AS DOUBLE) * k.range AS threshold, CAST(count(*) FILTER (y = 1 AND p >= CAST(0.2 AS DOUBLE) + CAST(0.005 AS DOUBLE) * k.range) AS DOUBLE) AS tp, "
    "count(*) FILTER (y = 0 AND p >= CAST(0.2 AS DOUBLE) + CAST(0.005 AS DOUBLE) * k.range) AS fp, count(*) FILTER (y = 1) AS ap FROM range(121) k, scored GROUP BY k.range), "
    "tt AS (SELECT threshold, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, tp / ap AS recall, 2 * tp / (tp + fp + ap) AS f1 FROM t)"
)
_CAND = (
    "WITH c AS (SELECT event_type AS bundle, CAST(day(ts) AS INTEGER) AS size, " + q.d("avg(value) / 100", 2) + " AS f1, "
    + q.d("max(value) / 1000", 2) + " AS roc_auc FROM events GROUP BY 1, 2) "
)
_H = "md5(concat(CAST(row_id AS VARCHAR), '|42'))"
R = lambda *cs: ", ".join(f"round({c}, 9) AS {c}" for c in cs)

ORACLES = {
    "j1_rows_not_in_train": _s("SELECT row_id, y FROM scored WHERE row_id NOT IN (SELECT row_id FROM scored WHERE row_id % 10 < 8)"),
    "m2_hashed_split": _s(
        f"SELECT row_id, y, CASE WHEN row_number() OVER (ORDER BY {_H}) <= floor((SELECT count(*) FROM scored) * 0.7) THEN 'train' ELSE 'test' END AS data_split FROM scored"
    ),
    "m3_stratified_split": _s(
        "SELECT row_id, y, CASE WHEN r <= round(n * 0.2) THEN 'test' WHEN r <= round(n * 0.2) + round((n - round(n * 0.2)) * 0.2) THEN 'validation' ELSE 'train' END AS data_split "
        f"FROM (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {_H}) AS r, count(*) OVER (PARTITION BY y) AS n FROM scored)"
    ),
    "m3_stratified_folds": _s(
        f"SELECT row_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {_H}) - 1) % 3 AS INTEGER) AS fold FROM scored"
    ),
    "m6_label_index": with_views(
        "SELECT accident_severity, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, accident_severity) - 1 AS DOUBLE) AS index FROM incidents GROUP BY 1", "incidents"
    ),
    "ag12_confusion": _p("SELECT label AS actual, prediction AS predicted, count(*) AS count FROM predicted GROUP BY 1, 2", False),
    "ag13_confusion_square": _p(
        "SELECT a.l AS actual, b.l AS predicted, count(p.accident_id) AS count FROM (SELECT DISTINCT label AS l FROM predicted) a "
        "CROSS JOIN (SELECT DISTINCT label AS l FROM predicted) b LEFT JOIN predicted p ON p.label = a.l AND p.prediction = b.l GROUP BY 1, 2", False
    ),
    "dx5_confusion_heatmap": _p(
        "SELECT label AS actual, " + ", ".join(f"count(*) FILTER (prediction = '{c}') AS {c}" for c in ("fatal", "major", "minor")) + " FROM predicted GROUP BY 1", False
    ),
    "m9_per_class_metrics": _p(f"SELECT label, support, {R('precision', 'recall', 'f1')} FROM per_class"),
    "m9_overall_metrics": _p(f"SELECT {R('accuracy', 'weighted_precision', 'weighted_recall', 'weighted_f1')} FROM overall"),
    "st3_metric_table": _p(
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, {q.d(m, 4)} AS value, NULL AS severity, CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall, CAST(NULL AS DOUBLE) AS f1 FROM overall"
            for m in ("accuracy", "weighted_f1", "weighted_precision", "weighted_recall")
        ) + f" UNION ALL SELECT NULL, NULL, label, {q.d('precision', 4)}, {q.d('recall', 4)}, {q.d('f1', 4)} FROM per_class"
    ),
    "m35_classification_report": _p(
        f"SELECT label, support, {R('precision', 'recall', 'f1')} FROM per_class "
        "UNION ALL SELECT 'macro avg', CAST(sum(support) AS BIGINT), round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9) FROM per_class "
        "UNION ALL SELECT 'weighted avg', (SELECT count(*) FROM predicted), round(weighted_precision, 9), round(weighted_recall, 9), round(weighted_f1, 9) FROM overall "
        "UNION ALL SELECT 'accuracy', (SELECT count(*) FROM predicted), NULL, NULL, round(accuracy, 9) FROM overall"
    ),
    "dx7_class_metrics": _p(" UNION ALL ".join(f"SELECT label AS severity, '{m}' AS metric, round({m}, 9) AS value FROM per_class" for m in ("f1", "precision", "recall"))),
    "dx8_overall_metrics": _p(" UNION ALL ".join(
        f"SELECT '{m}' AS metric, {q.d(m, 4)} AS value FROM overall" for m in ("accuracy", "weighted_f1", "weighted_precision", "weighted_recall"))),
    "m12_ag34_regression_metrics": _EST + "SELECT round(sqrt(avg(pow(actual - estimate, 2))), 4) AS rmse, "
    "round(1 - sum(pow(actual - estimate, 2)) / (var_pop(actual) * count(*)), 8) AS r2, round(avg(abs(actual - estimate)), 4) AS mae FROM e",
    "pf19_dx13_residual_table": _EST + f"SELECT l_orderkey, actual, {q.d('estimate', 4)} AS prediction, {q.d('actual - estimate', 4)} AS residual FROM e",
    "ag32_residual_sum": _EST + "SELECT count(*) AS n, round(sum(pow(actual - estimate, 2)), 0) AS rss FROM e",
    "m41_error_width": _EST + "SELECT round(1.96 * stddev_samp(actual - estimate), 5) AS half_width FROM e",
    "m1_bernoulli_split": with_views(
        f"SELECT accident_severity, count(*) AS test_rows FROM incidents WHERE NOT ({_share('accident_id')} AND accident_severity IS NOT NULL) GROUP BY 1", "incidents"
    ),
    "m2_random_split": _s(f"SELECT y, count(*) AS n FROM scored WHERE {_share('row_id')} GROUP BY 1"),
    "wn8_roc_points": _s("SELECT score AS threshold, round(fp / an, 9) AS fpr, round(tp / ap, 9) AS tpr FROM curve UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0", _CURVE),
    "wn9_pr_points": _s(
        "SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / ap, 9) AS recall FROM curve UNION ALL SELECT NULL, 1, 0", _CURVE
    ),
    "m18_ranking_quality": _s(_QUALITY, _CURVE),
    "m18_m19_binary_metrics": _s(
        "SELECT threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, "
        "round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(tn / (tn + fp), 9) AS specificity, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, "
        "round(b, 9) AS brier_score, roc_auc, pr_auc FROM c, qq", _CURVE + f", qq AS ({_QUALITY}), c AS ({_counts(0.5)})"
    ),
    "j11_m17_threshold_table": _s(f"SELECT {R('threshold', 'precision', 'recall', 'f1')} FROM tt", _TABLE),
    "sl6_best_threshold": _s(
        f"SELECT {R('threshold', 'precision', 'recall', 'f1')} FROM (SELECT * FROM tt ORDER BY round(f1, 6) DESC, round(recall, 6) DESC, abs(threshold - 0.5), threshold LIMIT 1)", _TABLE
    ),
    "pf20_threshold_prediction": _s("SELECT row_id, CAST(p >= CAST(0.39 AS DOUBLE) AS INTEGER) AS predicted FROM scored"),
    "pf21_risk_band": _s("SELECT row_id, CASE WHEN p <= 0.4::DOUBLE THEN 'Low' WHEN p <= 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS band FROM scored"),
    "j12_ag25_risk_band_summary": _s(
        "SELECT b.band, count(s.p) AS vehicles, round(avg(s.p), 9) AS avg_probability, round(avg(s.y), 9) AS actual_positive_rate FROM (VALUES ('Low'), ('Medium'), ('High')) b(band) "
        "LEFT JOIN (SELECT *, CASE WHEN p <= 0.4::DOUBLE THEN 'Low' WHEN p <= 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS band FROM scored) s ON s.band = b.band GROUP BY 1"
    ),
    "sl3_priority_list": _s(
        "SELECT row_id, y, p, CASE WHEN p <= 0.4::DOUBLE THEN 'Low' WHEN p <= 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS maintenance_priority, CAST(0.39 AS DOUBLE) AS threshold, "
        "CAST(p >= CAST(0.39 AS DOUBLE) AS INTEGER) AS predicted, CAST(y AS INTEGER) AS actual FROM scored"
    ),
    "m20_st2_model_comparison": _s(
        "SELECT 'a' AS model, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp FROM scored UNION ALL "
        "SELECT 'b', count(*) FILTER (y = 1 AND p >= 0.25), count(*) FILTER (y = 0 AND p >= 0.25) FROM scored"
    ),
    "wn2_best_per_bundle": _CAND + "SELECT bundle, size, f1, roc_auc FROM (SELECT *, row_number() OVER (PARTITION BY bundle ORDER BY f1 DESC, roc_auc DESC, size) AS rn FROM c) WHERE rn = 1",
    "wn4_tied_ranks": _CAND + "SELECT *, CAST(rank() OVER (ORDER BY f1 DESC) AS INTEGER) AS rank_f1 FROM c",
    "wn3_wn11_row_numbers": "SELECT event_id, value, row_number() OVER (ORDER BY value DESC, event_id) AS row_id FROM events",
    "wn5_first_per_class": "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents WHERE length(text) >= 20) WHERE rn <= 40",
    "sl2_mixed_sort": _CAND + "SELECT * FROM c ORDER BY f1 DESC, roc_auc DESC, size, bundle LIMIT 25",
    "sl4_top_by_magnitude": "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 12",
    "sl5_best_of_candidates": _CAND + "SELECT bundle, size AS best_size, f1 AS best_f1 FROM (SELECT *, row_number() OVER (PARTITION BY bundle ORDER BY f1 DESC, size) AS rn FROM c) WHERE rn = 1",
    "sl9_preview": "SELECT event_id, value FROM events ORDER BY event_id LIMIT 300",
}
