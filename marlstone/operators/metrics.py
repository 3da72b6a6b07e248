"""Metrics over scored or predicted rows. Each reduces the rows once, then works on the counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions import features as X
from marlstone.functions import fixed
from marlstone.operators.scale import running_totals
from marlstone.session import settle

#: Labels of a square confusion matrix.
SQUARE_LABELS = 4096


def _ratio(a: Column, b: Column, empty: float | None = 0.0) -> Column:
    value = F.try_divide(a.cast("double"), b)
    return value if empty is None else F.coalesce(value, F.lit(empty))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts of the (actual, predicted) pairs that occur."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("count")
    )


def confusion_square(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts for every pair of labels, zeros included. More than ``SQUARE_LABELS`` labels are an error: their
    square has more cells than a table of zeros is good for, and :func:`confusion` gives the pairs that occur."""
    pairs = confusion(df, label, prediction)
    names = pairs.select(F.explode(F.array("actual", "predicted")).alias("name")).distinct()
    every = names.limit(SQUARE_LABELS + 1).agg(F.array_sort(F.collect_set("name"))).scalar()
    every = F.when(F.size(every) <= SQUARE_LABELS, every).otherwise(
        F.raise_error(F.lit(f"a square of more than {SQUARE_LABELS} labels")))
    square = names.select(F.col("name").alias("actual"), F.explode(every).alias("predicted"))
    return square.join(pairs, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )


def confusion_wide(square: DataFrame, labels: Sequence) -> DataFrame:
    """One row per actual label, one column per predicted label."""
    return square.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("count"))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    pairs = confusion(df, label, prediction)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("count").alias("support"), F.lit(0).cast("bigint").alias("called"),
                         F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0).alias("hit")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("count").alias("called"),
                         F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    totals = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
    precision, recall = _ratio(F.col("hit"), F.col("called")), _ratio(F.col("hit"), F.col("support"))
    return totals.select(
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2.0 * F.col("hit"), F.col("called") + F.col("support")).alias("f1"),
        "support",
    )


def overall(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row."""
    by_class = per_class(df, label, prediction)
    n = F.sum("support")
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / n)
    return by_class.agg(
        weighted("recall").alias("accuracy"),
        weighted("f1").alias("weighted_f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    )


def metric_table(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Overall metrics and per-class metrics in one table, missing cells NULL."""
    row = overall(df, label, prediction)
    long = row.unpivot([], row.columns, "metric", "value").withColumn("value", X.tidy_round("value", 4))
    classes = per_class(df, label, prediction).select(
        F.col("label").alias("severity"),
        *[X.tidy_round(c, 4).alias(c) for c in ("precision", "recall", "f1")],
    )
    return long.unionByName(classes, allowMissingColumns=True)


def report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class rows plus accuracy, macro average and weighted average rows."""
    classes = per_class(df, label, prediction).withColumn("label", F.col("label").cast("string"))
    parts = ("precision", "recall", "f1")
    n = F.sum("support")
    macro = classes.agg(*[F.avg(c).alias(c) for c in parts], n.alias("support")).withColumn("label", F.lit("macro avg"))
    weighted = classes.agg(
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(c) for c in parts], n.alias("support")
    ).withColumn("label", F.lit("weighted avg"))
    accuracy = classes.agg((F.sum(F.col("recall") * F.col("support")) / n).alias("f1"), n.alias("support")).withColumn(
        "label", F.lit("accuracy")
    )
    return classes.unionByName(accuracy, allowMissingColumns=True).unionByName(macro).unionByName(weighted)


def regression(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, R2 and MAE, one row."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    return df.agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
    )


def residual_table(df: DataFrame, keep: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Kept columns with actual, prediction and residual, the last two at 4 digits."""
    return df.select(
        *keep,
        F.col(actual).alias("actual"),
        F.round(predicted, 4).alias("prediction"),
        X.residual(actual, predicted).alias("residual"),
    )


def residual_sum(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    return df.agg(F.sum(e * e).alias("rss"), F.count("*").alias("n"))


def error_width(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Constant half width of a 95% interval: 1.96 sample deviations of the error."""
    return df.agg((1.96 * F.stddev_samp(F.col(actual) - F.col(predicted))).alias("half_width"))


def score_counts(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(p).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )


def score_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per distinct score: pos, neg, and the totals tp, fp at scores from it upwards."""
    return running_totals(score_counts(df, y, p), "score", {"pos": "tp", "neg": "fp"}, descending=True)


def roc_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Curve points (threshold, fpr, tpr) at every distinct score, and the start point (0, 0)."""
    curve = score_curve(df, y, p)
    totals = df.agg(
        F.struct(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    ).scalar()
    points = curve.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("fp"), totals["neg"], None).alias("fpr"),
        _ratio(F.col("tp"), totals["pos"], None).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def pr_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Curve points (threshold, precision, recall) at every distinct score, and the end point (1, 0)."""
    curve = score_curve(df, y, p)
    positives = df.agg(F.count_if(F.col(y) == 1)).scalar()
    points = curve.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), positives, None).alias("recall"),
    )
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def ranking_quality(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """ROC-AUC by mid-ranks and average precision as a step sum, one row."""
    curve = score_curve(df, y, p)
    pos, neg = F.sum("pos"), F.sum("neg")
    above = F.col("tp") - F.col("pos")
    return curve.agg(
        _ratio(F.sum(F.col("neg") * (above + F.col("pos") / 2)), pos * neg, None).alias("roc_auc"),
        _ratio(F.sum(F.col("pos") * _ratio(F.col("tp"), F.col("tp") + F.col("fp"))), pos, None).alias("pr_auc"),
    )


def _counts(y: str, called: Column) -> list[Column]:
    actual = F.col(y) == 1
    return [
        F.count_if(~actual & ~called).alias("tn"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(actual & ~called).alias("fn"),
        F.count_if(actual & called).alias("tp"),
    ]


def binary_metrics(df: DataFrame, threshold: float = 0.5, y: str = "y", p: str = "p") -> DataFrame:
    """Accuracy, precision, recall, specificity, F1, ROC-AUC, average precision, Brier and counts, one row.

    Precision, recall and F1 are 0 when undefined, the others are NULL. Rows are read once: everything follows
    from their count by score.
    """
    return _binary(df, [], threshold, y, p)


def grouped_binary_metrics(df: DataFrame, key: str, threshold: float = 0.5, y: str = "y", p: str = "p") -> DataFrame:
    """:func:`binary_metrics` of every value of ``key`` from one count of rows by key and score."""
    return _binary(df, [key], threshold, y, p)


def _binary(df: DataFrame, keys: list[str], threshold: float, y: str, p: str) -> DataFrame:
    value = F.col(p) >= threshold
    scores = settle(df.groupBy(*keys, F.col(p).alias("score")).agg(
        *_counts(y, value), F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"),
        F.sum(F.pow(F.col(p) - F.col(y), 2)).alias("gap"), F.count(F.col(p) - F.col(y)).alias("scored")))
    curve = running_totals(scores, "score", {"pos": "_tp", "neg": "_fp"}, descending=True, partition=keys)
    above = F.col("_tp") - F.col("pos")
    found = curve.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tn", "fp", "fn", "tp", "pos", "neg", "scored")],
        F.sum("gap").alias("gap"),
        F.sum(F.col("neg") * (above + F.col("pos") / 2)).alias("_pairs"),
        F.sum(F.col("pos") * _ratio(F.col("_tp"), F.col("_tp") + F.col("_fp"))).alias("_steps"))
    tn, fp, fn, tp, pos, neg = (F.col(c) for c in ("tn", "fp", "fn", "tp", "pos", "neg"))
    return found.select(
        *keys, F.lit(float(threshold)).alias("threshold"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tn, tn + fp, None).alias("specificity"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(F.col("_pairs"), pos * neg, None).alias("roc_auc"),
        _ratio(F.col("_steps"), pos, None).alias("pr_auc"),
        _ratio(F.col("gap"), F.col("scored"), None).alias("brier_score"), "tn", "fp", "fn", "tp",
    )


def threshold_table(
    df: DataFrame,
    y: str = "y",
    p: str = "p",
    start: float = fixed.THRESHOLD_START,
    step: float = fixed.THRESHOLD_STEP,
    count: int = fixed.THRESHOLD_COUNT,
) -> DataFrame:
    """Precision, recall and F1 at evenly spaced thresholds.

    Each row falls into the bucket of the thresholds it passes, so the rows are reduced to
    ``count + 1`` counts; running sums over those give every threshold.
    """
    score = F.col(p)
    value = lambda k: F.lit(start) + F.lit(step) * k
    guess = F.greatest(F.lit(-1), F.least(F.lit(count - 1), F.floor((score - start) / step))).cast("int")
    # The guess may be off by one where the division rounds; compare with the thresholds themselves.
    passed = (
        F.when((guess < count - 1) & (score >= value(guess + 1)), guess + 1)
        .when((guess >= 0) & (score < value(guess)), guess - 1)
        .otherwise(guess)
    )
    buckets = df.groupBy(passed.alias("k")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    spine = df.sparkSession.range(-1, count).select(F.col("id").cast("int").alias("k"))
    down = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("bigint")
    summed = spine.join(F.broadcast(buckets), "k", "left").select(
        "k",
        F.sum(F.coalesce("pos", zero)).over(down).alias("tp"),
        F.sum(F.coalesce("neg", zero)).over(down).alias("fp"),
        F.sum(F.coalesce("pos", zero)).over(Window.partitionBy()).alias("all_pos"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    return summed.filter("k >= 0").select(
        value(F.col("k")).alias("threshold"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, F.col("all_pos")).alias("recall"),
        _ratio(2 * tp, tp + fp + F.col("all_pos")).alias("f1"),
    )


def best_threshold(table: DataFrame) -> DataFrame:
    """Best F1, then recall (6 digits each), then nearest to 0.5; a full tie keeps the lowest."""
    return table.orderBy(
        F.desc(F.round("f1", 6)), F.desc(F.round("recall", 6)), F.abs(F.col("threshold") - 0.5), "threshold"
    ).limit(1)


def risk_band_summary(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Rows, mean probability and positive rate per band; empty bands stay with 0 rows."""
    bands = df.sparkSession.createDataFrame([(name,) for name, _ in fixed.RISK_BANDS], "band string")
    found = df.filter(F.col(p).isNotNull()).groupBy(X.risk_band(p).alias("band")).agg(
        F.count("*").alias("vehicles"),
        F.avg(p).alias("avg_probability"),
        F.avg(y).alias("actual_positive_rate"),
    )
    return bands.join(F.broadcast(found), "band", "left").select(
        "band", F.coalesce("vehicles", F.lit(0)).cast("bigint").alias("vehicles"),
        "avg_probability", "actual_positive_rate",
    )


def priority_list(df: DataFrame, threshold: float, p: str = "p", y: str = "y", key: str = "row_id") -> DataFrame:
    """Rows with band, prediction and actual, highest probability first, ties by key."""
    return df.select(
        "*",
        X.risk_band(p).alias("maintenance_priority"),
        F.lit(float(threshold)).alias("threshold"),
        X.at_threshold(p, threshold).alias("predicted"),
        F.col(y).cast("int").alias("actual"),
    ).orderBy(F.desc(p), F.asc(key))


def rank_candidates(df: DataFrame, metric: str, name: str = "rank_f1") -> DataFrame:
    """Tie-aware rank of a bounded candidate table, best first."""
    return df.withColumn(name, F.rank().over(Window.orderBy(F.desc(metric))))


def best_per_group(df: DataFrame, group: str, down: Sequence[str], up: Sequence[str] = ()) -> DataFrame:
    """Best row per group by descending, then ascending keys."""
    order = Window.partitionBy(group).orderBy(*[F.desc(c) for c in down], *[F.asc(c) for c in up])
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")
