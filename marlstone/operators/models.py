"""Feature stages and models on Spark ML, with the tables the reports are made of.

Fits and transforms run on the executors; the driver sees coefficients, importances and metrics.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions import features as X
from marlstone.functions import fixed
from marlstone.operators import candidates, explore, features, forests, metrics, split
from marlstone.operators.scale import broadcast_within
from marlstone.session import settle

# Feature lists of the accident models.
SEVERITY_CATEGORICAL = ("visibility", "weather", "traffic_density", "road_type", "hour_bin", "cause")
SEVERITY_NUMERIC = ("risk_score", "is_peak_hour", "lanes", "vehicles_involved", "is_festival")
RISK_CATEGORICAL = ("weather", "visibility", "traffic_density", "road_type", "hour_bin", "city")
RISK_NUMERIC = ("temperature", "traffic_signal", "lanes", "is_peak_hour", "is_weekend", "is_festival")
SEGMENT_CATEGORICAL = ("traffic_density", "visibility", "weather", "road_type")
SEGMENT_NUMERIC = ("risk_score", "hour", "casualties", "is_peak_hour", "is_weekend", "temperature")


def _coded(names: Sequence[str], columns: Sequence[str], order: str, unknown: str) -> tuple[list, list[str]]:
    """Stages that turn category columns into 0/1 vectors, and the vectors' names (``names`` with a suffix)."""
    if not names:
        return [], []
    numbers, vectors = [f"{c}_code" for c in names], [f"{c}_hot" for c in names]
    index = StringIndexer(inputCols=list(columns), outputCols=numbers, handleInvalid=unknown, stringOrderType=order)
    return [index, OneHotEncoder(inputCols=numbers, outputCols=vectors)], vectors


def _joined(parts: Sequence[str], output: str, scale: bool = False, nulls: str = "error") -> list:
    """Stages that join columns into one vector, with ``scale`` of mean 0 and deviation 1."""
    if not scale:
        return [VectorAssembler(inputCols=list(parts), outputCol=output, handleInvalid=nulls)]
    plain = f"{output}_plain"
    return [VectorAssembler(inputCols=list(parts), outputCol=plain, handleInvalid=nulls),
            StandardScaler(inputCol=plain, outputCol=output, withMean=True)]


def feature_stages(
    categorical: Sequence[str], numeric: Sequence[str], output: str = "features", scale: bool = False
) -> list:
    """Categories as 0/1 vectors joined with the numbers; with ``scale`` the whole vector is standardised."""
    stages, vectors = _coded(categorical, categorical, "frequencyDesc", "keep")
    return stages + _joined([*vectors, *numeric], output, scale, "keep")


def _fill_stage(fills: dict[str, object], numeric: Sequence[str], categorical: Sequence[str]) -> SQLTransformer:
    """The learned fill values as a saved stage. Filled columns get the suffix ``_f``."""
    parts = []
    for c in numeric:
        value = repr(float(fills.get(c, 0.0)))
        parts.append(f"coalesce(CAST(`{c}` AS DOUBLE), CAST({value} AS DOUBLE)) AS `{c}_f`")
    for c in categorical:
        value = str(fills.get(c, "")).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"coalesce(`{c}`, '{value}') AS `{c}_f`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def preprocessor(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    approximate: bool = False, order: str = "frequencyDesc",
) -> Pipeline:
    """Median and mode fills learned from ``train``, scaled numbers, one-hot categories.

    An unknown category is encoded as all zeros. ``order="alphabetDesc"`` makes the first label in
    alphabetical order the one that a drop-first encoding leaves out.
    """
    fills = explore.fit_fills(train, numeric, categorical, approximate)
    stages: list = [_fill_stage(fills, numeric, categorical)]
    parts = []
    if numeric:
        stages += _joined([f"{c}_f" for c in numeric], "numbers", scale=True)
        parts.append("numbers")
    unknown = "error" if order == "alphabetDesc" else "keep"
    coding, vectors = _coded(categorical, [f"{c}_f" for c in categorical], order, unknown)
    return Pipeline(stages=stages + coding + _joined([*parts, *vectors], "features"))


def feature_names(transformed: DataFrame, column: str = "features", numeric: Sequence[str] = ()) -> list[str]:
    """Names of a vector's slots from its metadata; ``numeric`` names the slots of scaled numbers."""
    meta = transformed.schema[column].metadata.get("ml_attr", {})
    names = {a["idx"]: a.get("name") for group in meta.get("attrs", {}).values() for a in group}
    size = meta.get("num_attrs", len(names))
    out = []
    for i in range(size):
        name = names.get(i)
        if i < len(numeric):
            name = numeric[i]
        out.append((name or f"feature_{i}").replace("_hot_", "=").replace("_f=", "="))
    return out


def importance_table(transformed: DataFrame, importances, column: str = "features") -> DataFrame:
    """(feature, importance), highest first."""
    names = feature_names(transformed, column)
    rows = [(n, round(float(v), 5)) for n, v in zip(names, importances.toArray())]
    table = transformed.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


# Severity classes ------------------------------------------------------------------------------


def severity_pipeline(
    categorical: Sequence[str] = SEVERITY_CATEGORICAL, numeric: Sequence[str] = SEVERITY_NUMERIC,
    seed: int = 42, **settings,
) -> Pipeline:
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", seed=seed, **settings)
    return Pipeline(stages=[*feature_stages(categorical, numeric), forest])


def labelled(df: DataFrame, target: str = "accident_severity") -> tuple[DataFrame, list[str]]:
    """Add the label index (by frequency) and the class weight; also return the label names."""
    indexer = StringIndexer(inputCol=target, outputCol="label", stringOrderType="frequencyDesc").fit(df)
    return split.with_class_weight(indexer.transform(df), target), list(indexer.labels)


def tune_forest(
    train: DataFrame, pipeline: Pipeline, trees: Sequence[int] = (50, 100, 200), depths: Sequence[int] = (5, 10, 15),
    folds: int = 5, seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated search by weighted F1: the best model, fitted on all rows, and the table of candidates.

    Rows are encoded and settled once and dealt to folds. Each fold fits the largest forest of the grid, which
    holds all candidates (see :mod:`marlstone.operators.forests`); their votes for a row come from one walk
    and the F1 of all candidates from one grouped count. The fits of the folds run side by side.
    """
    *front, forest = pipeline.getStages()
    encoder = Pipeline(stages=front).fit(train)
    parts = train.sparkSession.sparkContext.defaultParallelism
    encoded = encoder.transform(train).select("label", forest.getWeightCol(), "features").repartition(parts)
    encoded = settle(encoded.withColumn("fold", F.floor(F.rand(seed) * folds).cast("int")))

    def voted(k: int) -> DataFrame:
        model = forests.fit_largest(forest, encoded.where(F.col("fold") != k), trees, depths)
        return forests.candidate_votes(encoded.where(F.col("fold") == k), model, trees, depths, ["fold", "label"])

    found = None
    for one in _at_once([lambda k=k: voted(k) for k in range(folds)], folds):
        found = one if found is None else found.unionByName(one)
    scores = forests.weighted_f1(forests.predictions(found), ["fold", "num_trees", "max_depth"])
    table = scores.groupBy("num_trees", "max_depth").agg(F.avg("f1").alias("cv_f1")).collect()
    table = sorted(table, key=lambda r: (-r["cv_f1"], r["num_trees"], r["max_depth"]))
    best = forest.copy({forest.numTrees: table[0]["num_trees"], forest.maxDepth: table[0]["max_depth"], **forests.in_few_passes(forest)})
    model = PipelineModel(stages=[*encoder.stages, best.fit(encoded)])
    rows = train.sparkSession.createDataFrame(table, "num_trees int, max_depth int, cv_f1 double")
    return model, rows.orderBy(F.desc("cv_f1"), "num_trees", "max_depth")


def named_predictions(predictions: DataFrame, names: Sequence[str]) -> DataFrame:
    """Label and prediction indexes as names."""
    lookup = F.array(*[F.lit(n) for n in names])
    name = lambda c: F.element_at(lookup, (F.col(c) + 1).cast("int"))
    return predictions.withColumns({"label": name("label"), "prediction": name("prediction")})


# Risk score ------------------------------------------------------------------------------------


def risk_pipeline(
    categorical: Sequence[str] = RISK_CATEGORICAL, numeric: Sequence[str] = RISK_NUMERIC,
    iterations: int = 100, depth: int = 8, step: float = 0.1, seed: int = 42, target: str = "risk_score",
) -> Pipeline:
    """Gradient-boosted trees. Each iteration grows the lineage, so set a checkpoint folder
    on the session (``spark.checkpoint.dir``); the trees then checkpoint every tenth."""
    boosted = GBTRegressor(
        labelCol=target, featuresCol="features", maxIter=iterations, maxDepth=depth, stepSize=step, seed=seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[*feature_stages(categorical, numeric), boosted])


# Segments --------------------------------------------------------------------------------------


def sweep_clusters(
    data: DataFrame, ks: Sequence[int] = (2, 3, 4, 5, 6), seed: int = 42, features_col: str = "features"
) -> tuple[DataFrame, dict[int, object]]:
    """Silhouette and within-cluster sum per k, and the fitted models.

    Only the vectors are settled, and the fits of all k run side by side on them.
    """
    points = settle(data.select(features_col))
    judge = ClusteringEvaluator(featuresCol=features_col, predictionCol="prediction", metricName="silhouette")

    def measured(k: int):
        model = KMeans(featuresCol=features_col, predictionCol="prediction", k=k, seed=seed).fit(points)
        return model, (k, round(float(judge.evaluate(model.transform(points))), 4), round(float(model.summary.trainingCost), 2))

    found = _at_once([lambda k=k: measured(k) for k in ks], len(ks))
    table = data.sparkSession.createDataFrame([row for _, row in found], "k int, silhouette double, wssse double")
    return table, {row[0]: model for model, row in found}


def best_k(sweep: DataFrame) -> int:
    return sweep.orderBy(F.desc("silhouette"), "k").first()["k"]


def dominant_category(predictions: DataFrame, category: str, cluster: str = "prediction") -> DataFrame:
    """Most frequent value per cluster, the smallest on ties. Values are counted before they are ranked."""
    counts = predictions.groupBy(cluster, category).agg(F.count("*").alias("cnt"))
    best = F.min_by(category, F.struct(-F.col("cnt"), F.col(category)))
    return counts.groupBy(cluster).agg(best.alias(f"top_{category}"))


def cluster_profile(
    predictions: DataFrame, averages: dict[str, tuple[str, int]], categories: Sequence[str], cluster: str = "prediction"
) -> DataFrame:
    """Size, rounded averages and dominant categories per cluster.

    ``averages`` maps the output name to (column, digits). The tables joined have one row per cluster.
    """
    profile = predictions.groupBy(cluster).agg(
        F.count("*").alias("size"), *[X.tidy_round(F.avg(c), n).alias(name) for name, (c, n) in averages.items()]
    )
    for category in categories:
        profile = profile.join(dominant_category(predictions, category, cluster), cluster, "left")
    return profile.withColumnRenamed(cluster, "cluster").orderBy("cluster")


# The averages of the accident segments.
SEGMENT_AVERAGES = {
    "avg_risk_score": ("risk_score", 3), "avg_casualties": ("casualties", 2), "avg_hour": ("hour", 1),
    "avg_temperature": ("temperature", 1), "pct_peak_hour": ("is_peak_hour", 2), "pct_weekend": ("is_weekend", 2),
}


# The columns of the extract of assignments, which calls the prediction ``cluster``.
ASSIGNMENT = (
    "accident_id", "city", "state", "latitude", "longitude", "cluster", "risk_score", "hour", "casualties",
    "accident_severity", "weather", "visibility", "road_type", "traffic_density",
)


def assignments(model, data: DataFrame, columns: Sequence[str] = ASSIGNMENT, cluster: str = "prediction") -> DataFrame:
    """Every row with the cluster that a fitted model gives it; only the vector and ``columns`` are read."""
    return model.transform(data).withColumnRenamed(cluster, "cluster").select(*columns)


def nearest_centroid(points: DataFrame, centroids: DataFrame, vector: str, key: str, label: str) -> DataFrame:
    """(key, cluster, distance): the closest centroid, the smallest label on ties.

    The centroids travel as one array next to each point and are walked there.
    """
    packed = centroids.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("c"), F.col(vector).alias("v")))).alias("_all"))
    gap = lambda v: F.aggregate(F.zip_with(vector, v, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    nearest = F.array_min(F.transform("_all", lambda c: F.struct(gap(c["v"]).alias("d"), c["c"].alias("c"))))
    best = points.crossJoin(F.broadcast(packed)).select(key, nearest.alias("b"))  # one row on the right
    return best.select(key, F.col("b.c").alias("cluster"), F.col("b.d").alias("distance"))


# Logistic models -------------------------------------------------------------------------------


@dataclass
class Bundle:
    """A bundle of feature columns over a split table, with its fitted preparation."""

    name: str
    numeric: list[str]
    categorical: list[str]
    data: DataFrame
    preparation: PipelineModel
    names: list[str] = field(default_factory=list)

    def part(self, name: str) -> DataFrame:
        return self.data.filter(F.col("data_split") == name)


def prepare_bundle(
    df: DataFrame, name: str, key: str, target: str = "need_maintenance", seed: int | str = 42, approximate: bool = False
) -> Bundle:
    """Split, fit the preparation on the training rows only, and transform all rows.

    The split rows and the prepared rows are settled, as every later fit and metric reads them;
    release them with :func:`release` when the bundle is no longer used. Rows that hold their ``data_split``
    keep it and are taken as settled, so that bundles of one table can share its cleaning and its split.
    """
    numeric, categorical = features.bundles()[name]
    if "data_split" in df.columns:
        marked = features.bundle(df, name, (key, "data_split"))
    else:
        marked = settle(split.stratified_split(features.bundle(df, name, (key,)), key, target, seed=seed))
    train = marked.filter("data_split = 'train'")
    fitted = preprocessor(train, numeric, categorical, approximate).fit(train)
    data = fitted.transform(marked).select(
        key, "data_split", F.col(target).cast("double").alias("y"), "features"
    )
    weights = split.class_weights(data.filter("data_split = 'train'"), "y").select("y", F.col("balanced_weight").alias("weight"))
    data = settle(data.join(broadcast_within(weights), "y", "left"))
    return Bundle(name, numeric, categorical, data, fitted, feature_names(data, "features", numeric))


def release(bundle: Bundle) -> None:
    bundle.data.unpersist()


def logistic(
    train: DataFrame, c: float = 1.0, penalty: str = "l2", balanced: bool = True, features_col: str = "features",
    iterations: int = 300,
):
    """Binary logistic regression with inverse strength ``c``.

    The penalty is scaled by the total weight, so that ``c`` has the meaning it has where losses
    are summed: regParam = 1 / (c * total weight).
    """
    total = train.agg(F.sum("weight").alias("w"), F.count("*").alias("n")).first()
    size = float(total["w"] if balanced else total["n"])
    settings = {"weightCol": "weight"} if balanced else {}
    return LogisticRegression(
        labelCol="y", featuresCol=features_col, regParam=1.0 / (c * size), standardization=False,
        elasticNetParam=1.0 if penalty == "l1" else 0.0, maxIter=iterations, tol=1e-8, **settings,
    ).fit(train)


def scored(model, df: DataFrame) -> DataFrame:
    """Rows with the probability ``p`` of class 1."""
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def coefficient_table(df: DataFrame, names: Sequence[str], coefficients) -> DataFrame:
    """(feature, coefficient, abs_coefficient), largest first."""
    rows = [(n, float(v), abs(float(v))) for n, v in zip(names, coefficients)]
    table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
    return table.orderBy(F.desc("abs_coefficient"), "feature")


def evaluate_bundle(bundle: Bundle) -> dict[str, object]:
    """Fit on train, tune the threshold on validation, measure both thresholds on both parts."""
    model = logistic(bundle.part("train"))
    rows = settle(scored(model, bundle.data.filter("data_split <> 'train'")).select("data_split", "y", "p"))
    validation, test = rows.filter("data_split = 'validation'"), rows.filter("data_split = 'test'")
    table = metrics.threshold_table(validation)
    tuned = metrics.best_threshold(table).first()["threshold"]
    slices = [
        ("validation_default_0_50", validation, 0.5), ("validation_tuned", validation, tuned),
        ("test_default_0_50", test, 0.5), ("test_tuned", test, tuned),
    ]
    measured = None
    for name, rows, threshold in slices:
        one = metrics.binary_metrics(rows, threshold).select(
            F.lit(bundle.name).alias("model"), F.lit(name).alias("evaluation_slice"), "*"
        )
        measured = one if measured is None else measured.unionByName(one)
    return {
        "model": model,
        "threshold": tuned,
        "thresholds": table,
        "metrics": measured,
        "coefficients": coefficient_table(test, bundle.names, model.coefficients),
        "risk_bands": metrics.risk_band_summary(test).select(F.lit(bundle.name).alias("model"), "*"),
    }


def tuned_summary(metric_rows: DataFrame) -> DataFrame:
    """The tuned test metrics of every model, best F1 first."""
    return metric_rows.filter("evaluation_slice = 'test_tuned'").drop("evaluation_slice").orderBy(
        F.desc("f1"), F.desc("roc_auc"), "model"
    )


def sweep_strengths(bundle: Bundle, penalty: str = "l2", strengths: Sequence[float] | None = None) -> DataFrame:
    """Validation metrics at 0.5 per inverse strength, and the number of features kept. All strengths are
    fitted side by side, and measured in one grouped pass."""
    strengths = strengths or (fixed.L1_STRENGTHS if penalty == "l1" else fixed.L2_STRENGTHS)
    asked = [candidates.Candidate(penalty, float(c)) for c in strengths]
    fitted = candidates.fit_all(bundle.part("train"), asked)
    rows = [(k, penalty, c.c, int((np.abs(w[1:]) > 1e-8).sum())) for k, (c, w) in enumerate(zip(asked, fitted))]
    names = bundle.data.sparkSession.createDataFrame(
        rows, "candidate int, penalty string, C double, selected_transformed_features int")
    measured = metrics.grouped_binary_metrics(candidates.score_all(bundle.part("validation"), fitted, asked), "candidate")
    out = F.broadcast(names).join(measured, "candidate").drop("candidate")  # a row each
    return out.orderBy(F.desc("f1"), F.desc("roc_auc"), F.desc("precision"), "C")


def _at_once(jobs: Sequence[Callable[[], object]], parallelism: int = 4) -> list:
    """Results of the jobs in their order, at most ``parallelism`` of them running."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda job: job(), jobs))


def eliminations(bundle: Bundle, sizes: Sequence[int], share: float = 0.20) -> dict[int, list[int]]:
    """Slots left by recursive elimination for each size: each round drops the weakest 20% of the first count.

    The sizes share the rounds, as only the last round of each drops fewer.
    """
    left, out = list(range(len(bundle.names))), {}
    per_round = max(1, int(share * len(left)))
    train = bundle.part("train")
    out.update({size: left for size in sizes if size >= len(left)})
    while len(out) < len(set(sizes)):
        weights = logistic(_sliced(train, left), features_col="kept").coefficients.toArray()
        ranked = sorted(range(len(left)), key=lambda i: (weights[i] ** 2, i))
        without = lambda n: [left[i] for i in sorted(ranked[n:])]
        out.update({size: without(len(left) - size) for size in sizes if len(left) - per_round <= size < len(left)})
        left = without(min(per_round, len(left)))
    return out


def eliminate(bundle: Bundle, size: int, share: float = 0.20) -> list[int]:
    """Slots left by recursive elimination down to ``size``."""
    return eliminations(bundle, [size], share)[size]


def _sliced(df: DataFrame, slots: Sequence[int]) -> DataFrame:
    return VectorSlicer(inputCol="features", outputCol="kept", indices=list(slots)).transform(df)


def elimination_table(bundles: Sequence[Bundle], sizes: Sequence[int] = fixed.ELIMINATION_SIZES) -> DataFrame:
    """Validation metrics at the tuned threshold per bundle and feature count, all features included."""
    def one(bundle: Bundle, size: int, slots: list[int]):
        total = len(bundle.names)
        model = logistic(_sliced(bundle.part("train"), slots), features_col="kept")
        rows = scored(model, _sliced(bundle.part("validation"), slots))
        threshold = metrics.best_threshold(metrics.threshold_table(rows)).first()["threshold"]
        table = metrics.binary_metrics(rows, threshold).select(
            F.lit(bundle.name).alias("bundle"), F.lit(size).alias("selected_transformed_features"),
            F.lit(total).alias("total_transformed_features"), F.lit(size / total).alias("feature_fraction"), "*",
        )
        return table.first(), table.schema

    wanted = [sorted({s for s in sizes if s <= len(b.names)} | {len(b.names)}) for b in bundles]
    slots = _at_once([lambda b=b, w=w: eliminations(b, w) for b, w in zip(bundles, wanted)])
    found = _at_once([lambda b=b, n=n, s=s: one(b, n, s[n]) for b, w, s in zip(bundles, wanted, slots) for n in w])
    return bundles[0].data.sparkSession.createDataFrame([row for row, _ in found], found[0][1])


ELIMINATION_ORDER = ("f1", "roc_auc", "precision", "recall")


def best_elimination(table: DataFrame) -> DataFrame:
    """Best feature count per bundle, ranked over the bundles."""
    best = metrics.best_per_group(table, "bundle", ELIMINATION_ORDER, ["selected_transformed_features"])
    order = Window.orderBy(*[F.desc(c) for c in ELIMINATION_ORDER], F.asc("selected_transformed_features"))
    return best.withColumn("bundle_rank", F.row_number().over(order))


def grid_search(
    bundle: Bundle, key: str, strengths: Sequence[float] = fixed.L2_STRENGTHS, penalties: Sequence[str] = ("l1", "l2"),
    weights: Sequence[str | None] = (None, "balanced"), folds: int = 3, seed: int | str = 42,
) -> DataFrame:
    """Cross-validated F1, precision, recall and AUC per penalty, strength and class weight.

    Folds are stratified and exact. All candidates are fitted on all folds side by side and measured in one
    grouped pass; the table is ranked by mean F1, ties sharing a rank.
    """
    folded = settle(split.stratified_folds(bundle.part("train"), key, "y", folds, seed))
    asked = [candidates.Candidate(p, float(c), w == "balanced", k) for p in penalties for c in strengths for w in weights for k in range(folds)]
    measured = metrics.grouped_binary_metrics(candidates.score_all(folded, candidates.fit_all(folded, asked), asked), "candidate")
    names = folded.sparkSession.createDataFrame(
        [(i, a.penalty, a.c, "balanced" if a.balanced else "None") for i, a in enumerate(asked)],
        "candidate int, penalty string, C double, class_weight string")
    out = F.broadcast(names).join(measured, "candidate")
    table = out.groupBy("penalty", "C", "class_weight").agg(
        F.avg("f1").alias("cv_mean_f1"), F.stddev_pop("f1").alias("cv_std_f1"), F.avg("precision").alias("cv_mean_precision"),
        F.avg("recall").alias("cv_mean_recall"), F.avg("roc_auc").alias("cv_mean_roc_auc"),
    )
    return metrics.rank_candidates(table, "cv_mean_f1").orderBy("rank_f1", "cv_mean_roc_auc")


def priority_table(bundle: Bundle, model, threshold: float, key: str) -> DataFrame:
    """Every row with split, probability, band, threshold, prediction and actual, most urgent first."""
    rows = scored(model, bundle.data).select(F.col(key).alias("row_id"), "data_split", "y", "p")
    return metrics.priority_list(rows, threshold)
