"""The segment job: choose the number of clusters, keep the model and its tables, assign rows that come later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import models
from marlstone.session import SettledTables, settle
from marlstone.sources import files


def train(
    df: DataFrame, folder: str, categorical: Sequence[str], numeric: Sequence[str],
    ks: Sequence[int] = (2, 3, 4, 5, 6), columns: Sequence[str] = models.ASSIGNMENT,
) -> dict[int, float]:
    """Fit and write under ``folder``: ``model``, ``assignments`` and ``profiles`` (CSV) and ``metrics`` (nested JSON).

    The metrics are one record: the chosen k, the columns used and the whole sweep. What the job settles is
    freed when it ends. Returns the silhouette of every k.
    """
    spark = df.sparkSession
    with SettledTables():
        prepared = Pipeline(stages=models.feature_stages(categorical, numeric, scale=True)).fit(df)
        data = settle(prepared.transform(df))
        sweep, fitted = models.sweep_clusters(data, ks)
        k = models.best_k(sweep)
        files.save_model(PipelineModel(stages=[*prepared.stages, fitted[k]]), f"{folder}/model")
        files.write_csv(models.assignments(fitted[k], data, columns), f"{folder}/assignments")
        averages = {name: spec for name, spec in models.SEGMENT_AVERAGES.items() if spec[0] in data.columns}
        files.write_csv(models.cluster_profile(fitted[k].transform(data), averages, categorical), f"{folder}/profiles", single_file=True)
        tried = F.array_sort(F.collect_list(F.struct("k", "silhouette", "wssse")))
        used = F.struct(F.array(*map(F.lit, categorical)).alias("categorical"), F.array(*map(F.lit, numeric)).alias("numeric"))
        files.write_json(sweep.agg(F.lit(k).alias("best_k"), used.alias("features"), tried.alias("sweep")), f"{folder}/metrics", single_file=True)
        return {row["k"]: row["silhouette"] for row in sweep.collect()}


def assign(spark: SparkSession, df: DataFrame, folder: str, columns: Sequence[str] = models.ASSIGNMENT) -> DataFrame:
    """``df`` with the clusters of the saved model."""
    return models.assignments(files.load_model(f"{folder}/model"), df, columns)
