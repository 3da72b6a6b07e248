"""The glucose job: impute, fit five models, select, and sample around the chosen one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.operators import explore, split, stats
from marlstone.sources import files

# The input columns and the response, by position.
NAMES = ("bg_mean", "insulin_sum", "carbs_sum", "hr_mean", "steps_sum", "cals_sum", "bg_plus_1h")
MODEL_NAMES = ("x1", "x2", "x3", "x4", "x5", "x6", "y")


def load(spark: SparkSession, path: str) -> DataFrame:
    """The measurements with model names, medians filled in."""
    schema = ", ".join(f"{n} double" for n in NAMES)
    df = files.read_renamed_csv(spark, path, schema, MODEL_NAMES)
    return explore.fill_medians(df, MODEL_NAMES)


def select(df: DataFrame) -> DataFrame:
    """RSS, likelihood, AIC and BIC of the five models."""
    return stats.selection_table(df.sparkSession, stats.fit_all(df))


def holdout(df: DataFrame, key: str, model: str = "m5", seed: int | str = 123) -> tuple[DataFrame, stats.Fit]:
    """Fit on 70%, intervals for the other 30%; the same split serves the sampling."""
    marked = split.hashed_split(df, key, 0.7, seed)
    fitted = stats.fit(marked.filter("data_split = 'train'"), model)
    return stats.prediction_interval(marked.filter("data_split = 'test'"), fitted), fitted
