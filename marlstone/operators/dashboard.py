"""Dashboard extracts: the aggregate tables behind the sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column order of the heatmap, metrics and classes of the sheets.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
OVERALL_METRICS = ("accuracy", "weighted_f1", "weighted_precision", "weighted_recall")
SEVERITIES = ("fatal", "major", "minor")


def cause_severity(df: DataFrame) -> DataFrame:
    return df.groupBy("cause", "accident_severity").agg(F.count("*").alias("accidents"))


def city_severity(df: DataFrame) -> DataFrame:
    return df.groupBy("city", "accident_severity").agg(F.count("*").alias("accidents"))


def hotspot_points(df: DataFrame) -> DataFrame:
    """Mean position per accident and severity."""
    return df.groupBy("accident_id", "accident_severity").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    )


def hotspot_grid(df: DataFrame, digits: int = 2) -> DataFrame:
    """Accidents per rounded position and severity: the map for tables too large to plot row by row."""
    return df.groupBy(
        F.round("latitude", digits).alias("latitude"), F.round("longitude", digits).alias("longitude"), "accident_severity"
    ).agg(F.count("*").alias("accidents"))


def hour_day_heatmap(df: DataFrame) -> DataFrame:
    """One row per hour, one column per weekday."""
    counts = df.groupBy("hour").pivot("day_of_week", list(WEEKDAYS)).agg(F.count(F.lit(1)))
    return counts.na.fill(0, list(WEEKDAYS))


def class_metrics(per_class: DataFrame, names: Sequence[str] = SEVERITIES, label: str = "label") -> DataFrame:
    """Precision, recall and F1 of the chosen classes as (severity, metric, value)."""
    chosen = per_class.filter(F.col(label).isin(*names)).select(F.col(label).alias("severity"), "f1", "precision", "recall")
    return chosen.unpivot(["severity"], ["f1", "precision", "recall"], "metric", "value")


def overall_metrics(metric_table: DataFrame, names: Sequence[str] = OVERALL_METRICS) -> DataFrame:
    return metric_table.filter(F.col("metric").isin(*names)).select("metric", "value")


def scatter_bins(df: DataFrame, x: str, y: str, cluster: str, step_x: float, step_y: float) -> DataFrame:
    """Rows per cluster and cell of a scatter plot."""
    cell = lambda c, step: (F.floor(F.col(c) / step) * step).cast("double").alias(c)
    return df.groupBy(cluster, cell(x, step_x), cell(y, step_y)).agg(F.count("*").alias("n"))


def risk_by_cluster(profile: DataFrame, cluster: str = "cluster") -> DataFrame:
    return profile.select(cluster, "avg_risk_score")
