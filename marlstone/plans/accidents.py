"""The accident job: load, clean, engineer, then the dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.operators import clean, dashboard, explore
from marlstone.sources import files


def prepare(spark: SparkSession, path: str, approximate: bool = True) -> DataFrame:
    """The cleaned and engineered accident table of a CSV file."""
    raw = files.read_csv(spark, path, files.ACCIDENTS)
    return clean.engineer_accidents(clean.clean_accidents(raw, approximate=approximate))


def dashboard_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The exploration extracts by name; each is one aggregate over the prepared table."""
    return {
        "eda_city_severity": explore.grouped_summary(df, **explore.SUMMARIES["hotspots"]),
        "eda_hour_dow": explore.grouped_summary(df, **explore.SUMMARIES["day_hour"]),
        "eda_cause_severity": explore.grouped_summary(df, **explore.SUMMARIES["cause_severity"]),
        "hour_day_heatmap": dashboard.hour_day_heatmap(df),
        "city_severity": dashboard.city_severity(df),
        "risk_by_severity": explore.grouped_summary(df, **explore.SUMMARIES["risk_by_severity"]),
    }
