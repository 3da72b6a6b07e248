"""The vehicle job: clean, engineer, and evaluate the three feature bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marlstone.operators import clean, features, models


def prepare(raw: DataFrame) -> DataFrame:
    return features.engineer_vehicles(clean.clean_vehicles(raw), raw)


def evaluate(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """Metrics, tuned summary and risk bands of all bundles."""
    measured = bands = None
    for name in features.bundles():
        result = models.evaluate_bundle(models.prepare_bundle(df, name, key))
        measured = result["metrics"] if measured is None else measured.unionByName(result["metrics"])
        bands = result["risk_bands"] if bands is None else bands.unionByName(result["risk_bands"])
    return {"metrics": measured, "summary": models.tuned_summary(measured), "risk_bands": bands}
