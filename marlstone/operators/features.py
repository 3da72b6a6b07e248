"""Feature building on the cleaned vehicle table, and the three feature bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import features as X
from marlstone.operators import clean

# The columns of the feature bundles.
BASE_NUMERIC = (
    "mileage", "reported_issues", "vehicle_age", "engine_size", "odometer_reading", "insurance_premium",
    "service_history", "accident_history", "fuel_efficiency", "days_since_last_service", "days_to_warranty_expiry",
)
BASE_CATEGORICAL = (
    "vehicle_model", "maintenance_history", "fuel_type", "transmission_type", "owner_type",
    "tire_condition", "brake_condition", "battery_status",
)
ENGINEERED_NUMERIC = (
    "warranty_expired_flag", "mileage_per_year", "issues_per_year", "service_per_year", "accidents_per_year",
    "condition_score",
)
CONDITION_COLUMNS = ("tire_condition", "brake_condition", "battery_status", "condition_score")


def engineer_vehicles(df: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Day differences to the latest service date, rates per year of age and condition scores.

    With the raw table that ``df`` was cleaned from, the latest date is read from two of its columns, so
    that the cleaning runs once: duplicates do not change a maximum.
    """
    dates = df if raw is None else clean.typed_vehicles(
        raw.select("last_service_date", clean.VEHICLE_TARGET)
    ).filter(F.col(clean.VEHICLE_TARGET).isNotNull())
    latest = dates.agg(F.max("last_service_date")).scalar()
    df = df.withColumns(
        {
            "days_since_last_service": F.datediff(latest, "last_service_date"),
            "days_to_warranty_expiry": F.datediff("warranty_expiry_date", latest),
        }
    )
    return df.withColumns(
        {
            "warranty_expired_flag": X.expired_flag("days_to_warranty_expiry"),
            "mileage_per_year": X.per_year("mileage", "vehicle_age"),
            "issues_per_year": X.per_year("reported_issues", "vehicle_age"),
            "service_per_year": X.per_year("service_history", "vehicle_age"),
            "accidents_per_year": X.per_year("accident_history", "vehicle_age"),
            "tire_condition_score": X.wear_score("tire_condition"),
            "brake_condition_score": X.wear_score("brake_condition"),
            "battery_condition_score": X.battery_score("battery_status"),
        }
    ).withColumn(
        "condition_score",
        X.sum_ignoring_null("tire_condition_score", "brake_condition_score", "battery_condition_score"),
    )


def bundles() -> dict[str, tuple[list[str], list[str]]]:
    """Numeric and categorical columns of each bundle."""
    everything = [*BASE_NUMERIC, *ENGINEERED_NUMERIC]
    return {
        "baseline_cleaned_lr": (list(BASE_NUMERIC), list(BASE_CATEGORICAL)),
        "engineered_full_lr": (everything, list(BASE_CATEGORICAL)),
        "leakage_aware_lr": (
            [c for c in everything if c not in CONDITION_COLUMNS],
            [c for c in BASE_CATEGORICAL if c not in CONDITION_COLUMNS],
        ),
    }


def bundle(df: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The bundle's columns, the target and any further columns."""
    numeric, categorical = bundles()[name]
    return df.select(*keep, *numeric, *categorical, clean.VEHICLE_TARGET)


def bundle_summary(df: DataFrame) -> DataFrame:
    """Feature counts per bundle, by the data types of the table."""
    kinds = dict(df.dtypes)
    rows = []
    for name, (numeric, categorical) in bundles().items():
        columns = [*numeric, *categorical]
        text = sum(kinds[c] == "string" for c in columns)
        rows.append((name, len(columns), len(columns) - text, text))
    return df.sparkSession.createDataFrame(
        rows, "bundle string, raw_input_features int, numeric_features int, categorical_features int"
    )


def inference_columns(numeric: list[str], categorical: list[str]) -> tuple[list[str], list[str]]:
    """Drop the condition score where its three sources are present: it is their exact sum."""
    if set(CONDITION_COLUMNS) <= {*numeric, *categorical}:
        return [c for c in numeric if c != "condition_score"], ["condition_score"]
    return list(numeric), []


def class_means(df: DataFrame, columns: list[str], label: str = clean.VEHICLE_TARGET) -> DataFrame:
    """Means of columns per class, one row per column and one column per class (0 and 1)."""
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    return (
        means.unpivot([label], columns, "feature", "mean").groupBy("feature").pivot(label, [0, 1])
        .agg(F.first("mean")).select("feature", F.col("0").alias("class_0"), F.col("1").alias("class_1"))
    )
