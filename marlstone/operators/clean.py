"""Cleaning of dirty tables, with an audit of what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import cleaning as C
from marlstone.functions import features as X
from marlstone.functions import fixed

VEHICLE_CATEGORIES = {
    "vehicle_model": fixed.VEHICLE_MODELS,
    "maintenance_history": fixed.MAINTENANCE_HISTORIES,
    "fuel_type": fixed.FUEL_TYPES,
    "transmission_type": fixed.TRANSMISSIONS,
    "owner_type": fixed.OWNER_TYPES,
}
VEHICLE_CONDITIONS = {"tire_condition": False, "brake_condition": False, "battery_status": True}
VEHICLE_DATES = ("last_service_date", "warranty_expiry_date")
VEHICLE_TARGET = "need_maintenance"


def typed_vehicles(raw: DataFrame, thousands: bool = False) -> DataFrame:
    """Column-wise cleaning, before the cross-field date rule; absent columns are left out.

    Numbers and dates are built in steps (text, value, range), so that each step's value is
    computed once however often the next step uses it.
    """
    have = {c.lower(): c for c in raw.columns}
    names = lambda wanted: [have[c] for c in wanted if c in have]
    numbers, dates = names(fixed.VALID_RANGES), names(VEHICLE_DATES)
    step: dict[str, Column] = {}
    for c in names(VEHICLE_CATEGORIES):
        step[c] = C.map_category(c, VEHICLE_CATEGORIES[c.lower()])
    for c in names(VEHICLE_CONDITIONS):
        step[c] = C.map_condition(c, weak_allowed=VEHICLE_CONDITIONS[c.lower()])
    for c in names([VEHICLE_TARGET]):
        step[c] = C.map_target(c)
    step |= {c: C.lower_text(c) for c in numbers} | {c: C.date_text(c) for c in dates}
    values = {c: C.number_of(F.col(c), c.lower() == "engine_size", thousands) for c in numbers}
    values |= {c: C.date_of(F.col(c)) for c in dates}
    ranged = {c: C.within(c, *fixed.VALID_RANGES[c.lower()]) for c in numbers}
    ranged |= {c: C.within_years(F.col(c)) for c in dates}
    return raw.withColumns(step).withColumns(values).withColumns(ranged)


def clean_vehicles(raw: DataFrame, thousands: bool = False) -> DataFrame:
    """Deduplicated, typed rows with a known target; expiry dates before service are NULL."""
    typed = typed_vehicles(raw.dropDuplicates(), thousands)
    service, expiry = VEHICLE_DATES
    typed = typed.withColumn(expiry, C.drop_expiry_before_service(expiry, service))
    return typed.dropna(subset=[VEHICLE_TARGET]).withColumn(VEHICLE_TARGET, F.col(VEHICLE_TARGET).cast("int"))


def cleaning_audit(raw: DataFrame, thousands: bool = False) -> DataFrame:
    """Six counters of the cleaning, in one pass over the rows grouped into distinct ones."""
    distinct = raw.groupBy(*raw.columns).agg(F.count("*").alias("_copies"))
    typed = typed_vehicles(distinct, thousands)
    service, expiry = VEHICLE_DATES
    no_target = F.col(VEHICLE_TARGET).isNull()
    wrong_order = F.coalesce(F.col(expiry) < F.col(service), F.lit(False))
    return typed.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("raw_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows_removed"),
        F.count("*").alias("rows_after_dedup"),
        F.count_if(no_target).alias("rows_with_missing_target_dropped"),
        F.count_if(~no_target).alias("final_modeling_rows"),
        F.count_if(wrong_order).alias("date_inconsistencies_fixed"),
    )


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed; NULL equals NULL."""
    return df.dropDuplicates()


def keep_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in each of the chosen columns."""
    return df.dropna(subset=columns)


def clean_accidents(
    df: DataFrame,
    medians: list[str] | None = None,
    modes: list[str] | None = None,
    approximate: bool = True,
) -> DataFrame:
    """Fill festival, medians and modes; keep risk scores in [0, 1]; cap casualties at 5.

    The medians and modes are learned from ``df`` itself; for models fit them on the training
    rows with :func:`marlstone.operators.explore.fit_fills` instead.
    """
    from marlstone.operators import explore

    df = df.withColumn("festival", X.fill_category("festival"))
    have = set(df.columns)
    medians = [c for c in (medians or ["temperature", "lanes", "vehicles_involved", "casualties", "risk_score"]) if c in have]
    modes = [c for c in (modes or ["weather", "visibility", "traffic_density", "road_type"]) if c in have]
    df = explore.fill_medians(df, medians, approximate=approximate)
    df = explore.fill_modes(df, modes)
    return df.filter(F.col("risk_score").between(0.0, 1.0)).withColumn("casualties", X.cap("casualties", 5))


def engineer_accidents(df: DataFrame) -> DataFrame:
    """Calendar parts (when ``date`` is present), day part and festival flag."""
    if "date" in df.columns:
        df = df.withColumns(C.iso_date_parts("date"))
    return df.withColumns({"hour_bin": X.day_part("hour"), "is_festival": X.flag_unless("festival")})
