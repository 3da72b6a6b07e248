"""Cleaning, profiling and feature building on the dirty vehicle view."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as q
from checks.views import view, with_views
from marlstone.functions import cleaning as C
from marlstone.functions import fixed
from marlstone.operators import clean, explore, features, profile

RAW = "vehicles_duplicated"


def raw(spark, d):
    return view(spark, d, RAW)


def cleaned(spark, d):
    return clean.clean_vehicles(raw(spark, d))


def engineered(spark, d):
    return features.engineer_vehicles(cleaned(spark, d), raw(spark, d))


def _bundle_of(spark, d, name):
    df = features.bundle(engineered(spark, d), name, ("vid",))
    days = [c for c in ("days_since_last_service", "days_to_warranty_expiry", "condition_score") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("double") for c in days})


def _text_dates(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in clean.VEHICLE_DATES})


def _one(name, expr, alias):
    return lambda spark, d: view(spark, d, "vehicles").select("vid", expr(name).alias(alias))


def _one_sql(sql, alias):
    return with_views(f"SELECT vid, {sql} AS {alias} FROM vehicles", "vehicles")


CATEGORICAL = [*clean.VEHICLE_CATEGORIES, *clean.VEHICLE_CONDITIONS]
DATES_SQL = "strftime(last_service_date, '%Y-%m-%d') AS last_service_date, strftime(warranty_expiry_date, '%Y-%m-%d') AS warranty_expiry_date"
NUM = list(fixed.VALID_RANGES)

QUERIES = {
    "t1_null_markers": _one("vehicle_model", C.null_markers, "v"),
    "t2_collapse_space": _one("vehicle_model", C.collapse_space, "v"),
    "t3_vehicle_model": _one("vehicle_model", lambda c: C.map_category(c, fixed.VEHICLE_MODELS), "v"),
    "t4_maintenance_history": _one("maintenance_history", lambda c: C.map_category(c, fixed.MAINTENANCE_HISTORIES), "v"),
    "t5_fuel_type": _one("fuel_type", lambda c: C.map_category(c, fixed.FUEL_TYPES), "v"),
    "t6_transmission": _one("transmission_type", lambda c: C.map_category(c, fixed.TRANSMISSIONS), "v"),
    "t7_owner_type": _one("owner_type", lambda c: C.map_category(c, fixed.OWNER_TYPES), "v"),
    "t8_conditions": lambda s, d: view(s, d, "vehicles").select(
        "vid", C.map_condition("tire_condition").alias("tire"), C.map_condition("battery_status", True).alias("battery")
    ),
    "t9_target": _one("need_maintenance", C.map_target, "v"),
    "t10_numbers": lambda s, d: view(s, d, "vehicles").select(
        "vid", *[C.parse_number(c, c == "engine_size").alias(c) for c in NUM]
    ),
    "t11_dates": lambda s, d: view(s, d, "vehicles").select(
        "vid", *[F.date_format(C.parse_date(c), "yyyy-MM-dd").alias(c) for c in clean.VEHICLE_DATES]
    ),
    "pf7_valid_ranges": lambda s, d: clean.typed_vehicles(view(s, d, "vehicles")).select("vid", *NUM),
    "pf8_pf9_st1_clean_vehicles": lambda s, d: _text_dates(cleaned(s, d)),
    "ag22_cleaning_audit": lambda s, d: clean.cleaning_audit(raw(s, d)),
    "st1_remove_duplicates": lambda s, d: clean.remove_duplicates(raw(s, d)),
    "ag15_overview": lambda s, d: profile.overview(raw(s, d)),
    "ag16_missing_counts": lambda s, d: profile.missing_counts(raw(s, d).drop("vid")),
    "ag17_top_labels": lambda s, d: profile.top_labels(raw(s, d), "fuel_type", 12),
    "ag18_label_comparison": lambda s, d: profile.label_comparison(raw(s, d), cleaned(s, d), CATEGORICAL),
    "ag19_numeric_quality": lambda s, d: profile.numeric_quality(raw(s, d), cleaned(s, d)),
    "ag20_date_quality": lambda s, d: profile.date_quality(raw(s, d), cleaned(s, d)),
    "ag20_date_order": lambda s, d: profile.date_order(raw(s, d), cleaned(s, d)),
    "ag21_before_after": lambda s, d: profile.cleaning_comparison(raw(s, d)),
    "ag23_t13_t16_engineered": lambda s, d: _text_dates(engineered(s, d)).drop(
        "tire_condition_score", "brake_condition_score", "battery_condition_score"
    ).withColumns({c: F.col(c).cast("double") for c in ("condition_score", "days_since_last_service", "days_to_warranty_expiry")}),
    "ag24_class_means": lambda s, d: features.class_means(
        engineered(s, d), [*features.ENGINEERED_NUMERIC]
    ).select("feature", *[F.round(c, 6).alias(c) for c in ("class_0", "class_1")]),
    "pf12_leakage_aware_bundle": lambda s, d: _bundle_of(s, d, "leakage_aware_lr"),
    "pf12_engineered_bundle": lambda s, d: _bundle_of(s, d, "engineered_full_lr"),
    "pf12_baseline_bundle": lambda s, d: _bundle_of(s, d, "baseline_cleaned_lr"),
    "pf13_drop_constant": lambda s, d: explore.drop_constant(
        engineered(s, d).select("vid", "fuel_type", "vehicle_age", F.lit("x").alias("constant"), F.lit(None).cast("int").alias("empty"))
    ),
    "pf23_complete_cases": lambda s, d: clean.keep_complete(
        cleaned(s, d).select("vid", "fuel_type", "mileage"), ["fuel_type", "mileage"]
    ),
    "ag11_exact_median_imputation": lambda s, d: explore.fill_medians(
        cleaned(s, d).select("vid", *NUM), NUM
    ),
    "ag35_bundle_summary": lambda s, d: features.bundle_summary(engineered(s, d)),
}

_typed = q.TEXTS
PARSED = q.parsed_cte(RAW)


def _vehicle_sql(select: str, *ctes: str) -> str:
    return with_views(select, RAW, extra=", ".join(ctes) if ctes else "")


def _unpivot(pairs, name, value, source, cast="BIGINT"):
    return " UNION ALL ".join(f"SELECT '{n}' AS \"{name}\", CAST({sql} AS {cast}) AS {value} FROM {source}" for n, sql in pairs)


_all = ["vehicle_model", "maintenance_history", "fuel_type", "transmission_type", "owner_type", "tire_condition",
        "brake_condition", "battery_status", "mileage", "reported_issues", "vehicle_age", "engine_size",
        "odometer_reading", "insurance_premium", "service_history", "accident_history", "fuel_efficiency",
        "last_service_date", "warranty_expiry_date", "need_maintenance"]
_whole = [*features.BASE_NUMERIC, *features.ENGINEERED_NUMERIC, *features.BASE_CATEGORICAL]
_bundle = [c for c in [*features.BASE_NUMERIC, *features.ENGINEERED_NUMERIC, *features.BASE_CATEGORICAL]
           if c not in ("tire_condition", "brake_condition", "battery_status", "condition_score")]


def _quality_rows():
    parts = []
    for c in NUM:
        low, high = fixed.VALID_RANGES[c]
        parts.append(
            f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM parsed WHERE {c} IS NULL) AS dirty_missing_or_unparsed, "
            f"(SELECT count(*) FROM parsed WHERE {c} < {low} OR {c} > {high}) AS dirty_out_of_range, "
            f"(SELECT count(*) FROM cleaned WHERE {c} IS NULL) AS clean_missing_after_rules, "
            f"(SELECT count(*) FROM cleaned WHERE {c} < {low} OR {c} > {high}) AS clean_out_of_range"
        )
    return " UNION ALL ".join(parts)


ORACLES = {
    "t1_null_markers": _one_sql(q.null_markers("vehicle_model"), "v"),
    "t2_collapse_space": _one_sql(q.collapse("vehicle_model"), "v"),
    "t3_vehicle_model": _one_sql(_typed["vehicle_model"], "v"),
    "t4_maintenance_history": _one_sql(_typed["maintenance_history"], "v"),
    "t5_fuel_type": _one_sql(_typed["fuel_type"], "v"),
    "t6_transmission": _one_sql(_typed["transmission_type"], "v"),
    "t7_owner_type": _one_sql(_typed["owner_type"], "v"),
    "t8_conditions": with_views(
        f"SELECT vid, {_typed['tire_condition']} AS tire, {_typed['battery_status']} AS battery FROM vehicles", "vehicles"
    ),
    "t9_target": _one_sql(_typed["need_maintenance"], "v"),
    "t10_numbers": with_views(
        f"SELECT vid, {', '.join(NUM)} FROM parsed", "vehicles", extra=q.parsed_cte("vehicles")
    ),
    "t11_dates": with_views(
        "SELECT vid, " + ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in clean.VEHICLE_DATES) + " FROM parsed",
        "vehicles", extra=q.parsed_cte("vehicles"),
    ),
    "pf7_valid_ranges": with_views(f"SELECT vid, {', '.join(NUM)} FROM typed", "vehicles", extra=q.typed_cte("vehicles")),
    "pf8_pf9_st1_clean_vehicles": _vehicle_sql(f"SELECT * REPLACE ({DATES_SQL}) FROM cleaned", q.CLEANED),
    "ag22_cleaning_audit": _vehicle_sql(
        "SELECT (SELECT count(*) FROM vehicles_duplicated) AS raw_rows, "
        "(SELECT count(*) FROM vehicles_duplicated) - (SELECT count(*) FROM distinct_rows) AS duplicate_rows_removed, "
        "count(*) AS rows_after_dedup, count(*) FILTER (need_maintenance IS NULL) AS rows_with_missing_target_dropped, "
        "count(*) FILTER (need_maintenance IS NOT NULL) AS final_modeling_rows, "
        "count(*) FILTER (warranty_expiry_date < last_service_date) AS date_inconsistencies_fixed FROM typed", q.CLEANED
    ),
    "st1_remove_duplicates": _vehicle_sql("SELECT DISTINCT * FROM vehicles_duplicated"),
    "ag15_overview": _vehicle_sql(
        _unpivot(
            [("rows", "count(*)"), ("columns", "21"),
             ("exact_duplicate_rows", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM vehicles_duplicated))"),
             ("missing_like_targets", f"count(*) FILTER ({q.missing('need_maintenance')})")],
            "metric", "value", "vehicles_duplicated",
        ).replace("CAST(21 AS BIGINT) AS value FROM vehicles_duplicated", "CAST(21 AS BIGINT) AS value")
    ),
    "ag16_missing_counts": _vehicle_sql(
        _unpivot([(c, f"count(*) FILTER ({q.missing(c)})") for c in _all], "column", "missing_like", "vehicles_duplicated")
    ),
    "ag17_top_labels": _vehicle_sql(
        "SELECT coalesce(fuel_type, 'nan') AS fuel_type, count(*) AS count FROM vehicles_duplicated GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 12"
    ),
    "ag18_label_comparison": _vehicle_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", (SELECT count(DISTINCT coalesce({c}, 'nan')) FROM vehicles_duplicated) AS dirty_unique_labels, "
            f"(SELECT count(DISTINCT {c}) FROM cleaned) AS clean_unique_labels" for c in CATEGORICAL
        ), q.CLEANED
    ),
    "ag19_numeric_quality": _vehicle_sql(_quality_rows(), q.CLEANED, PARSED),
    "ag20_date_quality": _vehicle_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM parsed WHERE {c} IS NULL) AS dirty_missing_or_invalid, "
            f"(SELECT count(*) FROM cleaned WHERE {c} IS NULL) AS clean_missing_after_rules" for c in clean.VEHICLE_DATES
        ), q.CLEANED, PARSED
    ),
    "ag20_date_order": _vehicle_sql(
        f"SELECT (SELECT count(*) FROM parsed WHERE warranty_expiry_date < last_service_date) AS dirty_inconsistent, "
        "(SELECT count(*) FROM cleaned WHERE warranty_expiry_date < last_service_date) AS clean_inconsistent", q.CLEANED, PARSED
    ),
    "ag21_before_after": _vehicle_sql(
        "SELECT 'Rows' AS metric, (SELECT count(*) FROM vehicles_duplicated) AS dirty_dataset, (SELECT count(*) FROM cleaned) AS cleaned_dataset "
        "UNION ALL SELECT 'Columns', 21, 21 UNION ALL SELECT 'Exact duplicate rows', (SELECT count(*) FROM vehicles_duplicated) - (SELECT count(*) FROM distinct_rows), "
        "(SELECT count(*) - count(DISTINCT c) FROM cleaned c) "
        f"UNION ALL SELECT 'Rows with missing/invalid target', (SELECT count(*) FROM vehicles_duplicated WHERE {q.missing('need_maintenance')}), 0 "
        f"UNION ALL SELECT 'Warranty earlier than last service', (SELECT count(*) FROM parsed WHERE warranty_expiry_date < last_service_date), "
        "(SELECT count(*) FROM cleaned WHERE warranty_expiry_date < last_service_date)", q.CLEANED, PARSED
    ),
    "ag23_t13_t16_engineered": _vehicle_sql(f"SELECT * EXCLUDE (ts, bs, ws) REPLACE ({DATES_SQL}) FROM engineered", q.ENGINEERED),
    "ag24_class_means": _vehicle_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}) FILTER (need_maintenance = 0), 6) AS class_0, "
            f"round(avg({c}) FILTER (need_maintenance = 1), 6) AS class_1 FROM engineered" for c in features.ENGINEERED_NUMERIC
        ), q.ENGINEERED
    ),
    "pf12_leakage_aware_bundle": _vehicle_sql(f"SELECT vid, {', '.join(_bundle)}, need_maintenance FROM engineered", q.ENGINEERED),
    "pf12_engineered_bundle": _vehicle_sql(f"SELECT vid, {', '.join(_whole)}, need_maintenance FROM engineered", q.ENGINEERED),
    "pf12_baseline_bundle": _vehicle_sql(
        f"SELECT vid, {', '.join([*features.BASE_NUMERIC, *features.BASE_CATEGORICAL])}, need_maintenance FROM engineered", q.ENGINEERED
    ),
    "pf13_drop_constant": _vehicle_sql("SELECT vid, fuel_type, vehicle_age FROM cleaned", q.CLEANED),
    "pf23_complete_cases": _vehicle_sql(
        "SELECT vid, fuel_type, mileage FROM cleaned WHERE fuel_type IS NOT NULL AND mileage IS NOT NULL", q.CLEANED
    ),
    "ag11_exact_median_imputation": _vehicle_sql(
        "SELECT vid, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM cleaned)) AS {c}" for c in NUM) + " FROM cleaned", q.CLEANED
    ),
}
