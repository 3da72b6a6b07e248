import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone.functions import cleaning as C
from marlstone.functions import fixed
from marlstone.operators import clean, features, profile


def values(spark, expr, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr("v").alias("o")).collect()]


def test_every_marker_is_missing(spark):
    markers = [m.upper() for m in fixed.MISSING_MARKERS] + ["  NA  ", "\tnull\n", None]
    assert values(spark, C.null_markers, markers) == [None] * len(markers)
    assert values(spark, C.is_missing_like, ["x", None, "?"]) == [False, True, True]
    assert values(spark, C.null_markers, [" Car "]) == ["Car"]


@pytest.mark.parametrize(
    "text, number",
    [
        ("12", 12.0), ("$1,234.5", 1234.5), ("12,5", 12.5), ("12,345", 12.345), ("1,234,567", 1234567.0),
        ("three", 3.0), ("Many", 8.0), ("multiple", 3.0), ("none", None), ("15 km/l", 15.0), ("300 km", 300.0),
        ("1600 cc", 1600.0), ("1.6L", 1.6), ("-40", -40.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("+7", 7.0),
        ("1.0d", None), ("1.5f", None), ("1_000", 1000.0), ("abc", None), ("", None), (None, None), ("1.2.3", None),
        ("inf", float("inf")), ("nan", None),
    ],
)
def test_numbers(spark, text, number):
    assert values(spark, C.parse_number, [text]) == [number]


def test_litres_and_thousands(spark):
    engine = lambda c: C.parse_number(c, litres_to_cc=True)
    assert values(spark, engine, ["1.6L", "2.0 l", "1600 cc", "12 l", "1600"]) == [1600.0, 2000.0, 1600.0, 12.0, 1600.0]
    assert values(spark, lambda c: C.parse_number(c, thousands=True), ["12,345", "12,5", "1,234,567"]) == [12345.0, 12.5, 1234567.0]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-03-05", (2024, 3, 5)), ("03/05/2024", (2024, 3, 5)), ("25/12/2023", (2023, 12, 25)),
        ("3-5-2024", (2024, 3, 5)), ("25.12.2023", (2023, 12, 25)), ("2024/3/5", (2024, 3, 5)), ("20240305", (2024, 3, 5)),
        ("5 Mar 2024", (2024, 3, 5)), ("March 5, 2024", (2024, 3, 5)), ("05-Mar-2024", (2024, 3, 5)), ("03/05/24", (2024, 3, 5)),
        ("2024-03-05 10:11:12", (2024, 3, 5)), ("2024-03-05T10:11:12Z", (2024, 3, 5)),
        ("1999-01-01", None), ("2031-01-01", None), ("2023-02-30", None), ("2024-03", None), ("unknown", None), (None, None),
    ],
)
def test_dates(spark, text, day):
    assert values(spark, C.parse_date, [text]) == [dt.date(*day) if day else None]


def test_categories(spark):
    assert values(spark, lambda c: C.map_category(c, fixed.OWNER_TYPES), ["1st", " First  Owner ", "4th", "NA"]) == ["First", "First", None, None]
    assert values(spark, C.map_condition, ["Worn__Out", "worn-out", "WORN OUT", "weak"]) == ["Worn Out"] * 3 + [None]
    assert values(spark, lambda c: C.map_condition(c, True), ["weak", "worn out"]) == ["Weak", None]
    assert values(spark, C.map_target, ["1", "1.0", "TRUE", "no", "maybe"]) == [1.0, None, 1.0, 0.0, None]


def test_audit_adds_up(spark, folder):
    from checks.views import view

    raw = view(spark, folder, "vehicles_duplicated")
    audit = clean.cleaning_audit(raw).first()
    assert audit["raw_rows"] == raw.count()
    assert audit["rows_after_dedup"] == audit["raw_rows"] - audit["duplicate_rows_removed"]
    assert audit["final_modeling_rows"] == audit["rows_after_dedup"] - audit["rows_with_missing_target_dropped"]
    assert clean.clean_vehicles(raw).count() == audit["final_modeling_rows"]
    metrics = {r["metric"]: r for r in profile.before_after(raw, clean.clean_vehicles(raw)).collect()}
    once = {r["metric"]: r for r in profile.cleaning_comparison(raw).collect()}
    assert once == metrics
    assert all(r["cleaned_dataset"] == 0 for n, r in {x["metric"]: x for x in profile.cleaning_comparison(raw.limit(0)).collect()}.items() if n != "Columns")
    assert metrics["Warranty earlier than last service"]["dirty_dataset"] > 0
    assert metrics["Warranty earlier than last service"]["cleaned_dataset"] == 0


def test_missing_columns_are_left_out(spark):
    df = spark.createDataFrame([("SUV", "yes")], "Vehicle_Model string, Need_Maintenance string")
    assert clean.typed_vehicles(df).first().asDict() == {"Vehicle_Model": "SUV", "Need_Maintenance": 1.0}


def test_bundles():
    sizes = {n: sum(map(len, b)) for n, b in features.bundles().items()}
    assert sizes == {"baseline_cleaned_lr": 19, "engineered_full_lr": 25, "leakage_aware_lr": 21}
    assert features.inference_columns(*features.bundles()["engineered_full_lr"])[1] == ["condition_score"]
    assert features.inference_columns(*features.bundles()["leakage_aware_lr"])[1] == []


def test_age_zero_and_missing_scores(spark):
    from marlstone.functions import features as X

    df = spark.createDataFrame([(10.0, 0.0, None, None, None), (10.0, 4.0, 1, None, 2)], "m double, a double, x int, y int, z int")
    rows = df.select(X.per_year("m", "a").alias("r"), X.sum_ignoring_null("x", "y", "z").alias("s"), X.expired_flag("x").alias("f")).collect()
    assert [(r.r, r.s, r.f) for r in rows] == [(None, None, 0.0), (2.5, 3, 0.0)]
    hours = spark.createDataFrame([(h,) for h in (4, 5, 11, 12, 16, 17, 20, 21, None)], "h int").select(X.day_part("h")).collect()
    assert [r[0] for r in hours] == ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night"]
    bands = spark.createDataFrame([(p,) for p in (0.4, 0.400001, 0.7, 0.71, None)], "p double").select(X.risk_band("p")).collect()
    assert [r[0] for r in bands] == ["Low", "Medium", "Medium", "High", None]
    assert F is not None


def test_formats_are_tried_only_on_texts_of_their_shape(spark):
    """What a date or number looks like decides first; results are those of trying every format."""
    from marlstone.functions import cleaning as C

    texts = ["2024-3-5", "02024-003-5", "+12024-03-05", "2024-13-5", "25-12-2023", "12-25-23", "31-31-23", "20240305", "+120240305",
             "20241305", "5-mar-2024", "5-march-2024", "mar-5-2024", "sept-5-2024", "30-2-2023", "2024-03", "", "-", "x", "1-1--2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    tried = F.coalesce(*[F.try_to_date("t", f) for f in C.DATE_FORMATS])
    plan = df.select(C.date_of(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("rlike") >= len(C.DATE_FORMATS)
    assert df.where(~C.date_of(F.col("t")).eqNullSafe(tried)).count() == 0
    numbers = [("12 km", 12.0), ("", None), ("km", None), ("1e1", 10.0), ("-40", -40.0), ("n/a", None), ("inf", float("inf"))]
    got = spark.createDataFrame([(t,) for t, _ in numbers], "t string").select("t", C.parse_number("t").alias("v")).collect()
    assert {r["t"]: r["v"] for r in got} == dict(numbers)
