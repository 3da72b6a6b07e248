"""Quality profiles. Every table is one aggregate, turned from columns to rows afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import cleaning as C
from marlstone.functions import fixed
from marlstone.operators import clean


def long_form(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row table of equally typed columns as (name, value) rows."""
    return one_row.unpivot([], one_row.columns, name, value)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, most frequent first, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc(column))


def top_labels(df: DataFrame, column: str, n: int = 12) -> DataFrame:
    """The ``n`` most frequent raw labels; NULL counts as the label ``nan``."""
    label = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    return (
        df.groupBy(label.alias(column)).agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc(column)).limit(n)
    )


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))


def type_tally(df: DataFrame) -> DataFrame:
    """Number of columns per data type, from the schema."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    return df.sparkSession.createDataFrame(sorted(kinds.items()), "data_type string, columns bigint")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column in one pass."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return long_form(row, "column", "nulls")


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL-or-marker count of every column, largest first."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(C.is_missing_like(c)).alias(c) for c in columns])
    return long_form(row, "column", "missing_like").orderBy(F.desc("missing_like"), "column")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column."""
    row = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return long_form(row, "column", "s").select("column", "s.*")


def overview(raw: DataFrame, target: str = clean.VEHICLE_TARGET) -> DataFrame:
    """Rows, columns, exact duplicate rows and missing-like targets."""
    grouped = raw.groupBy(*raw.columns).agg(F.count("*").alias("_copies"))
    row = grouped.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows"),
        F.lit(len(raw.columns)).cast("bigint").alias("columns"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("exact_duplicate_rows"),
        F.coalesce(F.sum(F.when(C.is_missing_like(target), F.col("_copies"))), F.lit(0))
        .cast("bigint").alias("missing_like_targets"),
    )
    return long_form(row, "metric", "value")


def distinct_labels(df: DataFrame, columns: Sequence[str], null_label: str | None = None) -> DataFrame:
    """Distinct labels per column; ``null_label`` makes NULL one more label."""

    def text(c):
        value = F.col(c).cast("string")
        return (F.coalesce(value, F.lit(null_label)) if null_label is not None else value).alias(c)

    long = df.select(*[text(c) for c in columns]).unpivot([], list(columns), "column", "label")
    seen = long.groupBy("column", "label").agg(F.lit(1).alias("one"))
    return seen.groupBy("column").agg(F.count("label").alias("labels"))


def label_comparison(raw: DataFrame, cleaned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct labels before and after cleaning; before, NULL is a label."""
    before = distinct_labels(raw, columns, "nan").withColumnRenamed("labels", "dirty_unique_labels")
    after = distinct_labels(cleaned, columns).withColumnRenamed("labels", "clean_unique_labels")
    return before.join(after, "column", "left").orderBy(F.desc("dirty_unique_labels"), "column")


def numeric_quality(raw: DataFrame, cleaned: DataFrame, thousands: bool = False) -> DataFrame:
    """Unparsed and out-of-range numbers per column, before and after cleaning."""
    names = [c for c in fixed.VALID_RANGES if c in {x.lower() for x in raw.columns}]

    def counts(df, parse, prefix):
        if parse:
            df = df.select(*[C.lower_text(c).alias(c) for c in names])
            df = df.select(*[C.number_of(F.col(c), c == "engine_size", thousands).alias(c) for c in names])
        out = []
        for c in names:
            low, high = fixed.VALID_RANGES[c]
            v = F.col(c)
            out.append(
                F.struct(
                    F.count_if(v.isNull()).alias(f"{prefix[0]}"),
                    F.count_if((v < low) | (v > high)).alias(f"{prefix[1]}"),
                ).alias(c)
            )
        return long_form(df.agg(*out), "column", "s").select("column", "s.*")

    before = counts(raw, True, ("dirty_missing_or_unparsed", "dirty_out_of_range"))
    after = counts(cleaned, False, ("clean_missing_after_rules", "clean_out_of_range"))
    return before.join(after, "column")


def _parsed_dates(raw: DataFrame) -> DataFrame:
    """The date columns parsed, step by step as in the cleaning."""
    names = clean.VEHICLE_DATES
    df = raw.select(*[C.date_text(c).alias(c) for c in names])
    df = df.select(*[C.date_of(F.col(c)).alias(c) for c in names])
    return df.select(*[C.within_years(F.col(c)).alias(c) for c in names])


def date_quality(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Missing or invalid dates per column, before and after cleaning."""
    before = _parsed_dates(raw).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in clean.VEHICLE_DATES])
    after = cleaned.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in clean.VEHICLE_DATES])
    return long_form(before, "column", "dirty_missing_or_invalid").join(
        long_form(after, "column", "clean_missing_after_rules"), "column"
    )


def date_order(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Pairs whose expiry lies before the service, before and after cleaning."""
    service, expiry = clean.VEHICLE_DATES
    before = _parsed_dates(raw).agg(F.count_if(F.col(expiry) < F.col(service)).alias("n"))
    after = cleaned.agg(F.count_if(F.col(expiry) < F.col(service)).alias("n"))
    return before.select(
        F.col("n").alias("dirty_inconsistent"), after.scalar().alias("clean_inconsistent")
    )


def before_after(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Five metrics of the dirty and the cleaned table, side by side."""
    def measure(df, missing, name, wrong):
        grouped = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
        absent = F.coalesce(F.sum(F.when(missing, F.col("_copies"))), F.lit(0)).cast("bigint")
        row = grouped.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("Rows"),
            F.lit(len(df.columns)).cast("bigint").alias("Columns"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("Exact duplicate rows"),
            absent.alias("Rows with missing/invalid target"),
        ).withColumn("Warranty earlier than last service", wrong)
        return long_form(row, "metric", name)

    wrong = date_order(raw, cleaned).select(F.struct("*")).scalar()
    dirty = measure(raw, C.is_missing_like(clean.VEHICLE_TARGET), "dirty_dataset", wrong["dirty_inconsistent"])
    tidy = measure(cleaned, F.col(clean.VEHICLE_TARGET).isNull(), "cleaned_dataset", wrong["clean_inconsistent"])
    return dirty.join(tidy, "metric")


def cleaning_comparison(raw: DataFrame, thousands: bool = False) -> DataFrame:
    """:func:`before_after` of a table and its cleaned form, with one scan and one cleaning.

    Rows are grouped into distinct ones, cleaned, and grouped again, as different rows may be cleaned to the same.
    """
    service, expiry = clean.VEHICLE_DATES
    late = F.coalesce(F.col(expiry) < F.col(service), F.lit(False))
    distinct = raw.groupBy(*raw.columns).agg(F.count("*").alias("_copies"))
    typed = clean.typed_vehicles(distinct.withColumn("_absent", C.is_missing_like(clean.VEHICLE_TARGET)), thousands)
    tidy = typed.withColumn("_late", late).withColumn(expiry, C.drop_expiry_before_service(expiry, service))
    copies = F.col("_copies")
    same = tidy.groupBy(*raw.columns).agg(
        F.count("*").alias("_rows"), F.sum(copies).alias("_raw"), F.sum(copies - 1).alias("_again"),
        F.sum(F.when(F.col("_absent"), copies)).alias("_absent"), F.sum(F.when(F.col("_late"), copies)).alias("_late"),
    )
    has_target, rows = F.col(clean.VEHICLE_TARGET).isNotNull(), F.col("_rows")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    width = F.lit(len(raw.columns)).cast("bigint")
    measures = {
        "Rows": (total("_raw"), total(F.when(has_target, rows))),
        "Columns": (width, width),
        "Exact duplicate rows": (total("_again"), total(F.when(has_target, rows - 1))),
        "Rows with missing/invalid target": (total("_absent"), F.lit(0).cast("bigint")),
        "Warranty earlier than last service": (total("_late"), total(F.when(has_target & late, rows))),
    }
    row = same.agg(F.array(*[
        F.struct(F.lit(name).alias("metric"), before.alias("dirty_dataset"), after.alias("cleaned_dataset"))
        for name, (before, after) in measures.items()
    ]).alias("m"))
    return row.select(F.inline("m"))
