"""Feature expressions: buckets, flags, rates, scores, bands and rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions import fixed
from marlstone.functions.cleaning import lookup


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy_round(c: Column | str, digits: int) -> Column:
    """Round half up after removing the last-bit noise of a distributed sum."""
    return F.round(F.round(_col(c), digits + 6), digits)


def day_part(hour: Column | str) -> Column:
    """Morning, afternoon, evening or night; a NULL hour is night."""
    hour = _col(hour)
    cases = [(hour.between(low, high), name) for name, low, high in fixed.DAY_PARTS]
    first, *rest = cases
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(*first)).otherwise("night")


def flag_unless(c: Column | str, neutral: str = "None") -> Column:
    """0 for the neutral category, 1 for every other value."""
    return F.when(_col(c) == neutral, 0).otherwise(1)


def fill_category(c: Column | str, value: str = "None") -> Column:
    return F.coalesce(_col(c), F.lit(value))


def cap(c: Column | str, top: float) -> Column:
    """Upper cap that keeps NULL."""
    c = _col(c)
    return F.when(c > top, F.lit(top)).otherwise(c)


def per_year(amount: Column | str, age: Column | str) -> Column:
    """Rate per year of age; age 0 gives NULL."""
    return F.try_divide(_col(amount).cast("double"), _col(age))


def expired_flag(days_left: Column | str) -> Column:
    """1.0 when the day count is negative; a missing count is 0.0."""
    return F.coalesce((_col(days_left) < 0).cast("double"), F.lit(0.0))


def sum_ignoring_null(*columns: Column | str) -> Column:
    """Row-wise sum over the values present; NULL when none is."""
    columns = [_col(c) for c in columns]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])
    return F.when(F.coalesce(*columns).isNotNull(), total)


def wear_score(c: Column | str) -> Column:
    return lookup(_col(c), fixed.WEAR_SCORES)


def battery_score(c: Column | str) -> Column:
    return lookup(_col(c), fixed.BATTERY_SCORES)


def risk_band(p: Column | str) -> Column:
    """Low up to 0.4, Medium up to 0.7, High above: the upper bound belongs to the band."""
    p = _col(p)
    (low, low_top), (medium, medium_top), (high, _) = fixed.RISK_BANDS
    return F.when(p <= low_top, low).when(p <= medium_top, medium).when(p.isNotNull(), high)


def at_threshold(p: Column | str, threshold: Column | float) -> Column:
    """0/1 prediction, 1 from the threshold upwards."""
    return (_col(p) >= threshold).cast("int")


def residual(actual: Column | str, predicted: Column | str, digits: int = 4) -> Column:
    return F.round(_col(actual) - _col(predicted), digits)


# The terms of the five polynomial models over x1..x6, in coefficient order after the
# intercept. Each entry: label and factors as (input, power).
POLYNOMIAL_MODELS: dict[str, list[tuple[str, list[tuple[str, int]]]]] = {
    "m1": [("x1^3", [("x1", 3)]), ("x2^2", [("x2", 2)]), ("x3^2", [("x3", 2)]),
           ("x4", [("x4", 1)]), ("x5", [("x5", 1)]), ("x6", [("x6", 1)])],
    "m2": [("x1^2", [("x1", 2)]), ("x2^2", [("x2", 2)]), ("x3^3", [("x3", 3)]),
           ("x4", [("x4", 1)]), ("x5", [("x5", 1)]), ("x6", [("x6", 1)])],
    "m3": [("x1", [("x1", 1)]), ("x2", [("x2", 1)]), ("x3", [("x3", 1)]),
           ("x4^2", [("x4", 2)]), ("x5", [("x5", 1)]), ("x6^2", [("x6", 2)])],
    "m4": [(f"x{i}^2", [(f"x{i}", 2)]) for i in range(1, 7)],
    "m5": [(f"x{i}", [(f"x{i}", 1)]) for i in range(1, 7)]
    + [("x1*x2", [("x1", 1), ("x2", 1)]), ("x3*x4", [("x3", 1), ("x4", 1)]),
       ("x2*x6", [("x2", 1), ("x6", 1)])],
}


def polynomial_terms(model: str) -> list[tuple[str, Column]]:
    """``(label, expression)`` of the design columns, the intercept first."""

    def power(name: str, k: int) -> Column:
        return reduce(lambda a, b: a * b, [F.col(name).cast("double")] * k)

    terms = [("1", F.lit(1.0))]
    for label, factors in POLYNOMIAL_MODELS[model]:
        terms.append((label, reduce(lambda a, b: a * b, [power(n, k) for n, k in factors])))
    return terms
