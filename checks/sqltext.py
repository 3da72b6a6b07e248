"""SQL spellings of the cleaning rules, for the checks."""

from __future__ import annotations

from marlstone.functions import fixed

MARKERS = ", ".join(f"'{m}'" for m in fixed.MISSING_MARKERS)


def d(expr: str, digits: int) -> str:
    """Half-up rounding of a double through a decimal."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(30, {digits + 6})), {digits}) AS DOUBLE)"


def missing(c: str) -> str:
    return f"({c} IS NULL OR lower(trim({c})) IN ({MARKERS}))"


def null_markers(c: str) -> str:
    return f"CASE WHEN {missing(c)} THEN NULL ELSE trim({c}) END"


def _case(expr: str, mapping: dict, quote: bool = True) -> str:
    whens = " ".join(f"WHEN '{k}' THEN " + (f"'{v}'" if quote else f"CAST({v} AS DOUBLE)") for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def collapse(expr: str) -> str:
    return f"lower(trim(regexp_replace({expr}, '\\s+', ' ', 'g')))"


def category(c: str, mapping: dict) -> str:
    return _case(collapse(null_markers(c)), mapping)


def condition(c: str, weak: bool = False) -> str:
    vocabulary = fixed.BATTERY_CONDITIONS if weak else fixed.WEAR_CONDITIONS
    return _case(collapse(f"regexp_replace({null_markers(c)}, '[_-]+', ' ', 'g')"), vocabulary)


def target(c: str) -> str:
    return _case(f"lower({null_markers(c)})", fixed.TARGET_LABELS, quote=False)


TEXTS = {
    "vehicle_model": category("vehicle_model", fixed.VEHICLE_MODELS),
    "maintenance_history": category("maintenance_history", fixed.MAINTENANCE_HISTORIES),
    "fuel_type": category("fuel_type", fixed.FUEL_TYPES),
    "transmission_type": category("transmission_type", fixed.TRANSMISSIONS),
    "owner_type": category("owner_type", fixed.OWNER_TYPES),
    "tire_condition": condition("tire_condition"),
    "brake_condition": condition("brake_condition"),
    "battery_status": condition("battery_status", weak=True),
    "need_maintenance": target("need_maintenance"),
}
NUMBERS = list(fixed.VALID_RANGES)
DATES = ["last_service_date", "warranty_expiry_date"]


def parsed_cte(source: str, name: str = "parsed") -> str:
    """Numbers and dates of a dirty table in steps; the other columns stay as they are."""
    low = ", ".join(f"lower({null_markers(c)}) AS {c}" for c in NUMBERS + DATES)
    comma = ", ".join(
        f"CASE WHEN regexp_full_match({c}, '-?\\d+,\\d+') THEN replace({c}, ',', '.') ELSE {c} END AS t_{c}" for c in NUMBERS
    )

    def bare(c):
        text = f"replace(replace(t_{c}, '$', ''), ',', '')"
        for unit in ("km/l", "km", "cc", "l"):
            text = f"replace({text}, '{unit}', '')"
        return f"TRY_CAST(trim({text}) AS DOUBLE) AS n_{c}"

    words = lambda c: _case(c, fixed.NUMBER_WORDS, quote=False)
    litre = "CASE WHEN (regexp_matches(t_engine_size, '(^|[^a-z])[0-9.]+\\s*l\\b') OR t_engine_size LIKE '%l') AND abs(n_engine_size) <= 10 THEN n_engine_size * 1000 ELSE n_engine_size END"
    final = ", ".join(
        f"coalesce({words(c)}, {litre if c == 'engine_size' else 'n_' + c}) AS {c}" for c in NUMBERS
    )
    days = ", ".join(
        f"CAST(try_strptime({c}, ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y']) AS DATE) AS {c}" for c in DATES
    )
    years = ", ".join(f"CASE WHEN year({c}) BETWEEN 2000 AND 2030 THEN {c} END AS {c}" for c in DATES)
    return (
        f"{name}_1 AS MATERIALIZED (SELECT * REPLACE ({low}) FROM {source}), "
        f"{name}_2 AS MATERIALIZED (SELECT *, {comma} FROM {name}_1), "
        f"{name}_3 AS MATERIALIZED (SELECT *, {', '.join(bare(c) for c in NUMBERS)} FROM {name}_2), "
        f"{name}_4 AS MATERIALIZED (SELECT * REPLACE ({final}, {days}) FROM {name}_3), "
        f"{name} AS MATERIALIZED (SELECT * EXCLUDE ({', '.join(f't_{c}, n_{c}' for c in NUMBERS)}) REPLACE ({years}) FROM {name}_4)"
    )


def typed_cte(source: str = "distinct_rows", name: str = "typed") -> str:
    ranges = ", ".join(f"CASE WHEN {c} BETWEEN {a} AND {b} THEN {c} END AS {c}" for c, (a, b) in fixed.VALID_RANGES.items())
    texts = ", ".join(f"{sql} AS {c}" for c, sql in TEXTS.items())
    return parsed_cte(source, f"{name}_p") + f", {name} AS MATERIALIZED (SELECT * REPLACE ({ranges}, {texts}) FROM {name}_p)"


# The cleaned table: distinct rows, typed, date order repaired, target known.
CLEANED = (
    "distinct_rows AS MATERIALIZED (SELECT DISTINCT * FROM vehicles_duplicated), " + typed_cte() + ", "
    "cleaned AS MATERIALIZED (SELECT * REPLACE (CASE WHEN warranty_expiry_date < last_service_date THEN NULL ELSE warranty_expiry_date END "
    "AS warranty_expiry_date, CAST(need_maintenance AS INTEGER) AS need_maintenance) FROM typed WHERE need_maintenance IS NOT NULL)"
)

# The engineered table.
_DAYS = "date_diff('day', {a}, {b})"
ENGINEERED = CLEANED + (
    ", ref AS (SELECT max(last_service_date) AS d FROM cleaned), engineered AS MATERIALIZED (SELECT c.*, "
    "CAST(date_diff('day', c.last_service_date, ref.d) AS DOUBLE) AS days_since_last_service, "
    "CAST(date_diff('day', ref.d, c.warranty_expiry_date) AS DOUBLE) AS days_to_warranty_expiry, "
    "CASE WHEN date_diff('day', ref.d, c.warranty_expiry_date) < 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS warranty_expired_flag, "
    + ", ".join(
        f"c.{a} / nullif(c.vehicle_age, 0) AS {n}"
        for a, n in (("mileage", "mileage_per_year"), ("reported_issues", "issues_per_year"),
                     ("service_history", "service_per_year"), ("accident_history", "accidents_per_year"))
    )
    + ", CAST(CASE c.tire_condition WHEN 'New' THEN 0 WHEN 'Good' THEN 1 WHEN 'Worn Out' THEN 2 END AS DOUBLE) AS ts"
    ", CAST(CASE c.brake_condition WHEN 'New' THEN 0 WHEN 'Good' THEN 1 WHEN 'Worn Out' THEN 2 END AS DOUBLE) AS bs"
    ", CAST(CASE c.battery_status WHEN 'New' THEN 0 WHEN 'Good' THEN 1 WHEN 'Weak' THEN 2 END AS DOUBLE) AS ws"
    ", CASE WHEN coalesce(ts, bs, ws) IS NOT NULL THEN coalesce(ts, 0) + coalesce(bs, 0) + coalesce(ws, 0) END AS condition_score"
    " FROM cleaned c, ref)"
)
