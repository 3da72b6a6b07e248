"""Column expressions that turn dirty text into typed values. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions import fixed

BLANKS = " \t\n\r\x0b\x0c"
_NUMBER = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|[+-]?inf(?:inity)?)$"

# The closed list of date formats, separators made "-". Month-first is tried before day-first.
# A partial date fits none of them and becomes NULL.
DATE_FORMATS = (
    "yyyy-M-d", "M-d-yyyy", "d-M-yyyy", "M-d-yy", "d-M-yy", "yyyyMMdd",
    "d-MMM-yyyy", "d-MMMM-yyyy", "MMM-d-yyyy", "MMMM-d-yyyy",
)
# What every text that a format reads looks like. A format that fails raises an error inside, which takes a hundred
# times as long as this look. A lone M, d or y may have leading zeros; a year of four digits may have more and a sign.
_DAY, _MONTH, _YEAR = r"0*(?:[1-9]|[12]\d|3[01])", r"0*(?:[1-9]|1[0-2])", r"[+-]?\d{4,}"
_SHAPES = {"yyyyMMdd": _YEAR + r"\d{4}"}
for _format in DATE_FORMATS:
    _parts = {"yyyy": _YEAR, "yy": r"\d\d", "M": _MONTH, "MMM": r"[^\d-]+", "MMMM": r"[^\d-]+", "d": _DAY}
    _SHAPES.setdefault(_format, "-".join(_parts[p] for p in _format.split("-") if p in _parts))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every blank character, not only spaces."""
    return F.btrim(_col(c), F.lit(BLANKS))


def is_missing_like(c: Column | str) -> Column:
    """True for NULL and for the missing markers, ignoring case and outer blanks."""
    low = F.lower(strip(_col(c).cast("string")))
    return F.coalesce(low.isin(*fixed.MISSING_MARKERS), F.lit(True))


def null_markers(c: Column | str) -> Column:
    """Trimmed text, with missing markers as NULL."""
    text = strip(_col(c).cast("string"))
    return F.when(~F.lower(text).isin(*fixed.MISSING_MARKERS), text)


def collapse_space(c: Column | str) -> Column:
    """Lower case with runs of blanks made one space."""
    return F.lower(strip(F.regexp_replace(_col(c), r"\s+", " ")))


def lookup(c: Column, mapping: dict) -> Column:
    """Value of ``mapping`` for ``c``, else NULL. The map is a literal, ``c`` is evaluated once."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[c]


# Expressions below name their input as rarely as they can: a repeated input is repeated work in
# generated code. No marker is a key of a map or looks like a number or a date, so the markers
# need no test of their own there.


def map_category(c: Column | str, mapping: dict) -> Column:
    """Canonical category of a dirty label; unknown labels and markers become NULL."""
    return lookup(collapse_space(c), mapping)


def map_condition(c: Column | str, weak_allowed: bool = False) -> Column:
    """Canonical condition; runs of ``_`` and ``-`` count as a space."""
    vocabulary = fixed.BATTERY_CONDITIONS if weak_allowed else fixed.WEAR_CONDITIONS
    return lookup(collapse_space(F.regexp_replace(_col(c), "[_-]+", " ")), vocabulary)


def map_target(c: Column | str) -> Column:
    """1.0, 0.0 or NULL."""
    return lookup(lower_text(c), fixed.TARGET_LABELS)


def lower_text(c: Column | str) -> Column:
    return F.lower(strip(_col(c).cast("string")))


def number_of(low: Column, litres_to_cc: bool = False, thousands: bool = False) -> Column:
    """:func:`parse_number` of text that is already trimmed and in lower case."""
    digits = r"^(-?(?!\d{1,3}(?:,\d{3})+$)\d+),(\d+)$" if thousands else r"^(-?\d+),(\d+)$"
    text = F.regexp_replace(low, digits, "$1.$2")
    bare = F.translate(text, "$,", "")
    for unit in ("km/l", "km", "cc", "l"):
        bare = F.replace(bare, F.lit(unit), F.lit(""))
    bare = F.regexp_replace(strip(bare), r"(?<=\d)_(?=\d)", "")
    # A text without a number is NULL before the cast: reading "" as a number raises an error inside.
    number = F.get(F.regexp_extract_all(bare, F.lit(_NUMBER), F.lit(1)), F.lit(0)).try_cast("double")
    if litres_to_cc:
        in_litres = text.rlike(r"(^|[^a-z])[0-9.]+\s*l\b|l$")
        number = number * F.when(in_litres & (F.abs(number) <= 10), 1000.0).otherwise(1.0)
    # A marker wins over the number word of the same spelling.
    words = {w: float(v) for w, v in fixed.NUMBER_WORDS.items() if w not in fixed.MISSING_MARKERS}
    return F.coalesce(lookup(low, words), number)


def parse_number(c: Column | str, litres_to_cc: bool = False, thousands: bool = False) -> Column:
    """Number from mixed text: words, ``$``, separators and units; NULL when nothing fits.

    One comma between digits is a decimal comma, also in ``12,345``; ``thousands=True`` reads
    groups of three as thousands instead. ``litres_to_cc`` scales values of at most 10 that
    carry a litre unit.
    """
    return number_of(lower_text(c), litres_to_cc, thousands)


def within(c: Column | str, low: float, high: float) -> Column:
    """The value when it lies in the closed range, else NULL."""
    c = _col(c)
    return F.when(c.between(low, high), c)


def date_text(c: Column | str) -> Column:
    """Date text without a time of day, every separator a ``-``."""
    text = F.regexp_replace(lower_text(c), r"[t ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?z?$", "")
    return F.regexp_replace(text, r"[/. ,-]+", "-")


def date_of(text: Column) -> Column:
    """Date of a text made by :func:`date_text`, any year."""
    return F.coalesce(*[F.when(text.rlike(f"^(?:{_SHAPES[f]})$"), F.try_to_date(text, f)) for f in DATE_FORMATS])


def within_years(parsed: Column) -> Column:
    return F.when(F.year(parsed).between(*fixed.YEAR_RANGE), parsed)


def parse_date(c: Column | str) -> Column:
    """Date from mixed text, NULL when no format fits or the year is out of range."""
    return within_years(date_of(date_text(c)))


def drop_expiry_before_service(expiry: Column | str, service: Column | str) -> Column:
    """The expiry date, or NULL when it lies before the last service."""
    expiry, service = _col(expiry), _col(service)
    return F.when(F.coalesce(expiry < service, F.lit(False)), None).otherwise(expiry)


def iso_date_parts(c: Column | str) -> dict[str, Column]:
    """``date_parsed``, ``accident_year`` and ``accident_month`` of an ISO date text."""
    parsed = F.try_to_date(_col(c), "yyyy-MM-dd")
    return {"date_parsed": parsed, "accident_year": F.year(parsed), "accident_month": F.month(parsed)}
