"""Fixed values. They decide results, so they are stated here plainly and in one place."""

# Text that means "no value".
MISSING_MARKERS = (
    "", "na", "n/a", "n.a", "null", "none", "nan", "unknown", "?", "not recorded",
)

# Number words.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7,
    "eight": 8, "nine": 9, "ten": 10, "none": 0, "many": 8, "multiple": 3,
}

# Category spellings.
VEHICLE_MODELS = {
    "car": "Car", "suv": "SUV", "truck": "Truck", "van": "Van", "bus": "Bus",
    "motorcycle": "Motorcycle", "motor cycle": "Motorcycle",
}
MAINTENANCE_HISTORIES = {
    "good": "Good", "average": "Average", "avg": "Average", "poor": "Poor", "p00r": "Poor",
}
FUEL_TYPES = {
    "petrol": "Petrol", "gasoline": "Petrol", "diesel": "Diesel", "dsl": "Diesel",
    "electric": "Electric", "ev": "Electric", "hybrid": "Other", "cng": "Other",
}
TRANSMISSIONS = {"manual": "Manual", "automatic": "Automatic", "auto": "Automatic"}
OWNER_TYPES = {
    "first": "First", "1st": "First", "first owner": "First",
    "second": "Second", "2nd": "Second", "second owner": "Second",
    "third": "Third", "3rd": "Third", "third owner": "Third",
}
WEAR_CONDITIONS = {"new": "New", "good": "Good", "worn out": "Worn Out"}
BATTERY_CONDITIONS = {"new": "New", "good": "Good", "weak": "Weak"}
TARGET_LABELS = {"1": 1.0, "yes": 1.0, "true": 1.0, "0": 0.0, "no": 0.0, "false": 0.0}

# Inclusive bounds of the numeric columns.
VALID_RANGES = {
    "mileage": (0, 300000),
    "reported_issues": (0, 20),
    "vehicle_age": (0, 30),
    "engine_size": (500, 8000),
    "odometer_reading": (0, 500000),
    "insurance_premium": (0, 100000),
    "service_history": (0, 30),
    "accident_history": (0, 20),
    "fuel_efficiency": (5, 40),
}
YEAR_RANGE = (2000, 2030)

# Ordinal scores of the condition columns.
WEAR_SCORES = {"New": 0, "Good": 1, "Worn Out": 2}
BATTERY_SCORES = {"New": 0, "Good": 1, "Weak": 2}

# Risk bands, right-closed upper bounds.
RISK_BANDS = (("Low", 0.40), ("Medium", 0.70), ("High", float("inf")))

# Hours of the day parts; every other hour, and NULL, is night.
DAY_PARTS = (("morning", 5, 11), ("afternoon", 12, 16), ("evening", 17, 20))

# Search stopwords and the stemmer's suffixes, in the order they are tried.
STOPWORDS = (
    "a", "an", "the", "and", "or", "but", "if", "then", "else", "for", "to", "of", "in", "on",
    "at", "by", "with", "as", "is", "are", "was", "were", "be", "been", "being", "this", "that",
    "these", "those", "it", "its", "from", "into", "we", "you", "they", "he", "she", "i", "me",
    "my", "our", "your", "their", "them",
)
STEM_SUFFIXES = ("ingly", "edly", "ing", "ed", "ies", "es", "s", "ly")

# BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75

# Dashes that a slug turns into "-".
SLUG_DASHES = "‑–—"

# Sweeps.
L2_STRENGTHS = (0.05, 0.10, 0.25, 0.50, 1.00, 2.00, 5.00)
L1_STRENGTHS = (0.01, 0.05, 0.10, 0.25, 0.50, 1.00)
ELIMINATION_SIZES = (5, 10, 15, 20, 25, 30, 40, 50)
THRESHOLD_START, THRESHOLD_STEP, THRESHOLD_COUNT = 0.20, 0.005, 121
