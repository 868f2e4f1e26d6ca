"""Controlled vocabularies and fixed reference values.

FIXED VALUES — these must equal the source system's codes for results to be
right; they are stated here once, as plain text, in natural order.
"""

# ---------------------------------------------------------------- FIXED VALUES
# Boolean spellings (after upper + trim).
TRUE_FORMS = ["Y", "YES", "1", "TRUE", "T"]
FALSE_FORMS = ["N", "NO", "0", "FALSE", "F"]

# Work-order status: raw form (after upper + trim) -> unified value.
STATUS_MAP = {
    "1": "open",
    "OPEN": "open",
    "2": "in_progress",
    "IN PROGRESS": "in_progress",
    "INPROGRESS": "in_progress",
    "3": "awaiting_parts",
    "AWAITING PARTS": "awaiting_parts",
    "WAITING PARTS": "awaiting_parts",
    "4": "completed",
    "COMPLETED": "completed",
    "CLOSED": "completed",
    "5": "cancelled",
    "CANCELLED": "cancelled",
    "CANCELED": "cancelled",
}
STATUS_VALUES = ["open", "in_progress", "awaiting_parts", "completed", "cancelled", "unknown"]

# Line types (after lower + trim); anything else becomes 'unknown'.
# 'return' is part of the vocabulary so negative return quantities are legal.
LINE_TYPES = ["labour", "part", "sublet", "fee", "return"]
ACCEPTED_LINE_TYPES = ["part", "labour", "sublet", "fee"]

# Tokens meaning "nobody assigned" (after upper + trim).
TECHNICIAN_SENTINELS = ["", "UNASSIGNED", "N/A", "-"]

# Units and currency markers stripped from numeric text.
NUMERIC_NOISE = ["NGN", "₦", "KMS", "KM", "HOURS", "HRS"]

# Placeholder "still open" close date: anything at or before this is NULL.
PLACEHOLDER_CUTOFF = "1901-01-01 00:00:00"

# Odometer sanity bounds (km, inclusive) and labour-hours alert threshold.
ODOMETER_MIN = 0
ODOMETER_MAX = 2_000_000
LABOUR_HOURS_ALERT = 24

# Reconciliation tolerance in currency units (strictly greater fails).
TOTAL_TOLERANCE = 1
# Upper bound on the share of orders with a part-line mismatch.
MISMATCH_RATE_BOUND = 0.10

# Source freshness thresholds in hours: source -> (warn_after, error_after).
FRESHNESS_HOURS = {"dms": (2, 6), "erp": (3, 8)}

# Nigerian mobile prefixes accepted by the E.164 normaliser.
PHONE_LOCAL_PATTERN = r"^0[789]\d{9}$"
PHONE_INTL_PATTERN = r"^234[789]\d{9}$"

# Plates without separators: three letters, three digits, two letters.
PLATE_PATTERN = r"^[A-Z]{3}[0-9]{3}[A-Z]{2}$"
# Model spellings (after title case) -> model; others stay.
MODEL_ALIASES = {"Corolla Le": "Corolla", "Hilux Pickup": "Hilux"}

# Movement types and their sign convention.
MOVEMENT_SIGN = {"receipt": 1, "return": 1, "adjustment": 1, "issue": -1, "writeoff": -1}

# Payment method spellings (after upper + trim) -> controlled value.
PAYMENT_METHODS = {"CASH": "cash", "CARD": "card", "POS": "card", "BANK TRANSFER": "transfer",
                   "TRANSFER": "transfer", "INSURANCE": "insurance", "CREDIT": "credit"}
DEFAULT_CURRENCY = "NGN"
# Customer type (after upper + trim) -> controlled value.
CUSTOMER_TYPES = {"INDIVIDUAL": "individual", "FLEET": "fleet", "CORPORATE": "corporate", "INSURANCE": "insurance"}

# City spelling variants (after upper + trim) -> canonical city; others title-cased.
CITY_ALIASES = {"LAGOS": "Lagos", "LAG": "Lagos", "LAGOS STATE": "Lagos"}

# Vehicle engine and transmission vocabularies (after lower + trim).
ENGINE_TYPES = {"petrol": "petrol", "diesel": "diesel", "hybrid": "hybrid", "electric": "electric", "ev": "electric"}
TRANSMISSIONS = {"manual": "manual", "automatic": "automatic", "auto": "automatic", "cvt": "cvt"}
VEHICLE_MIN_YEAR = 1950

# Technician skill levels.
SKILL_LEVELS = ["apprentice", "junior", "senior", "master"]
# ------------------------------------------------------------ END FIXED VALUES
