"""Fixed values that must equal the original pipeline's for equal results.

FIXED VALUES — keep as written, in this order.
"""

# Currencies accepted by the quality suite and used for rate columns.
CURRENCIES = ["EUR", "USD", "GBP", "JPY", "TRY", "AED", "CNY"]
BASE_CURRENCY = "EUR"
# Target currencies kept from a rates payload (base excluded).
TARGET_CURRENCIES = ["USD", "GBP", "JPY", "TRY", "AED", "CNY"]

# Tokens treated as "no value" by string cleaning.
GARBAGE_TOKENS = ["?", "???", "-", "--", "___", "null", "NULL", "Null", "NaN", " "]
# Characters stripped from both ends of a string value.
JUNK_EDGE_PATTERN = r"^[!@#\$%^&*()_+\-=]+|[!@#\$%^&*()_+\-=]+$"
# Trailing dots/whitespace removed from city names.
CITY_TRAILING_PATTERN = r"[.\s]+$"
CITY_TRAILING_DOTS_PATTERN = r"\.+$"
UNKNOWN = "Unknown"

# Number words mapped to digits (exact case).
NUMBER_WORDS = {"One": "1", "Two": "2", "Three": "3", "Four": "4", "Five": "5", "Ten": "10"}

# Column-name keyword classes (substring match on the lower-cased name).
NUMERIC_KEYWORDS = ["price", "amount", "cost", "tax", "rate", "rating", "votes", "score",
                    "rooms", "booked", "nights", "adults", "children", "infants", "capacity",
                    "latitude", "longitude", "discount", "fee", "coord"]
INT_KEYWORDS = ["rooms", "booked", "adults", "rating"]
COORD_KEYWORDS = ["latitude", "longitude", "coord", "geo"]
DATE_KEYWORDS = ["date", "_at", "time", "day"]
PHONE_KEYWORDS = ["phone", "contact", "mobile", "tel", "fax"]
CLEAN_EXEMPT = ["hotel_name", "hotel_type"]

# Phone rule: shorter than this, or containing the run below -> Unknown.
PHONE_MIN_LEN = 5
PHONE_ZERO_RUN = "0000000"

# Sentinel for unparsable dates; the fact table keeps dates after the cutoff.
DATE_SENTINEL = "1900-01-01 00:00:00"
FACT_MIN_DATE = "1950-01-01"

# Hotel tiers by star rating.
TIER_PREMIUM_MIN = 4
TIER_STANDARD_MIN = 3

# Booking-status labels counted as cancelled (the stream spells it "Cancelled").
CANCELLED_LABELS = ["Canceled", "Cancelled"]

# Fallback cities when neither silver nor bronze provide any.
DEFAULT_CITIES = ["Amsterdam", "Berlin", "Paris", "London", "Istanbul"]

# Report exclude lists.
REPORT_COUNTRY_EXCLUDE_TYPES = ["Budget Hotel", "--", "___", "???", "Unknown", "City Hotel...",
                                "!!Business Hotel", "Giza"]
REPORT_COUNTRY_EXCLUDE_COUNTRIES = ["Unknown"]
REPORT_TYPE_EXCLUDE = ["--", "___", "???", "!!Business Hotel", "Budget Hotel...", "!!City Hotel",
                       "City Hotel...", "!!Boutique", "!!Budget Hotel", "Luxury Hotel...",
                       "Business Hotel...", "Resort...", "!!Resort", "!!Luxury Hotel", "Boutique...",
                       "Unknown", "Giza"]
REPORT_CITY_EXCLUDE = ["Unknown", "Tel Aviv"]

# Quality thresholds.
MIN_SILVER_ROWS = 100_000
TEMPERATURE_RANGE = (-60, 60)
REQUIRED_RATE_CURRENCIES = ["USD", "GBP", "TRY"]

# Stream micro-batch policy: 10 s trigger, 500 items per batch.
STREAM_TRIGGER = "10 seconds"
STREAM_MAX_FILES = 500

# Source labels of the landed weather and rate rows.
WEATHER_SOURCE = "open-meteo"
RATES_SOURCE = "exchangerate-api"

# Batch / stream split share by position.
BATCH_SHARE = 0.7
