"""Column expressions for dirty text. All are Catalyst built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c) -> Column:
    """Keep only the digits of a value (hotel id normaliser)."""
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def city_clean(c) -> Column:
    """Strip trailing dots/whitespace, trim, title-case."""
    return F.initcap(F.trim(F.regexp_replace(_c(c), K.CITY_TRAILING_PATTERN, "")))


def city_clean_dots(c) -> Column:
    """Variant of the dimension job: trailing dots only, then trim/initcap."""
    return F.initcap(F.trim(F.regexp_replace(_c(c), K.CITY_TRAILING_DOTS_PATTERN, "")))


def norm_city(c) -> Column:
    """Join key for weather lookups."""
    return F.initcap(F.trim(_c(c)))


def norm_currency(c) -> Column:
    return F.upper(F.trim(_c(c)))


def garbage_to_unknown(v: Column) -> Column:
    """Garbage token or empty -> Unknown; NULL stays NULL."""
    return F.when(v.isin([*K.GARBAGE_TOKENS, ""]), F.lit(K.UNKNOWN)).otherwise(v)


# What may stand at an end of a value that JUNK_EDGE_PATTERN or trim changes: junk,
# spaces, and the line ends before which ``$`` matches too.
_EDGES = "!@#$%^&*()_+-= \n\r\u0085\u2028\u2029"


def strip_edges(c) -> Column:
    """trim, strip junk edge characters; values without any are not searched."""
    v = _c(c).cast("string")
    return F.when(F.btrim(v, F.lit(_EDGES)) == v, v).otherwise(F.regexp_replace(F.trim(v), K.JUNK_EDGE_PATTERN, ""))


def stripped_string(v: Column, upper: bool = False) -> Column:
    """garbage -> Unknown, then case, of a value without edges."""
    v = garbage_to_unknown(v)
    return F.upper(v) if upper else F.initcap(v)


def clean_string(c, upper: bool = False) -> Column:
    """trim, strip junk edge characters, garbage -> Unknown, then case."""
    return stripped_string(strip_edges(c), upper)


def phone_digits(c) -> Column:
    return F.regexp_replace(F.trim(_c(c)), r"[^0-9+]", "")


def known_phone(v: Column) -> Column:
    """Too short or a long zero run -> Unknown; what is left has neither
    letters nor garbage."""
    return F.when((F.length(v) < K.PHONE_MIN_LEN) | v.contains(K.PHONE_ZERO_RUN), F.lit(K.UNKNOWN)).otherwise(v)


def clean_phone(c) -> Column:
    """Keep [0-9+]; too short or a long zero run -> Unknown."""
    return known_phone(phone_digits(c))


def blank_to_unknown_trim(c) -> Column:
    """hotel_name / hotel_type rule: NULL or blank -> Unknown, else trimmed."""
    v = _c(c)
    return F.when(v.isNull() | (F.trim(v) == ""), F.lit(K.UNKNOWN)).otherwise(F.trim(v))


def is_blank_or_unknown(c) -> Column:
    v = _c(c)
    return v.isNull() | (F.trim(v) == "") | (v == K.UNKNOWN)


def usable_value(c) -> Column:
    """Not NULL, not Unknown, not blank."""
    v = _c(c)
    return v.isNotNull() & (v != K.UNKNOWN) & (v != "")
