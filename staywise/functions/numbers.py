"""Numeric, date and tier expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_word_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*K.NUMBER_WORDS.items())])


def words_to_digits(c) -> Column:
    """'Two' -> '2'; anything else unchanged (exact case)."""
    v = _c(c)
    return F.coalesce(F.try_element_at(number_word_map(), v), v)


def to_double(c) -> Column:
    """Permissive double parse: NULL on failure (ANSI-safe)."""
    return _c(c).try_cast("double")


def finite(c) -> Column:
    """The number, or NULL for NaN and infinities, which would otherwise
    swallow every sum they enter."""
    v = to_double(c)
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(None)).otherwise(v)


def exact_sum(c, scale: int = 2) -> Column:
    """Sum as decimal with ``scale`` decimals, as double: the same whatever
    the order of the rows or the number of partitions.  Values that are no
    numbers of that range (NaN, infinities) do not count."""
    return F.sum(_c(c).try_cast(f"decimal(38,{scale})")).cast("double")


def to_int(c) -> Column:
    """Permissive int parse through double so '4.0' -> 4 (truncates)."""
    return _c(c).try_cast("double").try_cast("int")


def clean_amount(c, as_int: bool = False, zero_fill: bool = True) -> Column:
    """cast, absolute value, NULL -> 0."""
    v = to_int(c) if as_int else to_double(c)
    v = F.abs(v)
    return F.coalesce(v, F.lit(0).cast("int" if as_int else "double")) if zero_fill else v


def clean_coord(c, limit: int, as_int: bool = False) -> Column:
    """Outside +-limit, or exactly 0 -> NULL."""
    v = to_int(c) if as_int else to_double(c)
    return F.when((v < -limit) | (v > limit) | (v == 0), F.lit(None)).otherwise(v)


def safe_timestamp(c) -> Column:
    """Timestamp parse that yields NULL on dirty text."""
    v = _c(c)
    return F.try_to_timestamp(v.cast("string"))


def with_sentinel(ts: Column) -> Column:
    return F.coalesce(ts, F.to_timestamp(F.lit(K.DATE_SENTINEL)))


def hotel_tier(c) -> Column:
    v = _c(c)
    return (F.when(v >= K.TIER_PREMIUM_MIN, F.lit("Premium"))
            .when(v >= K.TIER_STANDARD_MIN, F.lit("Standard"))
            .otherwise(F.lit("Budget")))


def avg_money(c, scale: int = 2) -> Column:
    """Average of cent amounts, exactly: the sum runs in decimal, so the
    result does not depend on the order rows are added (double sums do)."""
    return F.round(F.avg(_c(c).cast("decimal(38,2)")), scale).cast("double")


def wavg_money(value, weight, scale: int = 2, value_scale: int = 2) -> Column:
    """Weighted average sum(v*w)/sum(w) with the products summed in decimal."""
    num = F.sum((_c(value) * _c(weight)).cast(f"decimal(38,{value_scale})"))
    return F.round(num / F.sum(_c(weight)), scale).cast("double")
