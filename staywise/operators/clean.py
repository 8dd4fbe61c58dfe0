"""Cleaning operators.  Each builds ONE ``select`` over all affected columns
(no per-column ``withColumn`` loops), so analysis cost stays flat and the
whole step is one codegen stage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import numbers as N
from ..functions import text as T


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    """Replace/add columns in one projection, keeping column order."""
    out = [exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns]
    out += [e.alias(c) for c, e in exprs.items() if c not in df.columns]
    return df.select(*out)


# ---- single-purpose operators (C1-C7, C9-C12) -------------------------------------------

def clean_strings(df: DataFrame, cols, upper_cols=()) -> DataFrame:
    """trim, strip edge junk, garbage -> Unknown, initcap (upper for ``upper_cols``)."""
    return _replace(df, {c: T.clean_string(c, upper=c in upper_cols) for c in cols})


def clean_phone(df: DataFrame, cols) -> DataFrame:
    return _replace(df, {c: T.clean_phone(c) for c in cols})


def number_words(df: DataFrame, cols) -> DataFrame:
    return _replace(df, {c: N.words_to_digits(c) for c in cols})


def clean_numeric(df: DataFrame, cols, int_cols=(), zero_fill: bool = True) -> DataFrame:
    """number words -> digits (string columns), cast, abs, NULL -> 0."""
    dt = dict(df.dtypes)
    exprs = {}
    for c in cols:
        v = N.words_to_digits(c) if dt[c] == "string" else F.col(c)
        exprs[c] = N.clean_amount(v, as_int=c in int_cols, zero_fill=zero_fill)
    return _replace(df, exprs)


def clean_coords(df: DataFrame, cols) -> DataFrame:
    """latitude outside +-90 (others +-180) or exactly 0 -> NULL."""
    dt = dict(df.dtypes)
    exprs = {}
    for c in cols:
        v = N.words_to_digits(c) if dt[c] == "string" else F.col(c)
        exprs[c] = N.clean_coord(v, 90 if "latitude" in c.lower() else 180)
    return _replace(df, exprs)


def split_datetime(df: DataFrame, cols) -> DataFrame:
    """Parse to timestamp (unparsable -> 1900-01-01 sentinel); keep the date
    in ``c`` and the clock time as ``c_time`` (HH:mm:ss)."""
    exprs = {}
    for c in cols:
        safe = N.with_sentinel(N.safe_timestamp(c))
        exprs[c] = F.to_date(safe)
        exprs[f"{c}_time"] = F.date_format(safe, "HH:mm:ss")
    return _replace(df, exprs)


def drop_constant_time_cols(df: DataFrame, time_cols) -> DataFrame:
    """Drop ``_time`` columns that are midnight on every row.

    One aggregate job answers the question for all columns at once (the
    result is one row of booleans: metadata, not data).
    """
    time_cols = [c for c in time_cols if c in df.columns]
    if not time_cols:
        return df
    probe = df.agg(*[F.max(F.col(c) != "00:00:00").alias(c) for c in time_cols]).first()
    drop = [c for c in time_cols if not probe[c]]
    return df.drop(*drop) if drop else df


def time_col_activity(df: DataFrame, time_cols) -> DataFrame:
    """The probe of :func:`drop_constant_time_cols` as a frame:
    (column, non_midnight_rows, dropped)."""
    rows = [F.struct(F.lit(c).alias("column"),
                     F.count_if(F.col(c) != "00:00:00").alias("non_midnight_rows")) for c in time_cols]
    return (df.agg(F.array(*rows).alias("a")).select(F.inline("a"))
            .withColumn("dropped", F.col("non_midnight_rows") == 0))


def add_city_clean(df: DataFrame, src: str = "city", name: str = "city_clean") -> DataFrame:
    return _replace(df, {name: T.city_clean(src)})


def type_cast_filter(df: DataFrame, date_col: str = "booking_date", parity: bool = False) -> DataFrame:
    """Typed core columns; rows whose booking date does not parse are dropped.
    Text ``NaN`` is a missing amount, except with ``parity``."""
    number = N.to_double if parity else N.finite
    exprs = {
        date_col: N.safe_timestamp(date_col),
        "total_amount": F.abs(number("total_amount")),
        "room_price": F.abs(number("room_price")),
        "nights": N.to_int("nights"),
    }
    exprs = {k: v for k, v in exprs.items() if k in df.columns}
    return _replace(df, exprs).where(F.col(date_col).isNotNull())


def impute_prices(df: DataFrame, total: str = "total_amount", unit: str = "room_price",
                  qty: str = "nights") -> DataFrame:
    """unit = round(total / qty, 2) when missing and qty > 0; THEN
    total = round(unit * qty, 2) when missing.  Order matters: the second
    step sees the imputed unit price."""
    t, u, q = F.col(total), F.col(unit), F.col(qty)
    new_u = F.when(u.isNull() & t.isNotNull() & (q > 0), F.round(t / q, 2)).otherwise(u)
    new_t = F.when(t.isNull() & new_u.isNotNull(), F.round(new_u * q, 2)).otherwise(t)
    return _replace(df, {unit: new_u, total: new_t})


# ---- classification + universal clean (C13) -----------------------------------------------

@dataclass
class ColumnClasses:
    numeric: list = field(default_factory=list)
    ints: list = field(default_factory=list)
    coords: list = field(default_factory=list)
    dates: list = field(default_factory=list)
    phones: list = field(default_factory=list)
    strings: list = field(default_factory=list)
    upper: list = field(default_factory=list)
    no_zero_fill: list = field(default_factory=list)
    exempt: list = field(default_factory=list)
    untouched: list = field(default_factory=list)


def _hit(name: str, words, parity: bool) -> bool:
    low = name.lower()
    if parity:
        return any(w in low for w in words)
    # corrected mode: keywords match whole '_'-separated tokens
    toks = set(low.split("_"))
    return any((w.strip("_") in toks) for w in words) or (
        "timestamp" in toks and "time" in words)


def classify_columns(df: DataFrame, parity: bool = False, overrides: dict | None = None) -> ColumnClasses:
    """Assign each column a cleaning class from its name (and dtype).

    parity=True reproduces the original substring rules, including their
    side effects (``hotel_id`` is a phone, ``nearby_attractions`` a date,
    ids are title-cased, a missing exchange rate becomes 0, numeric weather
    columns are cleaned as text).  The default matches whole name tokens,
    exempts ``*_id`` columns, leaves non-string typed columns alone and does
    not zero-fill the exchange rate.
    """
    dt = dict(df.dtypes)
    cls = ColumnClasses()
    ov = overrides or {}
    for c in df.columns:
        if c in ov:
            getattr(cls, ov[c]).append(c)
            continue
        if c in K.CLEAN_EXEMPT:
            cls.exempt.append(c)
            continue
        is_num = _hit(c, K.NUMERIC_KEYWORDS, parity)
        is_date = _hit(c, K.DATE_KEYWORDS, parity)
        if is_num:
            cls.numeric.append(c)
            if _hit(c, K.INT_KEYWORDS, parity):
                cls.ints.append(c)
            if _hit(c, K.COORD_KEYWORDS, parity):
                cls.coords.append(c)
            if not parity and c == "exchange_rate_to_eur":
                cls.no_zero_fill.append(c)
        if is_date:
            cls.dates.append(c)
        if is_num or is_date:
            continue
        if not parity and (dt[c] != "string" or c.endswith("_id") or c == "id"):
            cls.untouched.append(c)
            continue
        if _hit(c, K.PHONE_KEYWORDS, parity):
            cls.phones.append(c)
        else:
            cls.strings.append(c)
        if "currency" in c.lower():
            cls.upper.append(c)
    return cls


def parsed_exprs(df: DataFrame, cls: ColumnClasses) -> dict:
    """First projection of the universal clean: what the rules of
    :func:`universal_clean_exprs` test and return, so that each value is
    searched or parsed once, not once for each place where a rule names it."""
    dt = dict(df.dtypes)
    return ({c: T.strip_edges(c) for c in cls.strings} | {c: T.phone_digits(c) for c in cls.phones}
            | {c: N.to_double(N.words_to_digits(c)) for c in cls.numeric if dt[c] == "string"})


def universal_clean_exprs(df: DataFrame, cls: ColumnClasses, parity: bool = False) -> dict:
    """Column -> expression map for the universal clean of parsed values (one
    projection).  ``df``: the frame before they were parsed."""
    dt = dict(df.dtypes)
    ex = {}
    for c in cls.strings:
        ex[c] = T.stripped_string(F.col(c), upper=c in cls.upper)
    for c in cls.phones:
        ex[c] = T.known_phone(F.col(c))
    for c in cls.numeric:
        v = F.col(c)
        if not parity and dt[c] in ("string", "double", "float"):
            v = N.finite(v)
        if c in cls.coords:
            ex[c] = N.clean_coord(v, 90 if "latitude" in c.lower() else 180, as_int=c in cls.ints)
        else:
            ex[c] = N.clean_amount(v, as_int=c in cls.ints, zero_fill=c not in cls.no_zero_fill)
    for c in cls.dates:
        # a column that is both numeric and date gets the date treatment last
        src = ex.get(c, F.col(c))
        typed = dt[c] in ("timestamp", "date") and c not in ex
        safe = N.with_sentinel(src.cast("timestamp") if typed else N.safe_timestamp(src))
        ex[c] = F.to_date(safe)
        ex[f"{c}_time"] = F.date_format(safe, "HH:mm:ss")
    for c in cls.exempt:
        ex[c] = T.blank_to_unknown_trim(c)
    return ex


def universal_clean(df: DataFrame, parity: bool = False, drop_midnight: bool = True,
                    overrides: dict | None = None) -> DataFrame:
    """C1-C9 driven by column classes, as two generated projections (values
    parsed, rules applied), then the midnight-only ``_time`` columns dropped
    after one probe job."""
    cls = classify_columns(df, parity, overrides)
    out = _replace(_replace(df, parsed_exprs(df, cls)), universal_clean_exprs(df, cls, parity))
    if drop_midnight:
        out = drop_constant_time_cols(out, [f"{c}_time" for c in cls.dates])
    return out
