"""Schema-level operators: names, unions, defaults, lookup fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import digits_only, is_blank_or_unknown


def as_strings(df: DataFrame) -> DataFrame:
    """Cast every column to string (bronze convention: types come in silver)."""
    return df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in df.columns])


def union_by_name(a: DataFrame, b: DataFrame, as_string: bool = True) -> DataFrame:
    """Union by column name; missing columns become NULL.

    Both sides are cast to string first: under ANSI, string ∪ bigint widens
    to bigint and fails at run time on dirty text.
    """
    if as_string:
        a, b = as_strings(a), as_strings(b)
    return a.unionByName(b, allowMissingColumns=True)


def standardize_names(df: DataFrame) -> DataFrame:
    """strip, lower-case, space -> underscore."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def dedup_column_names(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns (positional, no ambiguity)."""
    seen: dict[str, int] = {}
    tmp, keep = [], []
    for i, c in enumerate(df.columns):
        if c in seen:
            tmp.append(f"{c}__dup{i}")
        else:
            seen[c] = i
            tmp.append(c)
            keep.append(c)
    return df.toDF(*tmp).select(*keep)


def reconcile_columns(df: DataFrame, target: str = "total_amount",
                      aliases=("total_price", "paid_amount"), policy: str = "drop") -> DataFrame:
    """Bring alternative names of one measure onto ``target``.

    ``drop``: an alias is dropped when ``target`` exists, else renamed to it
    (the original behaviour: batch amounts are lost when both exist).
    ``coalesce``: ``target`` = first non-NULL of target and aliases.
    """
    cols = df.columns
    present = [a for a in aliases if a in cols]
    if policy == "coalesce":
        if not present:
            return df
        parts = ([F.col(target)] if target in cols else []) + [F.col(a) for a in present]
        out = [c for c in cols if c not in present and c != target]
        return df.select(*out, F.coalesce(*parts).alias(target))
    if policy != "drop":
        raise ValueError(f"unknown policy {policy!r}")
    for a in present:
        if target in df.columns:
            df = df.drop(a)
        else:
            df = df.withColumnRenamed(a, target)
    return df


def default_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add ``{name: (type, value)}`` columns that are missing."""
    add = {n: F.lit(v).cast(t) for n, (t, v) in defaults.items() if n not in df.columns}
    return df.withColumns(add) if add else df


SILVER_DEFAULTS = {"total_amount": ("double", None), "currency": ("string", K.BASE_CURRENCY)}

HOTEL_META_COLS = ["hotel_name", "city", "country", "star_rating", "hotel_type", "latitude", "longitude"]


def hotel_dimension(batch: DataFrame, id_col: str = "hotel_id", meta_cols=None,
                    order_col: str = "booking_id", keep_order: bool = False) -> DataFrame:
    """One row of hotel attributes per numeric hotel id.

    The surviving row is the one with the smallest ``order_col`` (a total
    order, unlike an arbitrary ``dropDuplicates``).  ``min_by`` is a plain
    aggregate, so Spark combines map-side before the shuffle and a hot
    hotel costs one row per map task.  ``keep_order`` adds the surviving row's
    order value as ``dim_order``, so that dimensions of several landings can
    be merged.
    """
    meta = [c for c in (meta_cols or HOTEL_META_COLS) if c in batch.columns]
    packed = F.struct(*[F.col(c).alias(f"dim_{c}") for c in meta])
    return (batch.select(digits_only(id_col).alias("dim_id"), F.col(order_col).alias("_ord"),
                         packed.alias("_v"))
            .where(F.col("dim_id").isNotNull() & (F.col("dim_id") != ""))
            .groupBy("dim_id").agg(F.min_by("_v", "_ord").alias("_v"), F.min("_ord").alias("dim_order"))
            .select("dim_id", "_v.*", *(["dim_order"] if keep_order else [])))


def fill_from_lookup(df: DataFrame, dim: DataFrame, id_col: str, cols, dim_key: str = "dim_id",
                     prefix: str = "dim_", salt_cols=None) -> DataFrame:
    """Left join a dimension on the digits of ``id_col`` and replace NULL,
    blank or 'Unknown' values of ``cols`` with the dimension's value
    (columns missing in ``df`` are added from the dimension).

    Rows without a usable key get a salted key that never matches, so they
    do not pile up in one join partition.  The salt is a deterministic hash
    of ``salt_cols`` (default: the booking id, else every column), so a
    recomputed map task sends each row to the same partition.
    """
    salt_cols = salt_cols or (["booking_id"] if "booking_id" in df.columns else df.columns)
    key = digits_only(id_col)
    salted = F.when(key.isNotNull() & (key != ""), key).otherwise(
        F.concat(F.lit("\u0000"), (F.abs(F.xxhash64(*[F.col(c) for c in salt_cols])) % 1024).cast("string")))
    left = df.withColumn("_lk", salted)
    joined = left.join(dim, left["_lk"] == dim[dim_key], "left")
    out = []
    for c in df.columns:
        if c in cols:
            out.append(F.when(is_blank_or_unknown(c), F.col(f"{prefix}{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    out += [F.col(f"{prefix}{c}").alias(c) for c in cols if c not in df.columns]
    return joined.select(*out)


def hotel_lookup_fill(df: DataFrame, batch: DataFrame, id_col: str = "hotel_id") -> DataFrame:
    """Fill hotel attributes of (stream) rows from the batch hotel dimension."""
    dim = hotel_dimension(batch, id_col)
    meta = [c for c in HOTEL_META_COLS if c in batch.columns]
    return fill_from_lookup(df, dim, id_col, meta)
