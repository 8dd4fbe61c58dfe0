"""Landed API payloads of unknown shape, kept as VARIANT.

The typed readers of ``files`` want the declared shape.  Here a payload lands
whole: every field is read by its path and type when asked for, so a field of
another type costs that field only and its name is noted in ``unread``, and
fields that nobody declared stay in the landed column for later readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .files import parse_update_time
from .tables import overwrite_table

# field of the table -> (payload, path, type)
WEATHER_FIELDS = {
    "country_api": ("geocode", "$.results[0].country", "string"),
    "latitude": ("geocode", "$.results[0].latitude", "double"),
    "longitude": ("geocode", "$.results[0].longitude", "double"),
    "temperature_c": ("forecast", "$.current.temperature_2m", "double"),
    "humidity": ("forecast", "$.current.relative_humidity_2m", "bigint"),
    "weather_code": ("forecast", "$.current.weather_code", "bigint"),
    "recorded_at": ("forecast", "$.current.time", "timestamp"),
}
RATES_FIELDS = {"base_currency": ("payload", "$.base_code", "string"),
                "updated": ("payload", "$.time_last_update_utc", "string")}


def as_variant(payloads: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Text columns parsed to VARIANT under new names.  Text that is no JSON
    gives NULL and stays, as it came, in ``<name>_rescued``."""
    made = {new: F.try_parse_json(F.col(old)) for old, new in columns.items()}
    kept = {f"{new}_rescued": F.when(F.col(old).isNotNull() & F.try_parse_json(F.col(old)).isNull(), F.col(old))
            for old, new in columns.items()}
    return payloads.withColumns(made | kept).drop(*columns)


def land_weather(payloads: DataFrame, path: str) -> DataFrame:
    """Geocode and forecast texts as a table with a VARIANT for each."""
    return overwrite_table(as_variant(payloads, {"geocode_json": "geocode", "weather_json": "forecast"}), path)


def land_rates(payloads: DataFrame, path: str) -> DataFrame:
    """Rates texts (column ``payload``) as a table with a VARIANT."""
    texts = payloads.withColumnRenamed("payload", "payload_json")
    return overwrite_table(as_variant(texts, {"payload_json": "payload"}), path)


def present(v: Column) -> Column:
    """There, and not JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def field(payload: str, path: str, kind: str) -> Column:
    """The value at a path; an object or a list is no text."""
    value = F.try_variant_get(F.col(payload), path, kind)
    if kind != "string":
        return value
    shape = F.schema_of_variant(F.try_variant_get(F.col(payload), path, "variant"))
    return F.when(~F.startswith(shape, F.lit("OBJECT")) & ~F.startswith(shape, F.lit("ARRAY")), value)


def fields(table: dict) -> list[Column]:
    """The typed fields of a table, and ``unread``: in order, the names of
    those that are there, not null, and of no use as their type."""
    unread = F.array_compact(F.array(*[
        F.when(present(F.try_variant_get(F.col(p), at, "variant")) & field(p, at, kind).isNull(), F.lit(n))
        for n, (p, at, kind) in table.items()]))
    return [*[field(*where).alias(n) for n, where in table.items()], unread.alias("unread")]


def weather_rows(landed: DataFrame, source: str = K.WEATHER_SOURCE) -> DataFrame:
    """bronze_weather rows of landed payloads, with ``unread`` and the payloads
    themselves.  Cities that the geocoder did not find are left out, as in
    ``files.flatten_weather``; a reading that lacks a field keeps the others."""
    found = F.try_variant_get("geocode", "$.results[0]", "variant").isNotNull()
    carried = [c for c in landed.columns if c not in ("city", "geocode", "forecast")]
    return landed.where(found).select(
        F.initcap(F.trim("city")).alias("city"), *fields(WEATHER_FIELDS), F.lit(source).alias("source"),
        F.current_timestamp().alias("ingestion_time"), "geocode", "forecast", *carried)


def rate_rows(landed: DataFrame, targets=tuple(K.TARGET_CURRENCIES), source: str = K.RATES_SOURCE) -> DataFrame:
    """bronze_exchange_rates rows: one for each target currency in the
    payload's ``rates``, with a NULL rate and ``unread`` where it is no number."""
    spark = landed.sparkSession
    rates = F.try_variant_get(F.col("payload"), "$.rates", "variant").alias("_rates")
    each = (landed.select("*", *fields(RATES_FIELDS), rates)
            .lateralJoin(spark.tvf.variant_explode(F.col("_rates").outer())))
    rate = F.try_variant_get("value", "$", "double")
    odd = present(F.col("value")) & rate.isNull()
    return each.where(F.col("key").isin(list(targets))).select(
        F.coalesce("base_currency", F.lit(K.BASE_CURRENCY)).alias("base_currency"), F.col("key").alias("target_currency"),
        rate.alias("rate"), parse_update_time("updated").alias("timestamp"), F.lit(source).alias("source"),
        F.current_timestamp().alias("ingestion_time"),
        F.when(odd, F.array_append("unread", F.lit("rate"))).otherwise(F.col("unread")).alias("unread"), "payload")
