"""Silver by landings: each landing changes only the buckets it touches.

The state below one folder of shared storage:

- ``latest``: the latest standardised booking of each id, text as landed,
  in hash buckets of the booking id;
- ``hotels``: the hotel attributes known so far, a folder for each landing
  (the earlier ones may go once no job reads them), with the order value of the
  booking they come from, so that the smallest one wins over all landings;
- ``silver``: the silver bookings, in the same buckets;
- ``kpi``: the partial KPI of each bucket's bookings, which add up to the KPI
  of all (``kpi``).  A booking that is replaced lies in a bucket that is
  replaced, so nothing is ever subtracted.

A landing is merged into ``latest`` and ``hotels``.  Silver is computed anew
for the buckets with a booking of the landing and for those with a booking
that lacks an attribute of a hotel whose attributes changed.  After any
landings silver equals the full run over all of them with the same lookups;
new weather or rates reach older bookings with ``refresh``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import safe_timestamp
from ..functions.text import digits_only, is_blank_or_unknown
from ..operators import clean, columns, enrich, gold
from ..sources import bucketed
from ..sources import schemas as S
from ..sources.tables import materialize, overwrite_table, read_or_empty, scratch
from . import medallion as M

BUCKETS = 64

# The silver columns of the fact table, for a state before its first landing.
FACT_SOURCE = ("booking_id string, hotel_id string, customer_id string, booking_date date, city_clean string, "
               "country string, hotel_name string, hotel_type string, star_rating int, room_type string, nights double, "
               "adults int, children double, booking_status string, source_system string, booking_channel string, "
               "currency string, total_amount double, room_price double, exchange_rate_to_eur double, "
               "temperature_c double, weather_code bigint")


@dataclass
class Landed:
    """Buckets that a landing compared in ``latest`` and replaced in silver."""
    compared: list[int]
    replaced: list[int]


def standardised(b: M.Bronze) -> DataFrame:
    """Batch and stream of a landing under one set of names, with the parsed
    ingestion time."""
    df = columns.standardize_names(columns.union_by_name(b.batch, b.stream))
    df = columns.reconcile_columns(df, "total_amount", ("total_price", "paid_amount"), "coalesce")
    return columns.dedup_column_names(df).withColumn("_ingest_ts", safe_timestamp("ingestion_time"))


def merge_hotels(spark: SparkSession, state: str, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All hotels known after the landing, and the ids whose attributes
    changed."""
    new = columns.hotel_dimension(columns.as_strings(batch), keep_order=True)
    old = read_or_empty(spark, current(spark, state), new.schema)
    value = F.struct(*[c for c in new.columns if c not in ("dim_id", "dim_order")])
    both = old.withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False)))
    merged = materialize(both.groupBy("dim_id").agg(
        F.min_by(value, "dim_order").alias("now"), F.min("dim_order").alias("dim_order"),
        F.max(F.when(F.col("_old"), value)).alias("before")), "hotels")
    changed = merged.where(~F.col("now").eqNullSafe(F.col("before"))).select("dim_id")
    return merged.select("dim_id", "now.*", "dim_order"), changed


def current(spark: SparkSession, state: str) -> str:
    """The folder of the hotels; each landing writes a new one and notes its
    name last, so a lost landing leaves the old one in force."""
    at = read_or_empty(spark, f"{state}/hotels/_current", "folder string", "json").first()
    return f"{state}/hotels/{at[0] if at else 'none'}"


def silver_of(rows: DataFrame, hotels: DataFrame, found: tuple) -> DataFrame:
    """Silver rows of latest bookings; per row, so any subset of buckets gives
    the rows of the full run."""
    meta = [c for c in columns.HOTEL_META_COLS if f"dim_{c}" in hotels.columns]
    df = columns.fill_from_lookup(rows.drop("_ingest_ts", bucketed.BUCKET), hotels.drop("dim_order"), "hotel_id", meta)
    df = columns.default_columns(df, columns.SILVER_DEFAULTS)
    df = clean.add_city_clean(clean.type_cast_filter(df))
    df = clean.impute_prices(enrich.enrich_weather_rates(df, *found))
    return clean.universal_clean(df, drop_midnight=False)


def lacking(rows: DataFrame, changed: DataFrame, meta: list[str]) -> DataFrame:
    """Buckets of bookings that take an attribute from a changed hotel."""
    blank = reduce(lambda a, b: a | b, [is_blank_or_unknown(c) for c in meta])
    return (rows.where(blank).select(bucketed.BUCKET, digits_only("hotel_id").alias("dim_id")).distinct()
            .join(changed, "dim_id", "left_semi"))


def land(spark: SparkSession, state: str, b: M.Bronze, found: tuple | None = None, buckets: int = BUCKETS,
         refresh: bool = False) -> Landed:
    """Takes one landing into the state.  ``found``: the written lookups of
    weather and rates."""
    with scratch(spark):
        found = found or M.lookups(b)
        rows = materialize(standardised(b), "landing")
        compared = bucketed.merge_latest(rows, f"{state}/latest", ["booking_id"], ["_ingest_ts"], ["source_file"], buckets)
        n = bucketed.layout(spark, f"{state}/latest", buckets)
        hotels, changed = merge_hotels(spark, state, b.batch)
        latest = bucketed.read_buckets(spark, f"{state}/latest", rows.schema)
        meta = [c for c in columns.HOTEL_META_COLS if c in rows.columns]
        replaced = list(range(n)) if refresh else sorted(
            {*compared, *bucketed.buckets_in(lacking(latest, changed, meta))})
        if replaced:
            now = bucketed.read_buckets(spark, f"{state}/latest", rows.schema, replaced)
            silver = silver_of(now, hotels, found).withColumn(bucketed.BUCKET, bucketed.bucket_of(["booking_id"], n))
            bucketed.replace_buckets(silver, f"{state}/silver", replaced)
            silver = bucketed.read_buckets(spark, f"{state}/silver", silver.drop(bucketed.BUCKET).schema, replaced)
            partials = gold.kpi_partials(gold.fact_bookings(silver).withColumn(
                bucketed.BUCKET, bucketed.bucket_of(["booking_id"], n)), bucketed.BUCKET)
            bucketed.replace_buckets(partials, f"{state}/kpi", replaced)
        version = f"v-{uuid.uuid4().hex[:12]}"
        overwrite_table(hotels, f"{state}/hotels/{version}")
        spark.createDataFrame([(version,)], "folder string").coalesce(1).write.mode("overwrite").json(
            f"{state}/hotels/_current")
    return Landed(compared, replaced)


def silver(spark: SparkSession, state: str) -> DataFrame:
    """The silver table, without the clock columns that are midnight on every
    row."""
    full = bucketed.read_buckets(spark, f"{state}/silver", S.STREAM_TABLE_SCHEMA).drop(bucketed.BUCKET)
    return clean.drop_constant_time_cols(full, M.time_columns(full))


def kpi(spark: SparkSession, state: str, **how) -> DataFrame:
    """The KPI groups of all bookings landed so far, from the stored partials
    alone; ``how`` as for :func:`gold.kpi_from_partials`."""
    none = gold.kpi_partials(gold.fact_bookings(spark.createDataFrame([], FACT_SOURCE)))
    return gold.kpi_from_partials(bucketed.read_buckets(spark, f"{state}/kpi", none.schema), **how)
