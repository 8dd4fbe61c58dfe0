"""Gold layer: fact table, dimensions, revenue KPIs, star join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.numbers import avg_money, exact_sum, hotel_tier
from ..functions.text import usable_value
from .dedup import dedup_by_key, dedup_latest, surrogate_key

HOTEL_ATTRS = ["hotel_name", "city", "country", "hotel_type", "star_rating", "latitude", "longitude"]
RATE_COLS = [f"rate_{c.lower()}" for c in K.CURRENCIES]


def fact_bookings(silver: DataFrame, min_date: str = K.FACT_MIN_DATE,
                  rate_direction: str = "multiply") -> DataFrame:
    """gold_fact_bookings: sentinel dates and keyless rows filtered out,
    EUR amounts and nightly rates derived.

    rate_direction="multiply" reproduces EUR = amount x rate (the original
    formula, its test fixes 100 x 34.5 = 3450); "divide" treats the rate as
    units of currency per EUR (NULL for a rate of zero).
    """
    rate = F.coalesce(F.col("exchange_rate_to_eur"), F.lit(1.0))
    amt = F.col("total_amount")
    eur = amt * rate if rate_direction == "multiply" else F.try_divide(amt, rate)
    nights = F.col("nights")
    cols = [
        F.col("booking_id"), F.col("hotel_id"), F.col("customer_id"),
        F.col("booking_date"),
        F.year("booking_date").alias("booking_year"),
        F.month("booking_date").alias("booking_month"),
        F.col("city_clean").alias("city"), F.col("country"),
        F.col("hotel_name"), F.col("hotel_type"), F.col("star_rating"),
        F.col("room_type"), nights, F.col("adults"), F.col("children"),
        F.col("booking_status"), F.col("source_system"),
    ]
    if "booking_channel" in silver.columns:
        cols.append(F.col("booking_channel"))
    cols += [
        F.col("currency"), amt, F.col("room_price"),
        rate.alias("exchange_rate_to_eur"),
        F.round(eur, 2).alias("total_amount_eur"),
        F.when(nights > 0, F.round(amt / nights, 2)).otherwise(amt).alias("avg_nightly_rate"),
        F.when(nights > 0, F.round(eur / nights, 2)).otherwise(F.round(eur, 2)).alias("avg_nightly_rate_eur"),
        F.col("temperature_c"), F.col("weather_code"),
    ]
    return (silver.where((F.col("booking_date") > F.lit(min_date).cast("date"))
                         & F.col("hotel_id").isNotNull() & F.col("booking_id").isNotNull())
            .select(*cols))


def city_rows(city_dim: DataFrame) -> DataFrame:
    """Usable cities, one row each."""
    return dedup_by_key(city_dim.where(usable_value("city") & F.col("city").isNotNull()), ["city"], ["country"])


def dim_city(city_dim: DataFrame, partitions: int | None = None) -> DataFrame:
    """gold_dim_city: usable cities, one row each, surrogate key in city
    order, missing rates as 0."""
    c = city_rows(city_dim)
    rates = [F.coalesce(F.col(r), F.lit(0.0)).alias(r) for r in RATE_COLS if r in city_dim.columns]
    c = c.select("city", "country", "temperature_c", "weather_code", *rates)
    keyed = surrogate_key(c, ["city"], "city_key", partitions)
    keyed = keyed.withColumn("city_key", F.col("city_key").cast("int"))
    return keyed.select("city_key", "city", "country", "temperature_c", "weather_code", *[r for r in RATE_COLS
                                                                                          if r in keyed.columns])


def dim_hotel(silver: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    """gold_dim_hotel: latest attributes per hotel (booking_date desc,
    booking_id as tie-break) plus the tier.  ``exclude_unknown`` also drops
    the 'Unknown' id that short ids merge into under the parity rules."""
    keep = F.col("hotel_id").isNotNull()
    if exclude_unknown:
        keep = keep & (F.col("hotel_id") != K.UNKNOWN)
    s = silver.where(keep).select(
        "hotel_id", "booking_id", "booking_date", "hotel_name", F.col("city_clean").alias("city"),
        "country", "hotel_type", "star_rating", "latitude", "longitude")
    latest = dedup_latest(s, ["hotel_id"], ["booking_date"], ["booking_id"])
    return latest.select("hotel_id", *HOTEL_ATTRS, hotel_tier("star_rating").alias("hotel_tier"))


def dim_hotel_first_value(silver: DataFrame) -> DataFrame:
    """The SQL model's dim_hotel (FIRST_VALUE of every attribute over the
    hotel's bookings by date desc, then DISTINCT) as one aggregate.

    ``min_by`` over a (negated date, booking_id) key returns the same row as
    the window with the same tie-break, but Spark combines it map-side: a hotel
    holding a third of all bookings costs one row per map task, not one task
    holding all of them.
    """
    src = {"city": "city_clean"}
    packed = F.struct(*[F.col(src.get(a, a)).alias(a) for a in HOTEL_ATTRS])
    order = F.struct(F.coalesce(-F.unix_date("booking_date"), F.lit(2 ** 31 - 1)).alias("d"),
                     F.col("booking_id").alias("b"))
    firsts = (silver.where(F.col("hotel_id").isNotNull())
              .groupBy("hotel_id").agg(F.min_by(packed, order).alias("v"))
              .select("hotel_id", "v.*"))
    return firsts.select("hotel_id", *HOTEL_ATTRS, hotel_tier("star_rating").alias("hotel_tier"))


def _kpi_measures(cancelled, guard_zero: bool):
    n = F.count("*")
    cancel = F.sum(F.when(F.col("booking_status").isin(list(cancelled)), 1).otherwise(0)) * 100.0
    rate = cancel / (F.nullif(n, F.lit(0)) if guard_zero else n)
    return [
        n.alias("total_bookings"),
        exact_sum("total_amount_eur").alias("total_revenue_eur"),
        avg_money("total_amount_eur").alias("avg_booking_value_eur"),
        avg_money("avg_nightly_rate_eur").alias("avg_nightly_rate_eur"),
        F.round(F.avg("nights"), 1).alias("avg_nights"),
        F.sum(F.col("adults") + F.coalesce(F.col("children"), F.lit(0))).cast("double").alias("total_guests"),
        F.round(rate, 1).cast("double").alias("cancellation_rate"),
    ]


KPI_KEYS = ["city", "country", "booking_year", "booking_month", "hotel_type"]


def kpi_groups(fact: DataFrame, cancelled=tuple(K.CANCELLED_LABELS)) -> DataFrame:
    """The KPI measures of every group (partial aggregation map-side)."""
    return fact.groupBy(*KPI_KEYS).agg(*_kpi_measures(cancelled, guard_zero=False))


def kpi_channel_groups(fact: DataFrame, cancelled=("Canceled",)) -> DataFrame:
    """The SQL model's measures: NULLIF guard and distinct channel count."""
    return fact.groupBy(*KPI_KEYS).agg(*_kpi_measures(cancelled, guard_zero=True),
                                       F.countDistinct("booking_channel").alias("channel_count"))


PARTIAL_KEYS = [*KPI_KEYS, "booking_channel", "booking_status"]


def kpi_partials(fact: DataFrame, *more: str) -> DataFrame:
    """The KPI in a form that adds up: counts and exact sums of every group,
    channel and status.  Partials of disjoint sets of bookings, in one table,
    give the KPI of their union (:func:`kpi_from_partials`).  Averages stay
    sum and count; channels stay rows, so that their distinct number is exact
    after any merge, and any labels can count as cancelled later."""
    cents = lambda c: F.col(c).try_cast("decimal(38,2)")
    total, rate = cents("total_amount_eur"), cents("avg_nightly_rate_eur")
    return fact.groupBy(*more, *PARTIAL_KEYS).agg(
        F.count("*").alias("bookings"),
        F.sum(total).alias("revenue"), F.count(total).alias("revenue_rows"),
        F.sum(rate).alias("rates"), F.count(rate).alias("rate_rows"),
        F.sum("nights").alias("nights"), F.count("nights").alias("night_rows"),
        F.sum(F.col("adults") + F.coalesce(F.col("children"), F.lit(0))).cast("double").alias("guests"))


def kpi_from_partials(partials: DataFrame, cancelled=tuple(K.CANCELLED_LABELS), channels: bool = False) -> DataFrame:
    """The measures of :func:`kpi_groups` or, with ``channels``, of
    :func:`kpi_channel_groups`, from stored partials: equal to a run over the
    bookings themselves."""
    mean = lambda s, n: F.try_divide(F.sum(s), F.sum(n).cast("decimal(20,0)"))
    n = F.sum("bookings")
    gone = F.sum(F.when(F.col("booking_status").isin(list(cancelled)), F.col("bookings")).otherwise(0)) * 100.0
    return partials.groupBy(*KPI_KEYS).agg(
        n.alias("total_bookings"),
        F.sum("revenue").cast("double").alias("total_revenue_eur"),
        F.round(mean("revenue", "revenue_rows"), 2).cast("double").alias("avg_booking_value_eur"),
        F.round(mean("rates", "rate_rows"), 2).cast("double").alias("avg_nightly_rate_eur"),
        F.round(F.try_divide(F.sum("nights"), F.sum("night_rows")), 1).cast("double").alias("avg_nights"),
        F.sum("guests").alias("total_guests"),
        F.round(gone / n, 1).cast("double").alias("cancellation_rate"),
        *([F.countDistinct("booking_channel").alias("channel_count")] if channels else []))


def with_city_weather(groups: DataFrame, cities: DataFrame) -> DataFrame:
    """Attach the city's weather to KPI groups.  The city side is
    deduplicated, so the join cannot multiply them."""
    city = dedup_by_key(cities.select("city", F.col("temperature_c").alias("city_temperature_c"),
                                      F.col("weather_code").alias("city_weather_code")), ["city"])
    return groups.join(city, on="city", how="left")


def kpi_revenue(fact: DataFrame, dim_city_df: DataFrame, cancelled=tuple(K.CANCELLED_LABELS)) -> DataFrame:
    """gold_kpi_revenue: aggregate first, then join the few groups."""
    return with_city_weather(kpi_groups(fact, cancelled), dim_city_df)


def kpi_revenue_channel(fact: DataFrame, dim_city_df: DataFrame,
                        cancelled=("Canceled",)) -> DataFrame:
    """The SQL model's KPI.  A city has one weather row, so grouping before
    the join gives the groups of the model, which joins first."""
    return with_city_weather(kpi_channel_groups(fact, cancelled), dim_city_df)


def top_revenue(kpi: DataFrame, n: int = 10) -> DataFrame:
    """Top-N KPI groups by revenue (TakeOrderedAndProject: a per-partition
    top-N, then a merge of n rows per partition)."""
    return kpi.orderBy(F.col("total_revenue_eur").desc_nulls_last(), *[F.col(k).asc() for k in KPI_KEYS]).limit(n)


def tier_histogram(dim_hotel_df: DataFrame) -> DataFrame:
    return dim_hotel_df.groupBy("hotel_tier").agg(F.count("*").alias("hotels"))


def star_join(fact: DataFrame, dim_city_df: DataFrame, dim_hotel_df: DataFrame,
              dim_date_df: DataFrame) -> DataFrame:
    """fact -> dim_city (city), dim_hotel (hotel_id), dim_date (booking_date):
    many-to-one left joins, so the fact row count is preserved."""
    c = dim_city_df.select("city", "city_key", F.col("temperature_c").alias("city_temperature_c"))
    h = dim_hotel_df.select("hotel_id", "hotel_tier", F.col("hotel_name").alias("dim_hotel_name"))
    d = dim_date_df.select("date_key", "year_quarter", "year_month", "is_weekend")
    return (fact.join(c, on="city", how="left")
            .join(h, on="hotel_id", how="left")
            .join(d, fact.booking_date == d.date_key, "left")
            .select("booking_id", "hotel_id", "city", "booking_date", "total_amount_eur",
                    "city_key", "city_temperature_c", "hotel_tier", "dim_hotel_name",
                    "year_quarter", "year_month", "is_weekend"))


def hotel_join(fact: DataFrame, dim_hotel_df: DataFrame) -> DataFrame:
    """fact -> dim_hotel (hotel_id), many-to-one.  Between tables bucketed by
    hotel (``tables.write_bucketed``) neither side is shuffled, however large
    the dimension."""
    h = dim_hotel_df.select("hotel_id", "hotel_tier", F.col("hotel_name").alias("dim_hotel_name"))
    return fact.join(h, "hotel_id", "left")
