"""Report queries over the gold tables (the BI visuals as DataFrame jobs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.numbers import avg_money, exact_sum, wavg_money

# Decimals kept by sums over amounts that are not rounded to cents.
WIDE = 12

# FIXED VALUES: default aggregation of the fact table's columns in the BI
# model ("sum"; every other column is "none").
FACT_SUMMARIZE_SUM = ["booking_year", "booking_month", "star_rating", "nights", "adults", "children",
                      "total_amount", "room_price", "exchange_rate_to_eur", "total_amount_eur",
                      "avg_nightly_rate", "avg_nightly_rate_eur"]


def exclude(df: DataFrame, cond: Column, keep_null: bool = True) -> DataFrame:
    """Drop rows matching ``cond``.  BI exclude filters keep rows whose
    tested value is NULL; ``keep_null=False`` gives SQL's NOT IN."""
    return df.where(~F.coalesce(cond, F.lit(False)) if keep_null else ~cond)


def report_cards(fact: DataFrame) -> DataFrame:
    """KPI cards: average nightly EUR rate, booking count, EUR revenue."""
    return fact.agg(avg_money("avg_nightly_rate_eur").alias("avg_nightly_rate_eur"),
                    F.count("booking_id").alias("bookings"),
                    exact_sum("total_amount_eur").alias("total_revenue_eur"))


def report_rates_avg(city_dim: DataFrame) -> DataFrame:
    rates = [c for c in city_dim.columns if c.startswith("rate_")]
    return city_dim.agg(*[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in rates])


def _ranked_sum(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    return (df.groupBy(key).agg(F.round(F.sum(F.col(measure).try_cast(f"decimal(38,{WIDE})")), 2)
                                .cast("double").alias(name))
            .orderBy(F.col(name).desc_nulls_last(), F.col(key).asc_nulls_first()))


def report_country_revenue(fact: DataFrame) -> DataFrame:
    cond = F.col("hotel_type").isin(K.REPORT_COUNTRY_EXCLUDE_TYPES) | \
        F.col("country").isin(K.REPORT_COUNTRY_EXCLUDE_COUNTRIES)
    return _ranked_sum(exclude(fact, cond), "country", "total_amount", "total_amount")


def report_hotel_type_revenue(fact: DataFrame) -> DataFrame:
    cond = F.col("hotel_type").isin(K.REPORT_TYPE_EXCLUDE)
    return _ranked_sum(exclude(fact, cond), "hotel_type", "total_amount_eur", "total_amount_eur")


def report_city_revenue(kpi: DataFrame) -> DataFrame:
    return _ranked_sum(exclude(kpi, F.col("city").isin(K.REPORT_CITY_EXCLUDE)), "city",
                       "total_revenue_eur", "total_revenue_eur")


def report_city_table(kpi: DataFrame) -> DataFrame:
    """City table as the visual shows it (sums of averages and of rates)
    plus the bookings-weighted values those sums stand in for."""
    w = F.col("total_bookings")
    return (kpi.groupBy("city").agg(
        F.sum("total_bookings").alias("total_bookings"),
        exact_sum("avg_booking_value_eur").alias("sum_avg_booking_value_eur"),
        exact_sum("cancellation_rate", 1).alias("sum_cancellation_rate"),
        wavg_money("avg_booking_value_eur", w).alias("weighted_avg_booking_value_eur"),
        wavg_money("cancellation_rate", w, 1, 1).alias("weighted_cancellation_rate"))
        .orderBy(F.col("sum_cancellation_rate").asc_nulls_first(), F.col("city").asc_nulls_first()))


def report_monthly_trend(fact: DataFrame, dim_date_df: DataFrame) -> DataFrame:
    """Bookings per calendar year_month through the date dimension, counted
    by day before the join."""
    return monthly_from_days(fact.groupBy("booking_date").agg(F.count("booking_id").alias("bookings")), dim_date_df)


def monthly_from_days(days: DataFrame, dim_date_df: DataFrame) -> DataFrame:
    d = dim_date_df.select("date_key", "year_month")
    j = days.join(d, days.booking_date == d.date_key, "inner")
    return j.groupBy("year_month").agg(F.sum("bookings").alias("bookings")).orderBy("year_month")


def report_years(dim_date_df: DataFrame) -> DataFrame:
    return dim_date_df.select("year").distinct().orderBy("year")


def default_summarize(df: DataFrame, sum_cols=tuple(FACT_SUMMARIZE_SUM), by=()) -> DataFrame:
    """Apply each column's default aggregation ("sum"; "none" columns are
    group keys or left out), as a BI total row or per ``by`` group.  Values
    are summed as decimal(38,12): nothing of an amount is cut, and the total
    does not depend on the order partitions are combined in."""
    aggs = [exact_sum(c, WIDE).alias(f"sum_{c}")
            for c in sum_cols if c in df.columns]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def top_cities(df: DataFrame, n: int = 10, city_col: str = "city") -> DataFrame:
    """The n most frequent cities (NULL not counted); ties by name."""
    return (df.where(F.col(city_col).isNotNull()).groupBy(city_col).agg(F.count("*").alias("bookings"))
            .orderBy(F.col("bookings").desc(), F.col(city_col).asc()).limit(n))
