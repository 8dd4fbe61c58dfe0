"""Lookups: weather by city, exchange rates by currency, city dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import city_clean_dots, norm_city, norm_currency, usable_value
from .dedup import dedup_latest


def latest_weather(weather: DataFrame, city_col: str = "city", ts_col: str = "recorded_at",
                   tie=("temperature_c", "weather_code")) -> DataFrame:
    """One weather row per normalised city: the latest reading.

    The result has one row per distinct city, so it is small whatever the
    number of readings; the partial WindowGroupLimit keeps the shuffle small.
    """
    w = weather.select(norm_city(city_col).alias("w_city"), F.col("temperature_c"),
                       F.col("weather_code"), F.col(ts_col).alias("_ts"))
    return dedup_latest(w, ["w_city"], ["_ts"], list(tie)).drop("_ts")


def latest_rates(rates: DataFrame, ts_col: str = "timestamp", currency_col: str = "target_currency") -> DataFrame:
    """One rate per normalised currency: the latest quote (ties: lower rate)."""
    r = rates.select(norm_currency(currency_col).alias("r_currency"), F.col("rate").alias("rate"),
                     F.col(ts_col).alias("_ts"))
    return dedup_latest(r, ["r_currency"], ["_ts"], ["rate"]).drop("_ts")


def enrich_weather_rates(df: DataFrame, weather_lookup: DataFrame, rates_lookup: DataFrame,
                         base: str = K.BASE_CURRENCY, city_col: str = "city_clean",
                         currency_col: str = "currency") -> DataFrame:
    """Left-join weather by city and the rate by currency; the base currency
    gets rate 1.0.

    Pass written lookups (one row per city, one per currency): their sizes
    are then known before the join, and each is broadcast only below Spark's
    threshold.  Beyond it the join shuffles: rows without a city get a salted
    key that matches nothing, so they do not meet in one task, and cities that
    hold a large share of the rows are split by AQE's skew join.
    """
    w = weather_lookup.select("w_city", "temperature_c", "weather_code")
    r = rates_lookup.select("r_currency", F.col("rate").alias("exchange_rate_to_eur"))
    cur = norm_currency(currency_col)
    spread = F.xxhash64(*[F.col(c) for c in (["booking_id"] if "booking_id" in df.columns else df.columns)])
    key = F.coalesce(F.col(city_col), F.concat(F.lit("\u0000"), F.pmod(spread, F.lit(1024)).cast("string")))
    out = (df.withColumn("_wk", key).join(w, F.col("_wk") == w.w_city, "left")
           .join(r, cur == r.r_currency, "left")
           .drop("_wk", "w_city", "r_currency"))
    return out.withColumn("exchange_rate_to_eur",
                          F.when(cur == base, F.lit(1.0)).otherwise(F.col("exchange_rate_to_eur")))


def rates_pivot(rates_lookup: DataFrame, currencies=tuple(K.TARGET_CURRENCIES),
                base: str = K.BASE_CURRENCY) -> DataFrame:
    """All rates as columns of ONE row: rate_eur (1.0), rate_usd, ...

    A keyless aggregate yields exactly one row; missing currencies are NULL.
    """
    cols = [F.lit(1.0).alias(f"rate_{base.lower()}")]
    cols += [F.max(F.when(F.col("r_currency") == c, F.col("rate"))).alias(f"rate_{c.lower()}")
             for c in currencies]
    return rates_lookup.agg(*cols)


def distinct_cities(bookings: DataFrame) -> DataFrame:
    """Usable (city, country) pairs; prefers ``city_clean`` over ``city``."""
    city_col = "city_clean" if "city_clean" in bookings.columns else "city"
    return (bookings.select(city_clean_dots(city_col).alias("city"),
                            F.initcap(F.trim(F.col("country"))).alias("country"))
            .where(usable_value("city"))
            .distinct())


def city_dim(bookings: DataFrame, weather_lookup: DataFrame, rates_lookup: DataFrame,
             currencies=tuple(K.TARGET_CURRENCIES), base: str = K.BASE_CURRENCY) -> DataFrame:
    """silver_city_dim: distinct cities + latest weather + every rate as a column.

    The rates enter as ONE scalar subquery over the one-row pivot (a struct
    of all rates): Spark runs it once and inlines the values, no join.
    """
    cities = distinct_cities(bookings)
    w = weather_lookup.select("w_city", "temperature_c", "weather_code")
    joined = cities.join(w, cities.city == w.w_city, "left").drop("w_city")
    piv = rates_pivot(rates_lookup, currencies, base)
    names = [f"rate_{c.lower()}" for c in currencies]
    row = piv.select(F.struct(*names).alias("r")).scalar()   # one subquery, reused for every column
    rate_cols = [F.lit(1.0).alias(f"rate_{base.lower()}")] + [row.getField(n).alias(n) for n in names]
    return joined.select("city", "country", "temperature_c", "weather_code", *rate_cols)


def coverage_metrics(df: DataFrame, city_col: str = "city_clean", weather_col: str = "temperature_c") -> DataFrame:
    """total, filled city, matched weather and whole-number percentages in one pass."""
    agg = df.agg(F.count("*").alias("total_rows"),
                 F.count_if(F.col(city_col).isNotNull() & (F.col(city_col) != K.UNKNOWN)).alias("city_filled"),
                 F.count_if(F.col(weather_col).isNotNull()).alias("weather_matched"))
    pct = lambda c: F.when(F.col("total_rows") > 0,
                           F.floor(F.col(c) * 100 / F.col("total_rows"))).cast("bigint")
    return agg.select("total_rows", "city_filled", "weather_matched",
                      pct("city_filled").alias("city_filled_pct"),
                      pct("weather_matched").alias("weather_matched_pct"))


def null_blank_profile(before: DataFrame, after: DataFrame, col: str) -> DataFrame:
    """NULL and blank counts of one column before and after a step."""
    def prof(df, stage):
        return df.agg(F.lit(stage).alias("stage"),
                      F.count_if(F.col(col).isNull()).alias("null_rows"),
                      F.count_if(F.trim(F.col(col)) == "").alias("blank_rows"),
                      F.count("*").alias("total_rows"))
    return prof(before, "before").unionByName(prof(after, "after"))


def city_sources(silver: DataFrame | None, bronze: DataFrame | None,
                 defaults=tuple(K.DEFAULT_CITIES)) -> DataFrame:
    """Cities to enrich: usable silver cities; if there are none, all distinct
    bronze cities; if none, the defaults.  Values are stripped and
    deduplicated.  Each source is computed, and its few distinct names
    written, only when the ones before it gave none."""
    from ..sources.tables import materialize
    spark = (silver if silver is not None else bronze).sparkSession
    found = []
    if silver is not None:
        col = "city_clean" if "city_clean" in silver.columns else "city"
        found.append(lambda: silver.select(F.col(col).alias("city")).where(usable_value("city")))
    if bronze is not None:
        found.append(lambda: bronze.select("city").where(F.col("city").isNotNull()))
    for source in found:
        cities = materialize(source().select(F.trim("city").alias("city")).where(F.col("city") != "").distinct(),
                             "city_candidates")
        if not cities.isEmpty():
            return cities
    return spark.createDataFrame([(c,) for c in defaults], "city string").distinct()
