"""The gold layer as SQL models.

A model is SQL text that names the tables it reads in braces: layer inputs
or other models.  ``run_models`` gives every model to Spark SQL after those it
reads.  Where the SQL twin of a table differs from the DataFrame operator, the
model keeps the SQL meaning: its city dimension has coordinates and humidity
and one row for each (city, country), and its KPI joins that dimension before
it aggregates, so a city of two countries counts its bookings twice.
"""

from __future__ import annotations

from graphlib import TopologicalSorter
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K
from ..functions.text import norm_city, usable_value
from ..operators import enrich
from ..operators.dedup import dedup_latest, surrogate_key

_RATES = ", ".join(f"coalesce(rate_{c.lower()}, 0D) AS rate_{c.lower()}" for c in K.TARGET_CURRENCIES)
_EUR = "total_amount * coalesce(exchange_rate_to_eur, 1D)"
_HOTEL = ["hotel_name", "city", "country", "hotel_type", "star_rating", "latitude", "longitude"]
_MONEY = "cast(round(avg(cast({c} AS DECIMAL(38,2))), 2) AS DOUBLE)"

MODELS = {
    "fact_bookings": f"""
SELECT booking_id, hotel_id, customer_id, booking_date, year(booking_date) AS booking_year,
  month(booking_date) AS booking_month, city_clean AS city, country, hotel_name, hotel_type, star_rating, room_type,
  nights, adults, children, booking_status, source_system, booking_channel, currency, total_amount, room_price,
  coalesce(exchange_rate_to_eur, 1D) AS exchange_rate_to_eur, round({_EUR}, 2) AS total_amount_eur,
  if(nights > 0, round(total_amount / nights, 2), total_amount) AS avg_nightly_rate,
  if(nights > 0, round({_EUR} / nights, 2), round({_EUR}, 2)) AS avg_nightly_rate_eur, temperature_c, weather_code
FROM {{silver_bookings}}
WHERE booking_date > DATE '{K.FACT_MIN_DATE}' AND hotel_id IS NOT NULL AND booking_id IS NOT NULL""",
    # the key comes numbered: a window over all cities would run in one task
    "dim_city": f"""
SELECT cast(city_key AS INT) AS city_key, city, country, latitude, longitude, temperature_c, humidity, weather_code,
  {_RATES}
FROM {{numbered_cities}}""",
    "dim_hotel": f"""
SELECT hotel_id, newest.*, CASE WHEN newest.star_rating >= 4 THEN 'Premium' WHEN newest.star_rating >= 3 THEN 'Standard'
  ELSE 'Budget' END AS hotel_tier
FROM (SELECT hotel_id, min_by(struct({", ".join("city_clean AS city" if c == "city" else c for c in _HOTEL)}),
    struct(coalesce(-unix_date(booking_date), 2147483647) AS age, booking_id)) AS newest
  FROM {{silver_bookings}} WHERE hotel_id IS NOT NULL GROUP BY hotel_id)""",
    "dim_date": """
SELECT d AS date_key, year(d) AS year, month(d) AS month, day(d) AS day, quarter(d) AS quarter,
  date_format(d, 'MMMM') AS month_name, date_format(d, 'MMM') AS month_short, date_format(d, 'EEEE') AS day_name,
  date_format(d, 'EEE') AS day_short, weekofyear(d) AS week_of_year, dayofweek(d) AS day_of_week,
  dayofyear(d) AS day_of_year, dayofweek(d) IN (1, 7) AS is_weekend, year(d) || '-Q' || quarter(d) AS year_quarter,
  date_format(d, 'yyyy-MM') AS year_month
FROM (SELECT explode(sequence(make_date(a, 1, 1), make_date(b, 12, 31))) AS d
  FROM (SELECT min(booking_year) AS a, max(booking_year) AS b FROM {fact_bookings}) WHERE a IS NOT NULL)""",
    "kpi_revenue": f"""
SELECT f.city, f.country, f.booking_year, f.booking_month, f.hotel_type, count(*) AS total_bookings,
  cast(sum(try_cast(f.total_amount_eur AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue_eur,
  {_MONEY.format(c="f.total_amount_eur")} AS avg_booking_value_eur,
  {_MONEY.format(c="f.avg_nightly_rate_eur")} AS avg_nightly_rate_eur, round(avg(f.nights), 1) AS avg_nights,
  cast(sum(f.adults + coalesce(f.children, 0)) AS DOUBLE) AS total_guests,
  round(count_if(f.booking_status = 'Canceled') * 100D / nullif(count(*), 0), 1) AS cancellation_rate,
  count(DISTINCT f.booking_channel) AS channel_count, c.temperature_c AS city_temperature_c,
  c.weather_code AS city_weather_code
FROM {{fact_bookings}} f LEFT JOIN {{dim_city}} c ON f.city = c.city
GROUP BY f.city, f.country, f.booking_year, f.booking_month, f.hotel_type, c.temperature_c, c.weather_code""",
}


def reads(model: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(MODELS[model]) if name}


def run_models(spark: SparkSession, inputs: dict[str, DataFrame], wanted=tuple(MODELS)) -> dict[str, DataFrame]:
    """The models ``wanted`` and those they read, lazily, each after its
    sources; a circle among them is an error."""
    tables, need, open_ = dict(inputs), {}, list(wanted)
    while open_:
        m = open_.pop()
        if m not in need and m in MODELS:
            need[m] = reads(m)
            open_ += need[m]
    for m in TopologicalSorter(need).static_order():
        if m in MODELS:
            tables[m] = spark.sql(MODELS[m], **{n: tables[n] for n in reads(m)})
    return {m: tables[m] for m in need}


def numbered_cities(bookings: DataFrame, weather: DataFrame, rates_lookup: DataFrame) -> DataFrame:
    """Each (city, country) of the bookings with the latest whole reading of
    the city, every rate, and a key in the order of city and country."""
    of_reading = ["temperature_c", "weather_code", "humidity", "latitude", "longitude"]
    w = dedup_latest(weather.select(norm_city("city").alias("w_city"), "recorded_at", *of_reading),
                     ["w_city"], ["recorded_at"], of_reading).drop("recorded_at")
    lean = enrich.city_dim(bookings, w, rates_lookup).drop("temperature_c", "weather_code")
    cities = lean.where(usable_value("city")).join(w, lean.city == w.w_city, "left").drop("w_city")
    return surrogate_key(cities, ["city", "country"], "city_key")
