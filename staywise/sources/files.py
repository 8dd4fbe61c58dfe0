"""File sources: CSV landings, landed API JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from . import schemas as S


def ingest_csv(spark: SparkSession, path: str, schema=None, infer: bool = True) -> DataFrame:
    """Header CSV -> bronze rows tagged with load time and source file.

    Without ``schema`` types are inferred (an extra pass over the data, and
    leading zeros or plus signs of ids and phones are lost); ``infer=False``
    leaves every column the text that landed.
    """
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", str(infer).lower())
    df = r.csv(path)
    return df.select("*", F.current_timestamp().alias("ingestion_time"),
                     F.col("_metadata.file_path").alias("source_file"))


def landed_text(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Landed files as whole texts: column ``name`` and ``key``, the file's
    name without folder and ending."""
    key = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[A-Za-z0-9]+)*$", 1)
    return spark.read.text(path, wholetext=True).select(F.url_decode(key).alias("key"), F.col("value").alias(name))


def read_weather_landing(spark: SparkSession, geocode: str, forecast: str) -> DataFrame:
    """Payloads of :func:`flatten_weather` from two folders of landed JSON
    files, one file per city, named after it."""
    g = landed_text(spark, geocode, "geocode_json").withColumnRenamed("key", "city")
    f = landed_text(spark, forecast, "weather_json").withColumnRenamed("key", "city")
    return g.join(f, "city", "left")


def read_rates_landing(spark: SparkSession, path: str) -> DataFrame:
    """Payloads of :func:`explode_rates` from a folder of landed JSON files."""
    return landed_text(spark, path, "payload").select("payload")


def unread_files(spark: SparkSession, paths, column: str = "city") -> DataFrame:
    """The files that :func:`multi_file_scan` got nothing from (unreadable, or
    without a row): file, n_bytes."""
    listed = spark.read.format("binaryFile").load(paths).select(
        F.regexp_replace("path", "^file:/+", "/").alias("file"), F.col("length").alias("n_bytes"))
    seen = (spark.read.option("header", "true").option("ignoreCorruptFiles", "true").csv(paths)
            .select(F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), "^file:/+", "/").alias("file"))
            .distinct())
    return listed.join(seen, "file", "left_anti")


def multi_file_scan(spark: SparkSession, paths, column: str = "city") -> DataFrame:
    """One column from many same-shaped CSV files; unreadable files skipped
    (:func:`unread_files` lists them)."""
    return (spark.read.option("header", "true").option("ignoreCorruptFiles", "true")
            .option("mode", "PERMISSIVE").csv(paths).select(column))


def flatten_weather(payloads: DataFrame, city_col: str = "city", geocode_col: str = "geocode_json",
                    weather_col: str = "weather_json", source: str = K.WEATHER_SOURCE) -> DataFrame:
    """Landed geocode + forecast JSON -> bronze_weather rows.

    Cities without a geocode hit, or with a missing current reading, are
    skipped (use :func:`weather_skip_counts` for the count).  ``get(arr, 0)``
    instead of ``arr[0]``: an empty array is NULL, not an error under ANSI.
    """
    g = F.from_json(F.col(geocode_col), S.GEOCODE_SCHEMA)
    w = F.from_json(F.col(weather_col), S.FORECAST_SCHEMA)
    df = payloads.select(F.col(city_col).alias("_city"), F.get(g["results"], 0).alias("geo"),
                         w["current"].alias("cur"), F.current_timestamp().alias("_now"))
    ok = (F.col("geo").isNotNull() & F.col("cur.temperature_2m").isNotNull()
          & F.col("cur.relative_humidity_2m").isNotNull() & F.col("cur.weather_code").isNotNull())
    return df.where(ok).select(
        F.initcap(F.trim(F.col("_city"))).alias("city"),
        F.col("geo.country").alias("country_api"),
        F.col("geo.latitude").alias("latitude"), F.col("geo.longitude").alias("longitude"),
        F.col("cur.temperature_2m").alias("temperature_c"),
        F.col("cur.relative_humidity_2m").alias("humidity"),
        F.col("cur.weather_code").alias("weather_code"),
        F.try_to_timestamp(F.col("cur.time")).alias("recorded_at"),
        F.lit(source).alias("source"),
        F.col("_now").alias("ingestion_time"))


def weather_skip_counts(payloads: DataFrame, geocode_col: str = "geocode_json",
                        weather_col: str = "weather_json") -> DataFrame:
    """Cities, those without a geocode hit, and those found whose current
    reading lacks a temperature, humidity or code."""
    g = F.from_json(F.col(geocode_col), S.GEOCODE_SCHEMA)
    w = F.from_json(F.col(weather_col), S.FORECAST_SCHEMA) if weather_col in payloads.columns else None
    found = F.get(g["results"], 0).isNotNull()
    out = [F.count("*").alias("cities"), F.count_if(~found).alias("not_found")]
    if w is not None:
        cur = w["current"]
        lacking = (cur["temperature_2m"].isNull() | cur["relative_humidity_2m"].isNull()
                   | cur["weather_code"].isNull())
        out.append(F.count_if(found & lacking).alias("missing_reading"))
    return payloads.agg(*out)


def parse_update_time(c) -> F.Column:
    """RFC-1123 ('Mon, 01 Jan 2024 00:00:01 +0000') with an ISO fallback."""
    c = F.col(c) if isinstance(c, str) else c
    rfc = F.try_to_timestamp(F.substring(c, 6, 64), F.lit("dd MMM yyyy HH:mm:ss Z"))
    return F.coalesce(rfc, F.try_to_timestamp(c))


def explode_rates(payloads: DataFrame, targets=tuple(K.TARGET_CURRENCIES), payload_col: str = "payload",
                  source: str = K.RATES_SOURCE) -> DataFrame:
    """Landed rates JSON -> bronze_exchange_rates rows for the target
    currencies (base defaults to EUR)."""
    p = F.from_json(F.col(payload_col), S.RATES_SCHEMA)
    df = payloads.select(p.alias("p"))
    return (df.select(F.coalesce(F.col("p.base_code"), F.lit(K.BASE_CURRENCY)).alias("base_currency"),
                      parse_update_time(F.col("p.time_last_update_utc")).alias("timestamp"),
                      F.explode(F.col("p.rates")).alias("target_currency", "rate"))
            .where(F.col("target_currency").isin(list(targets)))
            .select("base_currency", "target_currency", F.col("rate").cast("double").alias("rate"),
                    "timestamp", F.lit(source).alias("source"),
                    F.current_timestamp().alias("ingestion_time")))
