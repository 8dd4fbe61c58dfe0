"""The medallion jobs as compositions of operators.

``silver_bookings`` / ``city_dim_table`` / ``gold_tables`` are lazy plans;
:func:`run_layers` writes each layer to shared storage and reads it back,
which cuts the lineage between layers (a lost executor then recomputes from
the last written layer, not from the raw files).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.numbers import safe_timestamp
from ..operators import calendar as cal
from ..operators import clean, columns, dedup, enrich, gold
from ..sources import files
from ..sources import schemas as S
from ..sources.tables import materialize, overwrite_if_nonempty, overwrite_table, read_or_empty, scratch
from . import testdata as td


@dataclass
class Bronze:
    batch: DataFrame
    stream: DataFrame
    weather: DataFrame     # readings (many per city)
    rates: DataFrame       # quotes (many per currency)


def bronze_from_testdata(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(td.bronze_batch(spark, sf_dir), td.bronze_stream(spark, sf_dir),
                  td.weather_readings(spark, sf_dir), td.rate_quotes(spark, sf_dir))


def union_and_fill(b: Bronze) -> DataFrame:
    """U1 + J1/P5: union batch and stream, fill hotel attributes."""
    raw = columns.union_by_name(b.batch, b.stream)
    return columns.hotel_lookup_fill(raw, columns.as_strings(b.batch))


def standardized(b: Bronze, reconcile: str = "coalesce") -> DataFrame:
    """P1-P3 on the union."""
    df = columns.standardize_names(columns.union_by_name(b.batch, b.stream))
    df = columns.reconcile_columns(df, "total_amount", ("total_price", "paid_amount"), reconcile)
    return columns.dedup_column_names(df)


def deduplicated(b: Bronze, reconcile: str = "coalesce") -> DataFrame:
    """W1: latest row per booking_id by parsed ingestion time.  Hotel
    attributes take no part in the choice, so only rows that stay are filled."""
    df = standardized(b, reconcile).withColumn("_ingest_ts", safe_timestamp("ingestion_time"))
    df = dedup.dedup_latest(df, ["booking_id"], ["_ingest_ts"], ["source_file"]).drop("_ingest_ts")
    return columns.hotel_lookup_fill(df, columns.as_strings(b.batch))


def lookups(b: Bronze) -> tuple[DataFrame, DataFrame]:
    """The weather row of each city and the rate of each currency, written:
    their consumers then know how small they are, or are not."""
    return (materialize(enrich.latest_weather(b.weather), "weather_lookup"),
            materialize(enrich.latest_rates(b.rates), "rates_lookup"))


def enriched(b: Bronze, reconcile: str = "coalesce", found: tuple | None = None, parity: bool = False) -> DataFrame:
    """P4, C11, P6, C10, J2, J3, C12.  ``found``: the written lookups."""
    df = columns.default_columns(deduplicated(b, reconcile), columns.SILVER_DEFAULTS)
    df = clean.type_cast_filter(df, parity=parity)
    df = clean.add_city_clean(df)
    return clean.impute_prices(enrich.enrich_weather_rates(df, *(found or lookups(b))))


def silver_bookings(b: Bronze, parity: bool = False, drop_midnight: bool = True) -> DataFrame:
    """X1: the whole silver job.  parity=True reproduces the original's
    quirks (amount columns dropped on union, substring column classes)."""
    df = enriched(b, "drop" if parity else "coalesce", parity=parity)
    return clean.universal_clean(df, parity=parity, drop_midnight=drop_midnight)


def time_columns(df: DataFrame) -> list[str]:
    """The ``<date>_time`` companions written by the date split."""
    dt = dict(df.dtypes)
    return [c for c in df.columns if c.endswith("_time") and dt.get(c[:-5]) == "date"]


def silver_table(b: Bronze, parity: bool = False) -> DataFrame:
    """silver_bookings computed ONCE: written with every ``_time`` column,
    then the midnight-only ones are found by a probe over the written table
    (a scan of a few string columns) and dropped.  Probing the lazy plan
    instead would run the whole silver job twice."""
    full = materialize(silver_bookings(b, parity, drop_midnight=False), "silver_full")
    return clean.drop_constant_time_cols(full, time_columns(full))


def write_silver(b: Bronze, path: str, parity: bool = False) -> DataFrame:
    """X1 written ONCE to its place: the clock columns that are midnight on
    every row are found in the written table and left out on reading it."""
    full = overwrite_table(silver_bookings(b, parity, drop_midnight=False), path)
    return clean.drop_constant_time_cols(full, time_columns(full))


def city_dim_table(silver: DataFrame, b: Bronze, found: tuple | None = None) -> DataFrame:
    """X2: silver_city_dim, for the cities of ``silver`` (or of any frame with
    ``city_clean`` and ``country``)."""
    return enrich.city_dim(silver, *(found or lookups(b)))


@dataclass
class Gold:
    fact: DataFrame
    dim_city: DataFrame
    dim_hotel: DataFrame
    dim_date: DataFrame
    kpi: DataFrame


def gold_tables(silver: DataFrame, city_dim: DataFrame, date_range: tuple | None = None) -> Gold:
    """X3: fact, dimensions and KPI.  The calendar spans the fact's years
    unless a fixed ``date_range`` (start, end) is given."""
    fact = gold.fact_bookings(silver)
    dc = gold.dim_city(city_dim)
    dh = gold.dim_hotel(silver)
    dd = (cal.dim_date(silver.sparkSession, *date_range) if date_range
          else cal.dim_date_for(fact, "booking_date"))
    return Gold(fact, dc, dh, dd, gold.kpi_revenue(fact, dc))


def run_layers(spark: SparkSession, sf_dir: str, out_dir: str, parity: bool = False) -> dict:
    """Write every layer under ``out_dir`` (shared storage); return row counts."""
    with scratch(spark):
        return _layers(bronze_from_testdata(spark, sf_dir), out_dir, parity)


def _layers(b: Bronze, out_dir: str, parity: bool) -> dict:
    silver = write_silver(b, f"{out_dir}/silver_bookings", parity)
    cdim = overwrite_table(city_dim_table(silver, b), f"{out_dir}/silver_city_dim")
    g = gold_tables(silver, cdim)
    out = {"silver_bookings": silver, "silver_city_dim": cdim}
    fact = overwrite_table(g.fact, f"{out_dir}/gold_fact_bookings", partition_by=("booking_year",))
    out["gold_fact_bookings"] = fact
    out["gold_dim_city"] = overwrite_table(g.dim_city, f"{out_dir}/gold_dim_city")
    out["gold_dim_hotel"] = overwrite_table(g.dim_hotel, f"{out_dir}/gold_dim_hotel")
    out["gold_dim_date"] = overwrite_table(g.dim_date, f"{out_dir}/gold_dim_date")
    out["gold_kpi_revenue"] = overwrite_table(gold.kpi_revenue(fact, out["gold_dim_city"]),
                                              f"{out_dir}/gold_kpi_revenue")
    return {k: v.count() for k, v in out.items()}


def bronze_from_landing(spark: SparkSession, out: Callable[[str], dict], batch_csv: str, stream_json: str,
                        weather: tuple[str, str] | None = None, rates: str | None = None,
                        csv_schema=None, infer: bool = False) -> Bronze:
    """Land the sources as bronze tables: a CSV folder (kept as text without a
    schema, unless ``infer``, as the original does), a folder of booking events as JSON, and, once the API job has
    landed them, weather (geocode and forecast folders) and rates.  Lookups
    not landed yet are read as they are, or as empty tables."""
    b = overwrite_table(columns.as_strings(files.ingest_csv(spark, batch_csv, csv_schema, infer)), **out("bronze_batch"))
    schema = T.StructType([*S.STREAM_TABLE_SCHEMA.fields,
                           *[T.StructField(f.name, T.StringType()) for f in S.EVENT_SCHEMA.fields
                             if f.name not in S.STREAM_TABLE_COLUMNS]])
    s = overwrite_table(spark.read.schema(schema).json(stream_json), **out("bronze_stream"))
    if weather:
        overwrite_if_nonempty(files.flatten_weather(files.read_weather_landing(spark, *weather)),
                              **out("bronze_weather"))
    if rates:
        overwrite_if_nonempty(files.explode_rates(files.read_rates_landing(spark, rates)),
                              **out("bronze_exchange_rates"))
    where = lambda n: out(n).get("name") or out(n)["path"]
    return Bronze(b, s, read_or_empty(spark, where("bronze_weather"), S.WEATHER_TABLE_SCHEMA),
                  read_or_empty(spark, where("bronze_exchange_rates"), S.RATES_TABLE_SCHEMA))


def run_job(spark: SparkSession, out_dir: str, batch_csv: str, stream_json: str,
            weather: tuple[str, str] | None = None, rates: str | None = None, database: str | None = None,
            csv_schema=None, parity: bool = False) -> dict:
    """The whole job from landed files to gold, under ``out_dir`` and, with
    ``database``, as named tables.  Run it once without the API landings: it
    leaves ``city_requests``, the cities to fetch.  Run it again with them:
    silver and gold then carry weather and rates."""
    def out(n: str) -> dict:
        return {"path": f"{out_dir.rstrip('/')}/{n}", "name": f"{database}.{n}" if database else None}

    with scratch(spark):
        return _job_tables(spark, out, bronze_from_landing(
            spark, out, batch_csv, stream_json, weather, rates, csv_schema, infer=parity), parity)


def _job_tables(spark: SparkSession, out: Callable[[str], dict], b: Bronze, parity: bool) -> dict:
    """Silver and gold of :func:`run_job`, each written to its place."""
    found = lookups(b)
    full = materialize(clean.universal_clean(enriched(b, "drop" if parity else "coalesce", found, parity),
                                             parity=parity, drop_midnight=False), "silver_full")
    silver = overwrite_table(clean.drop_constant_time_cols(full, time_columns(full)), **out("silver_bookings"))
    tables = {"silver_bookings": silver,
              "city_requests": overwrite_table(enrich.city_sources(silver, b.batch), **out("city_requests")),
              "silver_city_dim": overwrite_table(city_dim_table(silver, b, found), **out("silver_city_dim"))}
    g = gold_tables(silver, tables["silver_city_dim"])
    for n, df in (("gold_fact_bookings", g.fact), ("gold_dim_city", g.dim_city), ("gold_dim_hotel", g.dim_hotel),
                  ("gold_dim_date", g.dim_date)):
        tables[n] = overwrite_table(df, **out(n))
    tables["gold_kpi_revenue"] = overwrite_table(
        gold.kpi_revenue(tables["gold_fact_bookings"], tables["gold_dim_city"]), **out("gold_kpi_revenue"))
    return tables


def gold_row_counts(g: Gold) -> DataFrame:
    """One frame with the row count of each gold table (X3 summary)."""
    parts = [(n, df) for n, df in [("gold_fact_bookings", g.fact), ("gold_dim_city", g.dim_city),
                                   ("gold_dim_hotel", g.dim_hotel), ("gold_dim_date", g.dim_date),
                                   ("gold_kpi_revenue", g.kpi)]]
    out = None
    for n, df in parts:
        p = df.agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count"))
        out = p if out is None else out.unionByName(p)
    return out


__all__ = ["Bronze", "Gold", "bronze_from_testdata", "silver_bookings", "city_dim_table", "gold_tables",
           "run_job", "run_layers", "gold_row_counts", "K"]
