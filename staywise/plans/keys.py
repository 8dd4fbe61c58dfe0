"""Registered queries: name -> (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole given tables.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import calendar as cal
from ..operators import clean, columns, enrich, gold, quality, report
from ..streaming.events import SLICE
from . import medallion as M
from . import oracle as O
from . import testdata as td

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---- shared plan fragments -------------------------------------------------------------------

_PLANS: OrderedDict = OrderedDict()
_KEPT_PLANS = 24


def _plan(spark, kind, sf_dir, build):
    """Lazy plan objects shared by the queries of one session (the plan, not
    its data: every query still runs from the raw tables).  A plan is kept as
    long as the files of the tables are the same ones; few are kept."""
    from ..session import session_key
    k = session_key(spark) + (kind, sf_dir, td.version(spark, sf_dir))
    if k not in _PLANS:
        _PLANS[k] = build()
        while len(_PLANS) > _KEPT_PLANS:
            _PLANS.popitem(last=False)
    return _PLANS[k]


def _bronze(spark, sf_dir) -> M.Bronze:
    return _plan(spark, "bronze", sf_dir, lambda: M.bronze_from_testdata(spark, sf_dir))


def _lookups(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return _plan(spark, "lookups", sf_dir, lambda: M.lookups(_bronze(spark, sf_dir)))


def _enriched(spark, sf_dir) -> DataFrame:
    return _plan(spark, "enriched", sf_dir,
                 lambda: M.enriched(_bronze(spark, sf_dir), found=_lookups(spark, sf_dir)))


def _silver(spark, sf_dir) -> DataFrame:
    """Silver without the midnight-column probe (gold keys select their columns)."""
    return _plan(spark, "silver", sf_dir,
                 lambda: clean.universal_clean(_enriched(spark, sf_dir), drop_midnight=False))


def _cities(spark, sf_dir, places: DataFrame) -> DataFrame:
    """The city dimension's rows (without key) for ``places``, any frame with
    ``city_clean`` and ``country``."""
    return gold.city_rows(M.city_dim_table(places, _bronze(spark, sf_dir), _lookups(spark, sf_dir)))


_GOLD_COLS = ["booking_id", "hotel_id", "customer_id", "booking_date", "city_clean", "country", "hotel_name",
              "hotel_type", "star_rating", "latitude", "longitude", "room_type", "nights", "adults", "children",
              "booking_status", "source_system", "booking_channel", "currency", "total_amount", "room_price",
              "exchange_rate_to_eur", "temperature_c", "weather_code"]


def _gold(spark, sf_dir) -> M.Gold:
    """All gold tables, for the queries that read all of them: silver feeds
    the fact and two dimensions, so its gold columns are written once."""
    s = M.materialize(_silver(spark, sf_dir).select(*_GOLD_COLS), "silver_gold_columns")
    cities = M.materialize(M.city_dim_table(s, _bronze(spark, sf_dir), _lookups(spark, sf_dir)), "silver_city_dim")
    return M.gold_tables(s, cities)


def _fact(spark, sf_dir) -> DataFrame:
    return gold.fact_bookings(_silver(spark, sf_dir))


def _with_weather(spark, sf_dir, groups: DataFrame) -> DataFrame:
    """KPI groups and their cities' weather.  The groups are few and written:
    they also tell which cities are needed."""
    groups = M.materialize(groups, "kpi_groups")
    places = groups.select(F.col("city").alias("city_clean"), "country")
    return gold.with_city_weather(groups, _cities(spark, sf_dir, places))


# ---- X: whole jobs -----------------------------------------------------------------------------

@register("silver_bookings", O.with_ctes("SELECT * FROM x_silver", "x_silver"))
def q_silver_bookings(spark, sf_dir):
    # silver written once, the midnight probe over the written table
    return clean.drop_constant_time_cols(M.materialize(_silver(spark, sf_dir), "silver_full"),
                                         M.time_columns(_silver(spark, sf_dir)))


def _landed(spark, sf_dir) -> str:
    """State of two landings, a tenth of the rows with the second; later rows
    of bookings already landed replace them in their buckets."""
    from ..session import scratch_path
    from . import incremental as I
    b, state = _bronze(spark, sf_dir), scratch_path(spark, "silver_state")
    second = F.pmod(F.xxhash64(F.col("booking_id").cast("string"), "ingestion_time"), F.lit(10)) == 0
    for part in (~second, second):
        I.land(spark, state, M.Bronze(b.batch.where(part), b.stream.where(part), b.weather, b.rates),
               _lookups(spark, sf_dir))
    return state


@register("silver_incremental", O.with_ctes("SELECT * FROM x_silver", "x_silver"))
def q_silver_incremental(spark, sf_dir):
    from . import incremental as I
    return I.silver(spark, _landed(spark, sf_dir))


@register("kpi_incremental", O.with_ctes("SELECT * FROM x_kpi_channel", "x_kpi_channel"))
def q_kpi_incremental(spark, sf_dir):
    """The KPI with distinct channels, from partials stored by two landings."""
    from . import incremental as I
    groups = I.kpi(spark, _landed(spark, sf_dir), cancelled=("Canceled",), channels=True)
    return _with_weather(spark, sf_dir, groups)


@register("city_dim", O.with_ctes("SELECT * FROM x_city_dim", "x_city_dim"))
def q_city_dim(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return M.city_dim_table(_silver(spark, sf_dir), b, _lookups(spark, sf_dir))


@register("gold_star", O.with_ctes("""
SELECT 'gold_fact_bookings' AS table_name, count(*) AS row_count FROM x_fact
UNION ALL SELECT 'gold_dim_city', count(*) FROM x_dim_city
UNION ALL SELECT 'gold_dim_hotel', count(*) FROM x_dim_hotel
UNION ALL SELECT 'gold_dim_date', count(*) FROM x_dim_date
UNION ALL SELECT 'gold_kpi_revenue', count(*) FROM x_kpi""", "x_fact", "x_dim_city", "x_dim_hotel",
                                   "x_dim_date", "x_kpi"))
def q_gold_star(spark, sf_dir):
    return M.gold_row_counts(_gold(spark, sf_dir))


# ---- gold tables ----------------------------------------------------------------------------

@register("fact_bookings", O.with_ctes("SELECT * FROM x_fact", "x_fact"))
def q_fact_bookings(spark, sf_dir):
    return _fact(spark, sf_dir)


@register("dim_city", O.with_ctes("SELECT * FROM x_dim_city", "x_dim_city"))
def q_dim_city(spark, sf_dir):
    return gold.dim_city(q_city_dim(spark, sf_dir))


@register("dim_hotel", O.with_ctes("SELECT * FROM x_dim_hotel", "x_dim_hotel"))
def q_dim_hotel(spark, sf_dir):
    return gold.dim_hotel(_silver(spark, sf_dir))


@register("dim_hotel_first_value", O.with_ctes("SELECT * FROM x_dim_hotel", "x_dim_hotel"))
def q_dim_hotel_first_value(spark, sf_dir):
    return gold.dim_hotel_first_value(_silver(spark, sf_dir))


@register("dim_date", O.with_ctes("SELECT * FROM x_dim_date", "x_dim_date"))
def q_dim_date(spark, sf_dir):
    return cal.dim_date_for(_fact(spark, sf_dir), "booking_date")


@register("kpi_revenue", O.with_ctes("SELECT * FROM x_kpi", "x_kpi"))
def q_kpi_revenue(spark, sf_dir):
    return _with_weather(spark, sf_dir, gold.kpi_groups(_fact(spark, sf_dir)))


@register("kpi_revenue_channel", O.with_ctes("SELECT * FROM x_kpi_channel", "x_kpi_channel"))
def q_kpi_revenue_channel(spark, sf_dir):
    return _with_weather(spark, sf_dir, gold.kpi_channel_groups(_fact(spark, sf_dir)))


@register("star_join", O.with_ctes("""
SELECT f.booking_id, f.hotel_id, f.city, f.booking_date, f.total_amount_eur, c.city_key,
  c.temperature_c AS city_temperature_c, h.hotel_tier, h.hotel_name AS dim_hotel_name,
  d.year_quarter, d.year_month, d.is_weekend
FROM x_fact f LEFT JOIN x_dim_city c ON f.city = c.city
LEFT JOIN x_dim_hotel h ON f.hotel_id = h.hotel_id
LEFT JOIN x_dim_date d ON f.booking_date = d.date_key""", "x_fact", "x_dim_city", "x_dim_hotel", "x_dim_date"))
def q_star_join(spark, sf_dir):
    g = _gold(spark, sf_dir)
    days = M.materialize(g.dim_date, "dim_date")
    return gold.star_join(g.fact, M.materialize(g.dim_city, "dim_city"), M.materialize(g.dim_hotel, "dim_hotel"), days)


@register("hotel_join_bucketed", O.with_ctes("""
SELECT f.booking_id, f.hotel_id, f.total_amount_eur, h.hotel_tier, h.hotel_name AS dim_hotel_name
FROM x_fact f LEFT JOIN x_dim_hotel h ON f.hotel_id = h.hotel_id""", "x_fact", "x_dim_hotel"))
def q_hotel_join_bucketed(spark, sf_dir):
    """Fact and hotels written in buckets of the hotel, then joined where they
    lie."""
    from ..session import scratch_path
    from ..sources.tables import write_bucketed
    s = M.materialize(_silver(spark, sf_dir).select(*_GOLD_COLS), "silver_gold_columns")
    at = scratch_path(spark, "bucketed")
    tag = at.rsplit("-", 1)[-1]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact = write_bucketed(gold.fact_bookings(s).select("booking_id", "hotel_id", "total_amount_eur"), f"{at}/fact",
                          f"staywise_fact_{tag}", "hotel_id", n)
    hotels = write_bucketed(gold.dim_hotel(s), f"{at}/hotels", f"staywise_hotels_{tag}", "hotel_id", n)
    return gold.hotel_join(fact, hotels)


@register("top_revenue", O.with_ctes("""
SELECT * FROM x_kpi ORDER BY total_revenue_eur DESC NULLS LAST, city ASC NULLS FIRST, country ASC NULLS FIRST,
  booking_year ASC NULLS FIRST, booking_month ASC NULLS FIRST, hotel_type ASC NULLS FIRST LIMIT 10""", "x_kpi"))
def q_top_revenue(spark, sf_dir):
    # the ten groups first, then their weather
    top = gold.top_revenue(gold.kpi_groups(_fact(spark, sf_dir)), 10)
    return _with_weather(spark, sf_dir, top)


@register("tier_histogram", O.with_ctes(
    "SELECT hotel_tier, count(*) AS hotels FROM x_dim_hotel GROUP BY hotel_tier", "x_dim_hotel"))
def q_tier_histogram(spark, sf_dir):
    return gold.tier_histogram(gold.dim_hotel(_silver(spark, sf_dir)))


# ---- report queries ------------------------------------------------------------------------

@register("report_cards", O.with_ctes(f"""
SELECT {O.avg_money('avg_nightly_rate_eur')} AS avg_nightly_rate_eur, count(booking_id) AS bookings,
  {O.dsum('total_amount_eur', 2)} AS total_revenue_eur FROM x_fact""", "x_fact"))
def q_report_cards(spark, sf_dir):
    return report.report_cards(_fact(spark, sf_dir))


@register("report_rates_avg", O.with_ctes("SELECT " + ", ".join(
    f"{O.sround(f'avg(rate_{c.lower()})', 6)} AS avg_rate_{c.lower()}" for c in O.CURRENCIES)
    + " FROM x_city_dim", "x_city_dim"))
def q_report_rates_avg(spark, sf_dir):
    return report.report_rates_avg(q_city_dim(spark, sf_dir))


@register("report_country_revenue", O.with_ctes(f"""
SELECT country, {O.dsum('total_amount', 12, 2)} AS total_amount FROM x_fact
WHERE NOT COALESCE(hotel_type IN ({O.qlist(O.COUNTRY_EXCLUDE_TYPES)})
                   OR country IN ({O.qlist(O.COUNTRY_EXCLUDE_COUNTRIES)}), FALSE)
GROUP BY country""", "x_fact"))
def q_report_country_revenue(spark, sf_dir):
    return report.report_country_revenue(_fact(spark, sf_dir))


@register("report_hotel_type_revenue", O.with_ctes(f"""
SELECT hotel_type, {O.dsum('total_amount_eur', 2)} AS total_amount_eur FROM x_fact
WHERE {O.not_in('hotel_type', O.TYPE_EXCLUDE)} GROUP BY hotel_type""", "x_fact"))
def q_report_hotel_type_revenue(spark, sf_dir):
    return report.report_hotel_type_revenue(_fact(spark, sf_dir))


@register("report_city_revenue", O.with_ctes(f"""
SELECT city, {O.dsum('total_revenue_eur', 2)} AS total_revenue_eur FROM x_kpi
WHERE {O.not_in('city', O.CITY_EXCLUDE)} GROUP BY city""", "x_kpi"))
def q_report_city_revenue(spark, sf_dir):
    return report.report_city_revenue(gold.kpi_groups(_fact(spark, sf_dir)))


@register("report_city_table", O.with_ctes(f"""
SELECT city, CAST(sum(total_bookings) AS BIGINT) AS total_bookings,
  {O.dsum('avg_booking_value_eur', 2)} AS sum_avg_booking_value_eur,
  {O.dsum('cancellation_rate', 1)} AS sum_cancellation_rate,
  {O.wavg('avg_booking_value_eur', 'total_bookings', 2, 2)} AS weighted_avg_booking_value_eur,
  {O.wavg('cancellation_rate', 'total_bookings', 1, 1)} AS weighted_cancellation_rate
FROM x_kpi GROUP BY city""", "x_kpi"))
def q_report_city_table(spark, sf_dir):
    return report.report_city_table(gold.kpi_groups(_fact(spark, sf_dir)))


@register("report_monthly_trend", O.with_ctes("""
SELECT d.year_month, count(f.booking_id) AS bookings FROM x_fact f JOIN x_dim_date d ON f.booking_date = d.date_key
GROUP BY d.year_month""", "x_fact", "x_dim_date"))
def q_report_monthly_trend(spark, sf_dir):
    # days, a few thousand rows, are written: they bound the calendar too
    days = M.materialize(_fact(spark, sf_dir).groupBy("booking_date").agg(F.count("booking_id").alias("bookings")),
                         "days")
    return report.monthly_from_days(days, cal.dim_date_for(days, "booking_date"))


@register("report_years", O.with_ctes("SELECT DISTINCT year FROM x_dim_date", "x_dim_date"))
def q_report_years(spark, sf_dir):
    return report.report_years(cal.dim_date_for(_fact(spark, sf_dir), "booking_date"))


@register("default_summarize", O.with_ctes("SELECT " + ", ".join(
    f"CAST(sum(CAST(CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) AS sum_{c}"
    for c in O.SUMMED) + " FROM x_fact", "x_fact"))
def q_default_summarize(spark, sf_dir):
    return report.default_summarize(_fact(spark, sf_dir))


# ---- the gold layer as SQL models --------------------------------------------------------------

def _models(spark, sf_dir, *wanted) -> dict[str, DataFrame]:
    from . import models
    inputs = {"silver_bookings": _silver(spark, sf_dir)}
    if {"dim_city", "kpi_revenue"} & set(wanted):
        inputs["silver_bookings"] = M.materialize(inputs["silver_bookings"].select(*_GOLD_COLS), "silver_gold_columns")
        inputs["numbered_cities"] = models.numbered_cities(
            inputs["silver_bookings"], _bronze(spark, sf_dir).weather, _lookups(spark, sf_dir)[1])
    return models.run_models(spark, inputs, wanted)


def _model_key(name: str, cte: str) -> None:
    @register(f"model_{name}", O.with_ctes(f"SELECT * FROM {cte}", cte))
    def build(spark, sf_dir):
        return _models(spark, sf_dir, name)[name]


for _name, _cte in (("fact_bookings", "x_fact"), ("dim_city", "x_model_city"), ("dim_hotel", "x_dim_hotel"),
                    ("dim_date", "x_dim_date"), ("kpi_revenue", "x_model_kpi")):
    _model_key(_name, _cte)


# ---- calendar ------------------------------------------------------------------------------

@register("dim_date_fixed", O.with_ctes("SELECT " + O.date_attrs("d") + """, coalesce(n, 0) AS bookings FROM (
SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS d) s
LEFT JOIN (SELECT booking_date, count(*) AS n FROM x_fact GROUP BY booking_date) b ON b.booking_date = s.d""", "x_fact"))
def q_dim_date_fixed(spark, sf_dir):
    """The fixed day spine with the bookings of each day."""
    days = _fact(spark, sf_dir).groupBy(F.col("booking_date").alias("date_key")).agg(F.count("*").alias("n"))
    return (cal.dim_date(spark).join(days, "date_key", "left")
            .withColumn("bookings", F.coalesce("n", F.lit(0).cast("long"))).drop("n"))


@register("data_calendar", O.with_ctes("SELECT * FROM x_cal", "x_cal"))
def q_data_calendar(spark, sf_dir):
    return cal.data_calendar(_fact(spark, sf_dir), "booking_date")


@register("date_part_join", O.with_ctes("""
SELECT f.booking_id, c.Date, c.Year, c.QuarterNo, c.Quarter, c.MonthNo, c.Day
FROM x_fact f LEFT JOIN x_cal c ON f.booking_date = c.Date""", "x_fact", "x_cal"))
def q_date_part_join(spark, sf_dir):
    fact = M.materialize(_fact(spark, sf_dir).select("booking_id", "booking_date"), "fact_dates")
    calendar = M.materialize(cal.data_calendar(fact, "booking_date"), "calendar")
    j = cal.date_part_join(fact, calendar, "booking_date")
    return j.select("booking_id", "Date", "Year", "QuarterNo", "Quarter", "MonthNo", "Day")


_ROLES = ["booking_date", "checkin_date", "ingestion_time", "event_time"]


@register("date_roles", O.with_ctes(
    "SELECT s.booking_id, " + ", ".join(f"{r}.{a} AS {r}_{a}" for r in _ROLES
                                        for a in ("Year", "QuarterNo", "MonthNo", "Day"))
    + " FROM x_silver s" + "".join(
        f"""
LEFT JOIN (SELECT d AS Date, CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS QuarterNo,
  CAST(month(d) AS INTEGER) AS MonthNo, CAST(day(d) AS INTEGER) AS Day
  FROM (SELECT DISTINCT {r} AS d FROM x_silver WHERE {r} IS NOT NULL)) {r} ON {r}.Date = s.{r}""" for r in _ROLES),
    "x_silver"))
def q_date_roles(spark, sf_dir):
    """Every date column of silver against one calendar, which is read once."""
    dates = M.materialize(_silver(spark, sf_dir).select("booking_id", *_ROLES), "silver_dates")
    calendar = M.materialize(cal.calendar_over(dates, _ROLES), "calendar")
    return cal.date_roles(dates, calendar, _ROLES).drop(*_ROLES)


@register("date_hierarchy_rollup", O.with_ctes(f"""
SELECT Year, QuarterNo, MonthNo, Day, count(*) AS bookings, {O.dsum('total_amount_eur', 2)} AS revenue_eur,
  CAST(GROUPING(Year, QuarterNo, MonthNo, Day) AS INTEGER) AS level
FROM x_fact f LEFT JOIN x_cal c ON f.booking_date = c.Date
GROUP BY ROLLUP (Year, QuarterNo, MonthNo, Day)""", "x_fact", "x_cal"))
def q_date_hierarchy_rollup(spark, sf_dir):
    days = M.materialize(cal.days_of(_fact(spark, sf_dir)), "days")
    return cal.rollup_days(days, cal.data_calendar(days, "booking_date"))


# ---- silver operators ----------------------------------------------------------------------

@register("dedup_latest", O.with_ctes(
    "SELECT booking_id, hotel_id, source_file, ingestion_ts, booking_status FROM x_dedup", "x_dedup"))
def q_dedup_latest(spark, sf_dir):
    return M.deduplicated(_bronze(spark, sf_dir)).select(
        "booking_id", "hotel_id", "source_file", F.try_to_timestamp("ingestion_time").alias("ingestion_ts"),
        "booking_status")


@register("dedup_by_key", O.with_ctes(f"""
SELECT dim_id, booking_id, city, country, hotel_type FROM (
  SELECT {O.digits('hotel_id')} AS dim_id, booking_id, city, country, hotel_type,
    row_number() OVER (PARTITION BY {O.digits('hotel_id')} ORDER BY booking_id) AS rn FROM x_batch) WHERE rn = 1""",
    "x_batch"))
def q_dedup_by_key(spark, sf_dir):
    from ..functions.text import digits_only
    from ..operators.dedup import dedup_by_key
    b = td.bronze_batch(spark, sf_dir).select(digits_only("hotel_id").alias("dim_id"), "booking_id", "city",
                                               "country", "hotel_type")
    return dedup_by_key(b, ["dim_id"], ["booking_id"])


@register("hotel_lookup_fill", O.with_ctes("""
SELECT booking_id, hotel_id, hotel_name, city, country, star_rating, hotel_type, latitude, longitude
FROM x_filled""", "x_filled"))
def q_hotel_lookup_fill(spark, sf_dir):
    return M.union_and_fill(_bronze(spark, sf_dir)).select(
        "booking_id", "hotel_id", "hotel_name", "city", "country", "star_rating", "hotel_type",
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"))


_UNION_COLS = ["booking_id", "hotel_id", "customer_id", "currency", "room_type", "booking_status", "source_system",
               "nights", "adults", "source_file"]


@register("union_by_name", O.with_ctes(f"SELECT {', '.join(_UNION_COLS)} FROM x_union", "x_union"))
def q_union_by_name(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return columns.union_by_name(b.batch, b.stream).select(*_UNION_COLS)


_STREAM_STR = ["booking_id", "customer_id", "hotel_id", "room_type", "nights", "adults", "currency",
               "booking_status", "source_system"]


@register("standardize_names", O.with_ctes(f"SELECT {', '.join(_STREAM_STR)} FROM x_stream", "x_stream"))
def q_standardize_names(spark, sf_dir):
    s = td.bronze_stream(spark, sf_dir)
    dirty = s.toDF(*[f" {c.replace('_', ' ').title()} " for c in s.columns])   # CSV-style headers
    return columns.standardize_names(dirty).select(*_STREAM_STR)


@register("reconcile_columns", O.with_ctes(
    "SELECT booking_id, COALESCE(total_amount, total_price) AS total_amount FROM x_union", "x_union"))
def q_reconcile_columns(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    u = columns.reconcile_columns(columns.union_by_name(b.batch, b.stream), "total_amount",
                                  ("total_price", "paid_amount"), "coalesce")
    return u.select("booking_id", F.col("total_amount").try_cast("double").alias("total_amount"))


@register("dedup_column_names", O.with_ctes("SELECT booking_id, hotel_id, currency FROM x_stream", "x_stream"))
def q_dedup_column_names(spark, sf_dir):
    s = td.bronze_stream(spark, sf_dir)
    return columns.dedup_column_names(s.select("booking_id", "hotel_id", "currency", F.col("room_type").alias("currency")))


@register("default_columns", O.with_ctes(
    "SELECT booking_id, 'EUR' AS currency, total_amount FROM x_stream", "x_stream"))
def q_default_columns(spark, sf_dir):
    s = columns.default_columns(td.bronze_stream(spark, sf_dir).drop("currency"), columns.SILVER_DEFAULTS)
    return s.select("booking_id", "currency", F.col("total_amount").try_cast("double").alias("total_amount"))


@register("type_cast_filter", O.with_ctes(f"""
SELECT booking_id, booking_ts AS booking_date, abs(total_amount) AS total_amount, abs(room_price) AS room_price,
  {O.to_int('nights')} AS nights FROM x_dedup WHERE booking_ts IS NOT NULL""", "x_dedup"))
def q_type_cast_filter(spark, sf_dir):
    d = columns.default_columns(M.deduplicated(_bronze(spark, sf_dir)), columns.SILVER_DEFAULTS)
    return clean.type_cast_filter(d).select("booking_id", "booking_date", "total_amount", "room_price", "nights")


@register("city_clean", O.with_ctes(f"SELECT booking_id, city, {O.city_clean('city')} AS city_clean FROM x_batch",
                                    "x_batch"))
def q_city_clean(spark, sf_dir):
    return clean.add_city_clean(td.bronze_batch(spark, sf_dir)).select("booking_id", "city", "city_clean")


_STR_COLS = ["city", "country", "hotel_type", "room_type", "currency"]


@register("clean_strings", O.with_ctes("SELECT booking_id, " + ", ".join(
    f"{O.clean_string(c, upper=c == 'currency')} AS {c}" for c in _STR_COLS) + " FROM x_batch", "x_batch"))
def q_clean_strings(spark, sf_dir):
    return clean.clean_strings(td.bronze_batch(spark, sf_dir), _STR_COLS, ["currency"]).select("booking_id", *_STR_COLS)


@register("clean_phone", O.with_ctes(f"SELECT booking_id, {O.clean_phone('phone')} AS phone FROM x_batch", "x_batch"))
def q_clean_phone(spark, sf_dir):
    return clean.clean_phone(td.bronze_batch(spark, sf_dir), ["phone"]).select("booking_id", "phone")


@register("number_words", O.with_ctes(
    f"SELECT booking_id, {O.words('adults')} AS adults, {O.words('star_rating')} AS star_rating FROM x_batch",
    "x_batch"))
def q_number_words(spark, sf_dir):
    return clean.number_words(td.bronze_batch(spark, sf_dir), ["adults", "star_rating"]).select(
        "booking_id", "adults", "star_rating")


@register("clean_numeric", O.with_ctes(f"""
SELECT booking_id, COALESCE(abs({O.to_int(O.words('star_rating'))}), 0) AS star_rating,
  COALESCE(abs({O.to_int(O.words('adults'))}), 0) AS adults,
  COALESCE(abs({O.to_double(O.words('children'))}), 0.0) AS children,
  COALESCE(abs({O.to_double('nights')}), 0.0) AS nights FROM x_batch""", "x_batch"))
def q_clean_numeric(spark, sf_dir):
    return clean.clean_numeric(td.bronze_batch(spark, sf_dir), ["star_rating", "adults", "children", "nights"],
                               ["star_rating", "adults"]).select("booking_id", "star_rating", "adults", "children",
                                                                 "nights")


@register("clean_coords", O.with_ctes(
    f"SELECT booking_id, {O.coord('latitude', 90)} AS latitude, {O.coord('longitude', 180)} AS longitude FROM x_batch",
    "x_batch"))
def q_clean_coords(spark, sf_dir):
    return clean.clean_coords(td.bronze_batch(spark, sf_dir), ["latitude", "longitude"]).select(
        "booking_id", "latitude", "longitude")


@register("split_datetime", O.with_ctes(
    f"SELECT booking_id, {O._dt('booking_date', 'booking_ts')}, {O._dt('checkin_date', 'checkin_ts')} FROM x_batch",
    "x_batch"))
def q_split_datetime(spark, sf_dir):
    return clean.split_datetime(td.bronze_batch(spark, sf_dir), ["booking_date", "checkin_date"]).select(
        "booking_id", "booking_date", "booking_date_time", "checkin_date", "checkin_date_time")


@register("impute_prices", O.with_ctes(
    "SELECT booking_id, total_amount, room_price, nights FROM x_imputed", "x_imputed"))
def q_impute_prices(spark, sf_dir):
    return _enriched(spark, sf_dir).select("booking_id", "total_amount", "room_price", "nights")


_TIME_COLS = ["booking_date_time", "checkin_date_time", "ingestion_time_time", "event_time_time"]


@register("drop_constant_time_cols", O.with_ctes(O.time_activity_sql("x_silver_full", _TIME_COLS), "x_silver_full"))
def q_drop_constant_time_cols(spark, sf_dir):
    return clean.time_col_activity(_silver(spark, sf_dir), _TIME_COLS)


# ---- quality -------------------------------------------------------------------------------

@register("coverage_metrics", O.with_ctes("""
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE city_clean IS NOT NULL AND city_clean <> 'Unknown') AS city_filled,
  count(temperature_c) AS weather_matched,
  CAST(floor(count(*) FILTER (WHERE city_clean IS NOT NULL AND city_clean <> 'Unknown') * 100 / count(*)) AS BIGINT)
    AS city_filled_pct,
  CAST(floor(count(temperature_c) * 100 / count(*)) AS BIGINT) AS weather_matched_pct
FROM x_silver""", "x_silver"))
def q_coverage_metrics(spark, sf_dir):
    return enrich.coverage_metrics(_silver(spark, sf_dir))


@register("null_blank_profile", O.with_ctes("""
SELECT 'before' AS stage, count(*) FILTER (WHERE hotel_name IS NULL) AS null_rows,
  count(*) FILTER (WHERE trim(hotel_name) = '') AS blank_rows, count(*) AS total_rows FROM x_union
UNION ALL
SELECT 'after', count(*) FILTER (WHERE hotel_name IS NULL), count(*) FILTER (WHERE trim(hotel_name) = ''), count(*)
FROM x_filled""", "x_union", "x_filled"))
def q_null_blank_profile(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return enrich.null_blank_profile(columns.union_by_name(b.batch, b.stream), M.union_and_fill(b), "hotel_name")


@register("dq_suite", O.with_ctes(O.dq_sql("x_silver", "silver_bookings", O.SILVER_RULES),
                                  "x_silver"))
def q_dq_suite(spark, sf_dir):
    return quality.dq_suite(_silver(spark, sf_dir))


@register("dq_report", O.with_ctes(f"""
SELECT count(*) AS total, count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed,
  COALESCE(array_to_string(list_sort(list("check" || ':' || "column") FILTER (WHERE NOT success)), ','), '')
    AS failed_checks
FROM ({O.dq_sql('x_silver', 'silver_bookings', O.SILVER_RULES)})""", "x_silver"))
def q_dq_report(spark, sf_dir):
    return quality.dq_report(quality.dq_suite(_silver(spark, sf_dir))).withColumn(
        "failed_checks", F.array_join("failed_checks", ","))


@register("collapsed_nulls", """
SELECT count(*) FILTER (WHERE o_orderkey % 7 = 0) AS null_rows,
  greatest(count(*) FILTER (WHERE o_orderkey % 7 = 0) - 1, 0) AS lost FROM orders""")
def q_collapsed_nulls(spark, sf_dir):
    from ..operators.dedup import collapsed_nulls
    rows = td.bronze_batch(spark, sf_dir).select(
        F.when(F.col("booking_id").cast("long") % 7 != 0, F.col("booking_id")).alias("booking_id"))
    return collapsed_nulls(rows, "booking_id")


@register("dq_native_summary", O.with_ctes("""
SELECT test, problems, problems = 0 AS ok FROM (
  SELECT 'booking_id NULL' AS test, count(*) FILTER (WHERE booking_id IS NULL) AS problems FROM x_silver
  UNION ALL SELECT 'customer_id NULL', count(*) FILTER (WHERE customer_id IS NULL) FROM x_silver
  UNION ALL SELECT 'hotel_id NULL', count(*) FILTER (WHERE hotel_id IS NULL) FROM x_silver
  UNION ALL SELECT 'booking_date NULL', count(*) FILTER (WHERE booking_date IS NULL) FROM x_silver
  UNION ALL SELECT 'total_amount < 0', count(*) FILTER (WHERE total_amount < 0) FROM x_silver
  UNION ALL SELECT 'city_clean NULL', count(*) FILTER (WHERE city_clean IS NULL) FROM x_silver
  UNION ALL SELECT 'duplicate booking', count(*) - count(DISTINCT booking_id)
    - CAST(COALESCE(max(booking_id IS NULL), FALSE) AS INTEGER) FROM x_silver
  UNION ALL SELECT 'booking_date sentinel', count(*) FILTER (WHERE booking_date = DATE '1900-01-01') FROM x_silver
  UNION ALL SELECT 'total_amount zero-filled', count(*) FILTER (WHERE total_amount = 0) FROM x_silver)""",
                                           "x_silver"))
def q_dq_native_summary(spark, sf_dir):
    return quality.dq_native_summary(_silver(spark, sf_dir))


@register("dq_table_checks", O.with_ctes(f"""
SELECT 'silver_bookings' AS model, 'min_rows' AS "check", count(*) AS observed, count(*) >= 100000 AS success
FROM x_silver
UNION ALL SELECT 'silver_bookings', 'not_empty', count(*), count(*) > 0 FROM x_silver
UNION ALL SELECT 'silver_bookings', 'required_columns', 0, TRUE
UNION ALL SELECT 'bronze_weather', 'not_empty', count(*), count(*) > 0 FROM x_wread
UNION ALL SELECT 'bronze_weather', 'city_not_null', count(*) FILTER (WHERE city IS NULL),
  count(*) FILTER (WHERE city IS NULL) = 0 FROM x_wread
UNION ALL SELECT 'bronze_weather', 'temperature_in_range', count(*) FILTER (WHERE temperature_c IS NOT NULL AND
  (temperature_c < -60 OR temperature_c > 60)),
  count(*) FILTER (WHERE temperature_c IS NOT NULL AND
  (temperature_c < -60 OR temperature_c > 60)) = 0 FROM x_wread
UNION ALL SELECT 'bronze_exchange_rates', 'not_empty', count(*), count(*) > 0 FROM x_rquote
UNION ALL SELECT 'bronze_exchange_rates', 'rate_positive', count(*) FILTER (WHERE NOT (rate > 0)),
  count(*) FILTER (WHERE NOT (rate > 0)) = 0 FROM x_rquote""", "x_silver", "x_wread", "x_rquote"))
def q_dq_table_checks(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return quality.dq_table_checks(_silver(spark, sf_dir), b.weather, b.rates)


@register("dq_required_values", O.with_ctes(f"""
SELECT v AS value, v IN (SELECT target_currency FROM x_rquote) AS present
FROM (VALUES {', '.join(f'({O.q(c)})' for c in O.REQUIRED_RATES)}) t(v)""", "x_rquote"))
def q_dq_required_values(spark, sf_dir):
    return quality.dq_required_values(td.rate_quotes(spark, sf_dir), "target_currency")


@register("dq_model_tests", O.with_ctes("\nUNION ALL\n".join(
    O.dq_sql(src, m, rules) for m, (src, rules) in O.GOLD_RULES.items()),
    *[src for src, _ in O.GOLD_RULES.values()]))
def q_dq_model_tests(spark, sf_dir):
    g = _gold(spark, sf_dir)
    tables = {"fact_bookings": g.fact, "dim_city": g.dim_city, "dim_hotel": g.dim_hotel,
              "dim_date": g.dim_date, "kpi_revenue": g.kpi}
    # silver and the city dimension are written tables here, so each gold
    # table is a cheap projection / aggregate over them
    return quality.dq_model_tests(tables)


# ---- lookups and enrichment ----------------------------------------------------------------

@register("distinct_cities", O.with_ctes("SELECT * FROM x_cities", "x_cities"))
def q_distinct_cities(spark, sf_dir):
    return enrich.distinct_cities(_silver(spark, sf_dir))


@register("city_source_fallback", O.with_ctes("""
SELECT DISTINCT trim(city_clean) AS city FROM x_silver
WHERE city_clean IS NOT NULL AND city_clean <> 'Unknown' AND city_clean <> '' AND trim(city_clean) <> ''""",
                                              "x_silver"))
def q_city_source_fallback(spark, sf_dir):
    return enrich.city_sources(_silver(spark, sf_dir), td.bronze_batch(spark, sf_dir))


@register("city_source_bronze", O.with_ctes("""
SELECT DISTINCT trim(city) AS city FROM x_batch WHERE city IS NOT NULL AND trim(city) <> ''""", "x_batch"))
def q_city_source_bronze(spark, sf_dir):
    """No usable silver city: all distinct bronze cities."""
    silver = _silver(spark, sf_dir).where("city_clean = 'Unknown'")
    return enrich.city_sources(silver, td.bronze_batch(spark, sf_dir))


@register("city_source_default", O.with_ctes("""
SELECT t.city, coalesce(n, 0) AS bookings
FROM (VALUES ('Amsterdam'), ('Berlin'), ('Paris'), ('London'), ('Istanbul')) t(city)
LEFT JOIN (SELECT trim(city_clean) AS city, count(*) AS n FROM x_silver GROUP BY 1) s ON s.city = t.city""", "x_silver"))
def q_city_source_default(spark, sf_dir):
    """Neither silver nor bronze has a city: the default ones, here with their
    bookings."""
    none = td.bronze_batch(spark, sf_dir).where("CAST(booking_id AS BIGINT) < 0")
    counts = _silver(spark, sf_dir).groupBy(F.trim("city_clean").alias("city")).agg(F.count("*").alias("n"))
    return (enrich.city_sources(none, none).join(counts, "city", "left")
            .select("city", F.coalesce("n", F.lit(0).cast("long")).alias("bookings")))


@register("top_cities", O.with_ctes("""
SELECT city, count(*) AS bookings FROM x_batch WHERE city IS NOT NULL GROUP BY city
ORDER BY bookings DESC, city ASC LIMIT 10""", "x_batch"))
def q_top_cities(spark, sf_dir):
    return report.top_cities(td.bronze_batch(spark, sf_dir), 10, "city")


@register("rates_pivot", O.with_ctes("SELECT 1.0 AS rate_eur, " + ", ".join(
    f"max(CASE WHEN r_currency = {O.q(c)} THEN rate END) AS rate_{c.lower()}" for c in O.TARGET_CURRENCIES)
    + " FROM x_rlk", "x_rlk"))
def q_rates_pivot(spark, sf_dir):
    return enrich.rates_pivot(enrich.latest_rates(td.rate_quotes(spark, sf_dir)))


@register("enrich_weather_rates", O.with_ctes("""
SELECT booking_id, city_clean, currency, temperature_c, weather_code, exchange_rate_to_eur FROM x_enriched""",
                                              "x_enriched"))
def q_enrich_weather_rates(spark, sf_dir):
    return _enriched(spark, sf_dir).select("booking_id", "city_clean", "currency", "temperature_c",
                                                     "weather_code", "exchange_rate_to_eur")


# ---- sources ------------------------------------------------------------------------------

@register("weather_json_flatten", O.with_ctes(f"""
SELECT {O.initcap('trim(city)')} AS city, country_api, latitude, longitude, temperature_c, humidity, weather_code,
  date_trunc('minute', recorded_at) AS recorded_at, 'open-meteo' AS source
FROM x_wread WHERE n_nationkey <> 24""", "x_wread"))
def q_weather_json_flatten(spark, sf_dir):
    from ..sources.files import flatten_weather
    return flatten_weather(td.weather_payloads(spark, sf_dir)).drop("ingestion_time")


@register("weather_variant", O.with_ctes(f"""
SELECT event_id AS payload_id, {O.initcap('trim(city)')} AS city, country_api, latitude, longitude,
  CASE WHEN event_id % 7 <> 0 THEN temperature_c END AS temperature_c, humidity, weather_code,
  date_trunc('minute', recorded_at) AS recorded_at, CASE WHEN event_id % 7 = 0 THEN 'temperature_c' ELSE '' END AS unread,
  CASE WHEN event_id % 11 = 0 THEN 7 END AS station
FROM x_wread WHERE n_nationkey <> 24""", "x_wread"))
def q_weather_variant(spark, sf_dir):
    """Payloads whose shape changed, landed whole: one field lost in some, an
    undeclared one read from the landed column in others."""
    from ..session import scratch_path
    from ..sources import variant
    landed = variant.land_weather(td.weather_payloads_odd(spark, sf_dir), scratch_path(spark, "weather_variant"))
    return variant.weather_rows(landed).select(
        "payload_id", "city", *variant.WEATHER_FIELDS, F.array_join("unread", ",").alias("unread"),
        F.try_variant_get("forecast", "$.current.station", "int").alias("station"))


@register("rates_variant", O.with_ctes("""
SELECT 'EUR' AS base_currency, target_currency, rate, date_trunc('second', ts) AS timestamp, '' AS unread
FROM x_rquote""", "x_rquote"))
def q_rates_variant(spark, sf_dir):
    from ..session import scratch_path
    from ..sources import variant
    landed = variant.land_rates(td.rate_payloads(spark, sf_dir), scratch_path(spark, "rates_variant"))
    return variant.rate_rows(landed).select("base_currency", "target_currency", "rate", "timestamp",
                                            F.array_join("unread", ",").alias("unread"))


@register("rates_map_explode", O.with_ctes(f"""
SELECT 'EUR' AS base_currency, target_currency, rate, date_trunc('second', ts) AS timestamp,
  'exchangerate-api' AS source FROM x_rquote""", "x_rquote"))
def q_rates_map_explode(spark, sf_dir):
    from ..sources.files import explode_rates
    return explode_rates(td.rate_payloads(spark, sf_dir)).drop("ingestion_time")


_CSV_COLS = ["booking_id", "hotel_id", "hotel_type", "city", "country", "room_type", "currency", "booking_status"]


@register("ingest_csv", O.with_ctes(f"SELECT {', '.join(_CSV_COLS)}, TRUE AS from_csv_file FROM x_batch", "x_batch"))
def q_ingest_csv(spark, sf_dir):
    from pyspark.sql import types as T

    from ..session import scratch_path
    from ..sources.files import ingest_csv
    path = scratch_path(spark, "landing-csv")
    (td.bronze_batch(spark, sf_dir).select(*_CSV_COLS).write.mode("overwrite").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _CSV_COLS])
    df = ingest_csv(spark, path, schema)
    return df.select(*_CSV_COLS, F.col("source_file").endswith(".csv").alias("from_csv_file"))


@register("overwrite_roundtrip", O.with_ctes("SELECT w_city, temperature_c, weather_code FROM x_wlk", "x_wlk"))
def q_overwrite_roundtrip(spark, sf_dir):
    """Write the raw readings, then overwrite the same table with the lookup
    (different schema): the read-back has only the new schema and rows."""
    from ..session import scratch_path
    from ..sources.tables import overwrite_table
    path = scratch_path(spark, "table")
    readings = td.weather_readings(spark, sf_dir)
    overwrite_table(readings, path)
    return overwrite_table(enrich.latest_weather(readings), path)


@register("overwrite_guarded", O.with_ctes("SELECT w_city, temperature_c, weather_code FROM x_wlk", "x_wlk"))
def q_overwrite_guarded(spark, sf_dir):
    """A named table is replaced by the lookup; an empty result then leaves
    it as it is."""
    import uuid

    from ..session import scratch_path
    from ..sources.tables import overwrite_if_nonempty, overwrite_table, read_table
    path, name = scratch_path(spark, "named"), f"weather_lookup_{uuid.uuid4().hex[:8]}"
    readings = td.weather_readings(spark, sf_dir)
    overwrite_table(readings, path, name)
    lookup = enrich.latest_weather(readings)
    overwrite_if_nonempty(lookup, path, name)
    overwrite_if_nonempty(lookup.where("w_city IS NULL AND temperature_c > 1e9"), path, name)
    return read_table(spark, name)


def _empty_table_sql() -> str:
    from ..sources.schemas import STREAM_TABLE_COLUMNS
    have = {"booking_id": "CAST(event_id AS VARCHAR)", "customer_id": "CAST(user_id + 1000 AS VARCHAR)",
            "hotel_id": "CAST(user_id AS VARCHAR)", "booking_date": "CAST(ts AS VARCHAR)",
            "room_type": "CASE event_type WHEN 'click' THEN 'Single' WHEN 'view' THEN 'Double' WHEN 'signup' "
                         "THEN 'Suite' WHEN 'purchase' THEN 'Deluxe' ELSE '--' END",
            "nights": "CAST(1 + k % 14 AS VARCHAR)", "adults": "CAST(1 + event_id % 4 AS VARCHAR)",
            "booking_status": "CASE event_type WHEN 'purchase' THEN 'Confirmed' WHEN 'error' THEN 'Cancelled' "
                              "ELSE 'Pending' END",
            "source_system": O.pick(['MobileApp', 'Web', 'Agency'], 'k % 3'),
            "event_time": "CAST(ts AS VARCHAR)"}
    cols = [f"{have.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in STREAM_TABLE_COLUMNS]
    return O.with_ctes(f"SELECT {', '.join(cols)} FROM x_ev", "x_ev")


@register("empty_typed_table", _empty_table_sql())
def q_empty_typed_table(spark, sf_dir):
    """The stream landing table: created empty with its 73 declared string
    columns, then the landed events appended by name."""
    from ..sources.schemas import STREAM_TABLE_SCHEMA
    from ..sources.tables import conform, create_empty_table
    empty = create_empty_table(spark, STREAM_TABLE_SCHEMA)
    return empty.unionByName(conform(td.bronze_stream(spark, sf_dir), STREAM_TABLE_SCHEMA))


_INVENTORY = ["orders", "lineitem", "customer", "events"]


@register("table_inventory", "\nUNION ALL ".join(
    [f"SELECT 'bronze_{t}' AS table_name, count(*) AS row_count, 'ok' AS status FROM {t}" for t in _INVENTORY]
    + ["SELECT 'gold_fact_bookings_archive', CAST(NULL AS BIGINT), 'not found'"]))
def q_table_inventory(spark, sf_dir):
    from ..sources.tables import table_inventory
    for t in _INVENTORY:
        td.read(spark, sf_dir, t).createOrReplaceTempView(f"bronze_{t}")
    return table_inventory(spark, [f"bronze_{t}" for t in _INVENTORY] + ["gold_fact_bookings_archive"])


@register("multi_file_scan", O.with_ctes("SELECT city FROM x_batch", "x_batch"))
def q_multi_file_scan(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.files import multi_file_scan
    path = scratch_path(spark, "cities")
    (td.bronze_batch(spark, sf_dir).select("city", "country").write.mode("overwrite").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return multi_file_scan(spark, [f"{path}/*.csv"], "city")


@register("positional_split", """
SELECT *, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(count(*) OVER () * 0.7)
  THEN 'batch' ELSE 'stream' END AS part FROM orders""")
def q_positional_split(spark, sf_dir):
    from ..operators.split import positional_split
    return positional_split(td.read(spark, sf_dir, "orders"), ["o_orderkey"], K.BATCH_SHARE)


# ---- streaming ------------------------------------------------------------------------------

def _stream_run(spark, sf_dir):
    """Land the events as JSON files, drain them through the fan-out query,
    return the two sink paths."""
    from ..session import scratch_path
    from ..streaming import events as ev
    base = scratch_path(spark, "stream")
    landing = ev.land_events_json(ev.event_records(td.bronze_stream(spark, sf_dir)), f"{base}/landing")
    ev.run_available(spark, landing, f"{base}/raw", f"{base}/typed", f"{base}/checkpoint", max_files=4)
    return f"{base}/raw", f"{base}/typed"


_EVENT_SQL = O.with_ctes(f"""
SELECT CAST(event_id AS VARCHAR) AS booking_id, user_id + 1000 AS customer_id, CAST(user_id AS VARCHAR) AS hotel_id,
  CAST(ts AS VARCHAR) AS booking_date,
  CASE event_type WHEN 'click' THEN 'Single' WHEN 'view' THEN 'Double' WHEN 'signup' THEN 'Suite'
       WHEN 'purchase' THEN 'Deluxe' ELSE '--' END AS room_type,
  value * 10 AS total_amount, {O.pick(O.CURRENCIES, 'event_id % 7')} AS currency,
  {O.pick(['MobileApp', 'Web', 'Agency'], 'k % 3')} AS source_system, CAST(ts AS VARCHAR) AS ingestion_time
FROM x_ev""", "x_ev")


@register("stream_events_sink", _EVENT_SQL)
def q_stream_events_sink(spark, sf_dir):
    raw, _ = _stream_run(spark, sf_dir)
    return spark.read.parquet(raw).drop(*SLICE)


@register("stream_json_mapping", O.with_ctes(f"""
SELECT booking_id, customer_id, TRY_CAST(hotel_id AS BIGINT) AS hotel_id, CAST(booking_date AS TIMESTAMP) AS booking_date,
  room_type, total_amount, currency, source_system, CAST(ingestion_time AS TIMESTAMP) AS ingestion_time
FROM ({_EVENT_SQL})"""))
def q_stream_json_mapping(spark, sf_dir):
    _, typed = _stream_run(spark, sf_dir)
    return spark.read.parquet(typed).drop(*SLICE)


@register("stream_fanout", """
SELECT 'raw' AS sink, count(*) AS row_count FROM events UNION ALL SELECT 'typed', count(*) FROM events""")
def q_stream_fanout(spark, sf_dir):
    raw, typed = _stream_run(spark, sf_dir)
    return (spark.read.parquet(raw).agg(F.lit("raw").alias("sink"), F.count("*").alias("row_count"))
            .unionByName(spark.read.parquet(typed).agg(F.lit("typed").alias("sink"), F.count("*").alias("row_count"))))


def _landed_stream(spark, sf_dir) -> DataFrame:
    """The stream table as it lands: JSON files drained slice by slice."""
    from ..session import scratch_path
    from ..streaming import events as ev
    base = scratch_path(spark, "stream-table")
    source = td.bronze_stream(spark, sf_dir)
    ev.land_events_json(source, f"{base}/landing")
    ev.land_stream(ev.stream_events(spark, f"{base}/landing", source.schema, max_files=4), f"{base}/table",
                   f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table").drop(*SLICE)


@register("stream_rescue", O.with_ctes("""
SELECT 'raw' AS sink, count(*) AS row_count, count(*) FILTER (event_id % 7 = 1) AS null_customers
FROM x_ev WHERE event_id % 7 <> 0
UNION ALL SELECT 'typed', count(*), count(*) FILTER (event_id % 7 = 1) FROM x_ev WHERE event_id % 7 <> 0
UNION ALL SELECT 'rescued', count(*), 0 FROM x_ev WHERE event_id % 7 = 0""", "x_ev"))
def q_stream_rescue(spark, sf_dir):
    """The events as JSON lines, a seventh of them cut short and a seventh with
    text for a number: three sinks that add up to the input."""
    from ..session import scratch_path
    from ..streaming import events as ev
    base = scratch_path(spark, "rescue")
    records = ev.event_records(td.bronze_stream(spark, sf_dir))
    turn = F.col("booking_id").cast("long") % 7
    line = F.to_json(F.struct(*[F.when(turn == 1, F.lit("none")).otherwise(F.col(c).cast("string")).alias(c)
                                if c == "customer_id" else F.col(c) for c in records.columns]))
    line = F.regexp_replace(line, r'"customer_id":"(\d+)"', r'"customer_id":$1')
    (records.select(line.alias("line"), turn.alias("turn"))
     .select(F.when(F.col("turn") == 0, F.expr("left(line, length(line) - 3)")).otherwise(F.col("line")).alias("value"))
     .write.text(f"{base}/landing"))
    sinks = {n: f"{base}/{n}" for n in ("raw", "typed", "rescued")}
    ev.run_available(spark, f"{base}/landing", sinks["raw"], sinks["typed"], f"{base}/checkpoint", max_files=4,
                     bad_path=sinks["rescued"])
    parts = []
    for n, path in sinks.items():
        df = spark.read.parquet(path)
        lost = F.count_if(F.col("customer_id").isNull()) if n != "rescued" else F.lit(0).cast("long")
        parts.append(df.agg(F.lit(n).alias("sink"), F.count("*").alias("row_count"), lost.alias("null_customers")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("stream_validate_count", "SELECT count(*) AS total_rows FROM events")
def q_stream_validate_count(spark, sf_dir):
    return _landed_stream(spark, sf_dir).agg(F.count("*").alias("total_rows"))


@register("stream_validate_latest", O.with_ctes("""
SELECT booking_id, event_ts AS event_time, hotel_id, room_type, currency, booking_status
FROM x_stream ORDER BY event_ts DESC, booking_id LIMIT 100""", "x_stream"))
def q_stream_validate_latest(spark, sf_dir):
    s = _landed_stream(spark, sf_dir).withColumn("event_time", F.try_to_timestamp("event_time"))
    return (s.orderBy(F.col("event_time").desc(), F.col("booking_id")).limit(100)
            .select("booking_id", "event_time", "hotel_id", "room_type", "currency", "booking_status"))


def _watched(spark, sf_dir) -> str:
    """The state table of the landed stream."""
    from ..session import scratch_path
    from ..streaming import events as ev
    from ..streaming import validation
    base = scratch_path(spark, "stream-watch")
    source = td.bronze_stream(spark, sf_dir)
    ev.land_events_json(source, f"{base}/landing")
    validation.run_watch(ev.stream_events(spark, f"{base}/landing", source.schema, max_files=4), f"{base}/states",
                         f"{base}/checkpoint")
    return f"{base}/states"


@register("stream_watch_count", "SELECT count(*) AS total_rows FROM events")
def q_stream_watch_count(spark, sf_dir):
    """The count kept by the running stream's state."""
    from ..streaming import validation
    return validation.seen_count(spark, _watched(spark, sf_dir))


@register("stream_watch_latest", O.with_ctes("""
SELECT booking_id, event_ts AS event_time, hotel_id, room_type, currency, booking_status
FROM x_stream ORDER BY event_ts DESC, booking_id LIMIT 100""", "x_stream"))
def q_stream_watch_latest(spark, sf_dir):
    """The latest 100 kept by the running stream's state."""
    from ..streaming import validation
    return validation.seen_latest(spark, _watched(spark, sf_dir))


@register("universal_clean", O.with_ctes(f"""
SELECT {O.clean_string('booking_id')} AS booking_id, {O.clean_phone('hotel_id')} AS hotel_id,
  {O.clean_string('customer_id')} AS customer_id,
  {O.clean_string('CAST(temperature_c AS VARCHAR)')} AS temperature_c,
  {O.clean_string('CAST(weather_code AS VARCHAR)')} AS weather_code,
  COALESCE(abs(exchange_rate_to_eur), 0.0) AS exchange_rate_to_eur,
  {O.clean_string('city_clean')} AS city_clean, {O.clean_string('currency', upper=True)} AS currency,
  COALESCE(abs({O.to_int(O.words('star_rating'))}), 0) AS star_rating
FROM x_imputed""", "x_imputed"))
def q_universal_clean(spark, sf_dir):
    """Universal clean in parity mode: the original substring rules, with
    their side effects on ids (phone rule), weather (text rule) and rates
    (zero fill)."""
    df = clean.universal_clean(_enriched(spark, sf_dir), parity=True, drop_midnight=False)
    return df.select("booking_id", "hotel_id", "customer_id", "temperature_c", "weather_code",
                     "exchange_rate_to_eur", "city_clean", "currency", "star_rating")
