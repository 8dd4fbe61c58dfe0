"""Map the driver's TPC-H-like tables onto the booking data model.

Every frame here is derived by Spark from the given tables, so its size
grows with them.  The same mapping is stated independently as SQL in
``staywise.plans.oracle`` for the DuckDB comparison.

* batch bookings  <- orders (+ customer, nation, region, lineitem per order)
* stream bookings <- events (props JSON carries a small integer ``k``)
* weather readings and exchange-rate quotes <- events (+ nation)
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

BATCH_INGESTION_TIME = "2024-01-15 00:00:00"
BATCH_SOURCE_FILE = "hotel_raw_batch.csv"

HOTEL_TYPE_BY_SEGMENT = {"BUILDING": "Business Hotel", "AUTOMOBILE": "City Hotel",
                         "FURNITURE": "Boutique", "HOUSEHOLD": "Resort"}
HOTEL_TYPE_OTHER = "Luxury Hotel"
ROOM_BY_PRIORITY = {"1-URGENT": "Suite", "2-HIGH": "Deluxe", "3-MEDIUM": "Double"}
ROOM_BY_EVENT = {"click": "Single", "view": "Double", "signup": "Suite", "purchase": "Deluxe"}
SOURCES = ["Web", "MobileApp", "Agency"]
EXTRA_QUOTE_CURRENCY = "CHF"


_READS: OrderedDict = OrderedDict()
_KEPT_READS = 32


def version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table or of a folder of
    tables: changes when a file lands or goes."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    out = []
    todo = [p]
    while todo:
        for f in fs.listStatus(todo.pop()):
            if f.isDirectory():
                todo.append(f.getPath())
            elif not f.getPath().getName().startswith("_"):
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table as a DataFrame; the relation (file listing, footers,
    schema) is shared by the queries of a session as long as the table's
    files stay the same."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    from ..session import session_key
    key = session_key(spark) + (path, version(spark, path))
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
        while len(_READS) > _KEPT_READS:
            _READS.popitem(last=False)
    return _READS[key]


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def _pick(values: list, idx: Column) -> Column:
    """values[idx] for a non-negative integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def city_base(n_name: Column) -> Column:
    """'NATION_3' -> 'nation 3' (raw, lower-case city text)."""
    return F.regexp_replace(F.lower(n_name), "_", " ")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: 25 rows by the TPC-H definition (fixed size)."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left") \
        .select("n_nationkey", "n_name", "n_regionkey", "r_name")


def bronze_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty batch bookings, one per order, as a CSV landing would hold them."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                               "c_mktsegment")
    li = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    loc = locations(spark, sf_dir)
    df = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(F.broadcast(loc), F.col("c_nationkey") == loc.n_nationkey, "left")
          .join(li, o.o_orderkey == li.l_orderkey, "left"))
    k = F.col("o_orderkey")
    segment_type = _case(F.col("c_mktsegment"), HOTEL_TYPE_BY_SEGMENT, HOTEL_TYPE_OTHER)
    base_city = city_base(F.col("n_name"))
    star = F.floor((F.col("c_acctbal") + 1000) / 2200).cast("int")
    return df.select(
        _s(k).alias("booking_id"),
        F.concat(F.lit("HTL-"), _s(F.col("o_custkey"))).alias("hotel_id"),
        _s(1000 + (k * 7919) % 9000).alias("customer_id"),
        F.col("c_name").alias("hotel_name"),
        F.when(k % 19 == 0, F.lit("--"))
         .when(k % 23 == 0, F.concat(F.lit("!!"), segment_type))
         .when(k % 29 == 0, F.concat(segment_type, F.lit("...")))
         .otherwise(segment_type).alias("hotel_type"),
        F.when(k % 31 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 0, F.concat(base_city, F.lit(". .")))
         .when(k % 5 == 1, F.concat(F.upper(base_city), F.lit("   ")))
         .when(k % 5 == 2, F.concat(base_city, F.lit("....")))
         .when(k % 5 == 3, F.concat(F.lit("  "), base_city))
         .otherwise(base_city).alias("city"),
        F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("country"),
        F.when(k % 41 == 0, F.lit("Four")).when(k % 43 == 0, F.lit("four"))
         .otherwise(_s(star)).alias("star_rating"),
        F.when(k % 47 == 0, F.lit("95"))
         .otherwise(_s(F.col("n_nationkey") * 3.5 - 42)).alias("latitude"),
        _s(F.col("n_regionkey") * 30 - 60 + F.col("n_nationkey")).alias("longitude"),
        F.when(k % 53 == 0, F.lit("???"))
         .otherwise(_case(F.col("o_orderpriority"), ROOM_BY_PRIORITY, "Single")).alias("room_type"),
        _s(F.col("n_lines")).alias("nights"),
        F.when(k % 17 == 0, F.lit("Two")).when(k % 59 == 0, F.lit("-3"))
         .otherwise(_s(1 + k % 4)).alias("adults"),
        _s(k % 3).alias("children"),
        _case(F.col("o_orderstatus"), {"F": "Confirmed", "O": "Pending"}, "Canceled").alias("booking_status"),
        _pick(SOURCES, k % 3).alias("source_system"),
        F.col("o_orderpriority").alias("booking_channel"),
        F.when(k % 11 == 0, F.concat(F.lower(_pick(K.CURRENCIES, k % 7)), F.lit(" ")))
         .otherwise(_pick(K.CURRENCIES, k % 7)).alias("currency"),
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("total_price"),
        F.when((k % 3 == 0) & (F.col("n_lines") > 0), F.col("o_totalprice") / F.col("n_lines"))
         .alias("room_price"),
        F.when(k % 61 == 0, F.lit("not a date"))
         .otherwise(_s(F.to_date(F.col("o_orderdate")))).alias("booking_date"),
        F.when(k % 67 == 0, F.lit("TBD"))
         .otherwise(_s(F.date_add(F.to_date(F.col("o_orderdate")), (k % 30).cast("int"))))
         .alias("checkin_date"),
        F.when(k % 71 == 0, F.lit("12-3")).when(k % 73 == 0, F.lit("00000000"))
         .otherwise(F.concat(F.lit("+1 (555) "), F.lpad(_s(F.col("o_custkey") % 10000), 4, "0")))
         .alias("phone"),
        F.to_timestamp(F.lit(BATCH_INGESTION_TIME)).alias("ingestion_time"),
        F.lit(BATCH_SOURCE_FILE).alias("source_file"),
    )


def event_k(props: Column | None = None) -> Column:
    """Integer ``k`` from the events' props JSON ({"k": n})."""
    p = F.col("props") if props is None else props
    return F.get_json_object(p, "$.k").try_cast("int")


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed bookings (all strings) as the event landing table holds them."""
    e = read(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = event_k()
    return e.select(
        _s(eid).alias("booking_id"),
        _s(F.col("user_id") + 1000).alias("customer_id"),
        _s(F.col("user_id")).alias("hotel_id"),
        _s(F.col("ts")).alias("booking_date"),
        _case(F.col("event_type"), ROOM_BY_EVENT, "--").alias("room_type"),
        _s(1 + k % 14).alias("nights"),
        _s(1 + eid % 4).alias("adults"),
        _s(F.col("value") * 10).alias("total_amount"),
        _pick(K.CURRENCIES, eid % 7).alias("currency"),
        _case(F.col("event_type"), {"purchase": "Confirmed", "error": "Cancelled"}, "Pending")
        .alias("booking_status"),
        _pick(["MobileApp", "Web", "Agency"], k % 3).alias("source_system"),
        _s(F.col("ts")).alias("ingestion_time"),
        _s(F.col("ts")).alias("event_time"),
    )


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather reading per event for the city of nation ``user_id % 25``."""
    e = read(spark, sf_dir, "events")
    loc = locations(spark, sf_dir)
    df = e.join(F.broadcast(loc), (e.user_id % 25) == loc.n_nationkey, "inner")
    return df.select(
        city_base(F.col("n_name")).alias("city"),
        F.col("r_name").alias("country_api"),
        (F.col("n_nationkey") * 3.5 - 42).alias("latitude"),
        (F.col("n_regionkey") * 30 - 60 + F.col("n_nationkey")).cast("double").alias("longitude"),
        (F.col("value") / 10 - 10).alias("temperature_c"),
        (F.col("event_id") % 100).alias("humidity"),
        event_k().cast("bigint").alias("weather_code"),
        F.col("ts").cast("timestamp").alias("recorded_at"),
        F.lit(K.WEATHER_SOURCE).alias("source"),
        F.col("ts").cast("timestamp").alias("ingestion_time"),
        F.col("event_id"),
    )


def rate_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One EUR-based quote per event for target currency ``event_id % 6``."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.lit(K.BASE_CURRENCY).alias("base_currency"),
        _pick(K.TARGET_CURRENCIES, F.col("event_id") % 6).alias("target_currency"),
        (1 + F.col("value") / 100).alias("rate"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(K.RATES_SOURCE).alias("source"),
        F.col("ts").cast("timestamp").alias("ingestion_time"),
        F.col("event_id"),
    )


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API JSON per reading: geocode text (no ``results`` when the
    city is unknown: nation 24) and forecast text."""
    w = weather_readings(spark, sf_dir)
    # nation 24's city is unknown to the geocoder: payload without "results"
    geo = F.when(F.col("city") == F.lit("nation 24"), F.to_json(F.struct(F.lit(0).alias("generationtime_ms"))))\
        .otherwise(F.to_json(F.struct(F.array(F.struct(
            F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude"),
            F.col("country_api").alias("country"))).alias("results"))))
    cur = F.to_json(F.struct(F.struct(
        F.col("temperature_c").alias("temperature_2m"),
        F.col("humidity").alias("relative_humidity_2m"),
        F.col("weather_code").alias("weather_code"),
        F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm").alias("time")).alias("current")))
    return w.select(F.col("event_id").alias("payload_id"), F.col("city"),
                    geo.alias("geocode_json"), cur.alias("weather_json"))


def weather_payloads_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`weather_payloads` as an API may change them: every 7th has its
    temperature as words, every 11th a field that nobody declared."""
    p = weather_payloads(spark, sf_dir)
    words = F.regexp_replace("weather_json", r'"temperature_2m":[^,}]+', '"temperature_2m":"not measured"')
    more = lambda c: F.regexp_replace(c, r'\{"current":\{', '{"current":{"station":7,')
    text = F.when(F.col("payload_id") % 7 == 0, words).otherwise(F.col("weather_json"))
    return p.withColumn("weather_json", F.when(F.col("payload_id") % 11 == 0, more(text)).otherwise(text))


def rate_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rates JSON per quote: RFC-1123 update time and a two-entry
    ``rates`` map (the target currency and one currency outside the list)."""
    q = rate_quotes(spark, sf_dir)
    rates = F.create_map(F.col("target_currency"), F.col("rate"),
                         F.lit(EXTRA_QUOTE_CURRENCY), F.col("rate") * 2)
    text = F.to_json(F.struct(
        F.col("base_currency").alias("base_code"),
        F.concat(F.date_format("timestamp", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
        .alias("time_last_update_utc"),
        rates.alias("rates")))
    return q.select(F.col("event_id").alias("payload_id"), text.alias("payload"))
