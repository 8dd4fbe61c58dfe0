"""Golden cases from the original logic tests and rules, on Spark expressions."""

from pyspark.sql import functions as F

from staywise.functions import constants as K
from staywise.functions import numbers as N
from staywise.functions import text as T
from staywise.operators import clean


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_city_clean(spark):
    got = one(spark, [("Cologne....",), ("Rotterdam   ",), ("Berlin. . .",), ("Amsterdam",), ("istanbul",), (None,)],
              "c string", T.city_clean("c"))
    assert got == ["Cologne", "Rotterdam", "Berlin", "Amsterdam", "Istanbul", None]


def test_junk_strings(spark):
    got = one(spark, [("--",), ("!!Resort",), (" ? ",), ("null",), ("  new york  ",), (None,)], "c string",
              T.clean_string("c"))
    assert got == ["Unknown", "Resort", "Unknown", "Unknown", "New York", None]


def test_strip_edges_equals_trim_and_pattern(spark):
    values = ["a", " a ", "--a--", "a--\n", "a--\r\n", "\n--a", "a\u2028", "a-\u0085", "---", "", " ", "- a -", "a-b", "é!", "\ta",
              " -5.0", "a--\n\n", None]
    rows = [(v,) for v in values]
    want = F.regexp_replace(F.trim("c"), K.JUNK_EDGE_PATTERN, "")
    assert one(spark, rows, "c string", T.strip_edges("c")) == one(spark, rows, "c string", want)
    assert one(spark, [(-1.5,), (20.0,)], "c double", T.strip_edges("c")) == ["1.5", "20.0"]


def test_universal_clean_searches_and_parses_a_value_once(spark):
    df = spark.createDataFrame([("!!ams ", "+1 (555) 123", "Two", "95")],
                               "city string, phone string, adults string, latitude string")
    out = clean.universal_clean(df, drop_midnight=False)
    assert out.first() == ("Ams", "+1555123", 2, None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # one search for the city, one for the phone, one parse of each number
    assert plan.count("regexp_replace(") == 2 and plan.count("[One,Two") == 2


def test_currency_upper(spark):
    assert one(spark, [(" usd ",), ("eur",)], "c string", T.clean_string("c", upper=True)) == ["USD", "EUR"]


def test_phone(spark):
    got = one(spark, [("12-3",), ("+1 (555) 123-4567",), ("00000000",), (None,)], "c string", T.clean_phone("c"))
    assert got == ["Unknown", "+15551234567", "Unknown", None]


def test_number_words_and_numeric(spark):
    got = one(spark, [("Two",), ("two",), ("-3",), ("4.0",), (None,)], "c string",
              N.clean_amount(N.words_to_digits("c"), as_int=True))
    assert got == [2, 0, 3, 4, 0]


def test_coordinates(spark):
    got = one(spark, [(95.0,), (0.0,), (-33.5,), (None,)], "c double", N.clean_coord("c", 90))
    assert got == [None, None, -33.5, None]


def test_tier(spark):
    got = one(spark, [(5,), (3,), (2,), (None,)], "c int", N.hotel_tier("c"))
    assert got == ["Premium", "Standard", "Budget", "Budget"]


def test_imputation(spark):
    df = spark.createDataFrame([("a", 300.0, None, 3), ("b", None, 100.0, 3), ("c", 300.0, None, 0),
                                ("d", None, None, 2)],
                               "id string, total_amount double, room_price double, nights int")
    got = {r.id: (r.total_amount, r.room_price) for r in clean.impute_prices(df).collect()}
    assert got == {"a": (300.0, 100.0), "b": (300.0, 100.0), "c": (300.0, None), "d": (None, None)}


def test_eur_amount_and_nightly(spark):
    from staywise.operators.gold import fact_bookings
    df = spark.createDataFrame(
        [("b1", "h1", "c1", "2024-01-02", "X", "DE", "n", "t", 3, "r", 3.0, 2, 0.0, "Confirmed", "s", "TRY",
          100.0, 0.0, 34.5, None, None),
         ("b2", "h1", "c1", "1900-01-01", "X", "DE", "n", "t", 3, "r", 3.0, 2, 0.0, "Confirmed", "s", "EUR",
          450.0, 0.0, None, None, None)],
        "booking_id string, hotel_id string, customer_id string, booking_date string, city_clean string, "
        "country string, hotel_name string, hotel_type string, star_rating int, room_type string, nights double, "
        "adults int, children double, booking_status string, source_system string, currency string, "
        "total_amount double, room_price double, exchange_rate_to_eur double, temperature_c double, "
        "weather_code bigint").withColumn("booking_date", F.to_date("booking_date"))
    rows = fact_bookings(df).collect()
    assert len(rows) == 1                       # the 1900 sentinel row is filtered
    assert rows[0].total_amount_eur == 3450.0   # 100 x 34.5
    assert rows[0].avg_nightly_rate == round(100 / 3, 2)


def test_nightly_rate_rule(spark):
    got = one(spark, [(450.0, 3.0)], "t double, n double",
              F.when(F.col("n") > 0, F.round(F.col("t") / F.col("n"), 2)).otherwise(F.col("t")))
    assert got == [150.0]


def test_temperature_parity_quirk(spark):
    """Parity mode cleans the temperature as text: the sign is stripped."""
    df = spark.createDataFrame([("1", -5.0)], "booking_id string, temperature_c double")
    par = clean.universal_clean(df, parity=True, drop_midnight=False).first()
    fixed = clean.universal_clean(df, parity=False, drop_midnight=False).first()
    assert par.temperature_c == "5.0"
    assert fixed.temperature_c == -5.0
