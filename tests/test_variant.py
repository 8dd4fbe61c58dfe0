"""Landed payloads of unknown shape."""

from pyspark.sql import functions as F

from staywise.sources import variant as V

GEO = '{"results":[{"latitude":%s,"longitude":13.4,"country":"Germany","elevation":74}]}'
NOW = '{"current":{"temperature_2m":%s,"relative_humidity_2m":80,"weather_code":3,"time":"2024-01-01T10:00","wind":{"kmh":7}}}'


def test_a_field_of_another_type_costs_that_field(spark, tmp_path):
    rows = [(" berlin", GEO % "52.5", NOW % "-5.0"), ("hot", GEO % '"north"', NOW % '"n/a"'),
            ("void", GEO % "null", NOW % "null"), ("atlantis", "{}", NOW % "1"), ("bad", GEO % "1", "{no json"),
            ("none", GEO % "1", None), ("list", GEO % "1", "[1, 2]"), ("lost", None, NOW % "1")]
    df = spark.createDataFrame(rows, "city string, geocode_json string, weather_json string")
    landed = V.land_weather(df, str(tmp_path / "w"))
    assert landed.count() == len(rows) and dict(landed.dtypes)["forecast"] == "variant"
    got = {r.city: r for r in V.weather_rows(landed).withColumn(
        "wind", F.try_variant_get("forecast", "$.current.wind.kmh", "int")).drop("geocode", "forecast").collect()}
    assert set(got) == {"Berlin", "Hot", "Void", "Bad", "None", "List"}
    assert (got["Berlin"].temperature_c, got["Berlin"].latitude, got["Berlin"].unread) == (-5.0, 52.5, [])
    hot = got["Hot"]
    assert (hot.temperature_c, hot.latitude, hot.humidity, hot.longitude, hot.wind) == (None, None, 80, 13.4, 7)
    assert hot.unread == ["latitude", "temperature_c"] and str(hot.recorded_at) == "2024-01-01 10:00:00"
    assert got["Void"].unread == [] and got["Void"].temperature_c is None   # null is no fault
    assert got["Bad"].forecast_rescued == "{no json" and got["Bad"].latitude == 1.0 and got["Bad"].humidity is None
    assert all(got[c].unread == [] for c in ("Bad", "None", "List"))   # what is not there is not unread
    assert got["None"].forecast_rescued is None and got["List"].humidity is None


def test_rates_of_unknown_shape(spark, tmp_path):
    rows = [('{"base_code":"EUR","time_last_update_utc":"Mon, 01 Jan 2024 00:00:01 +0000",'
             '"rates":{"USD":1.1,"CHF":0.9,"TRY":"closed","GBP":null},"terms":"t"}',),
            ('{"rates":{"GBP":0.8},"time_last_update_utc":"2024-02-01T10:00:00"}',),
            ('{"rates":[1, 2]}',), ('{"rates":{"AED":4},"base_code":{"x":1}}',), ("nonsense",), (None,)]
    landed = V.land_rates(spark.createDataFrame(rows, "payload string"), str(tmp_path / "r"))
    assert landed.count() == len(rows) and landed.where("payload_rescued = 'nonsense'").count() == 1
    got = {(r.target_currency, r.base_currency, r.rate, str(r.timestamp), tuple(r.unread))
           for r in V.rate_rows(landed).drop("payload").collect()}
    assert got == {("USD", "EUR", 1.1, "2024-01-01 00:00:01", ()), ("TRY", "EUR", None, "2024-01-01 00:00:01", ("rate",)),
                   ("GBP", "EUR", None, "2024-01-01 00:00:01", ()), ("GBP", "EUR", 0.8, "2024-02-01 10:00:00", ()),
                   ("AED", "EUR", 4.0, "None", ("base_currency",))}
