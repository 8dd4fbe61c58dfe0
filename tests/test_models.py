"""The gold layer as SQL models, and the calendar for many date columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staywise.operators import calendar as cal
from staywise.plans import models

BOOKINGS = ("booking_id string, hotel_id string, booking_date date, city_clean string, country string, "
            "total_amount double, nights double, booking_status string, booking_channel string")


def silver(spark, data):
    from staywise.plans.incremental import FACT_SOURCE
    df = spark.createDataFrame(data, BOOKINGS)
    for col in FACT_SOURCE.split(", "):
        name, kind = col.split(" ")
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0)})


def test_a_city_of_two_countries_stays_twice(spark):
    """The SQL dimension is not deduplicated, so its KPI counts twice where
    the readings differ or not; a city without a reading stays."""
    d = dt.date(2024, 5, 1)
    s = silver(spark, [("1", "7", d, "Berlin", "Germany", 10.0, 2.0, "Canceled", "web"),
                       ("2", "7", d, "Berlin", "Usa", 20.0, 1.0, "Confirmed", "app"),
                       ("3", "8", d, "Oslo", "Norway", 5.0, 0.0, "Confirmed", None),
                       ("4", "8", None, "Oslo", "Norway", 5.0, 1.0, "Confirmed", None)])
    weather = spark.createDataFrame(
        [("berlin", dt.datetime(2024, 1, 1), 1.0, 1, 50, 52.5, 13.4), ("Berlin ", dt.datetime(2024, 1, 2), 9.0, 3, 60, 52.5, 13.4)],
        "city string, recorded_at timestamp, temperature_c double, weather_code long, humidity long, latitude double, longitude double")
    rates = spark.createDataFrame([("USD", 1.1)], "r_currency string, rate double")
    cities = models.numbered_cities(s, weather, rates)
    t = models.run_models(spark, {"silver_bookings": s, "numbered_cities": cities})
    got = t["dim_city"].orderBy("city_key").collect()
    assert [(r.city_key, r.city, r.country, r.humidity, r.latitude, r.rate_usd, r.rate_gbp) for r in got] == [
        (1, "Berlin", "Germany", 60, 52.5, 1.1, 0.0), (2, "Berlin", "Usa", 60, 52.5, 1.1, 0.0),
        (3, "Oslo", "Norway", None, None, 1.1, 0.0)]
    kpi = {(r.city, r.country): r for r in t["kpi_revenue"].collect()}
    assert kpi["Berlin", "Germany"].total_bookings == 2 and kpi["Berlin", "Germany"].total_revenue_eur == 20.0
    assert kpi["Berlin", "Germany"].cancellation_rate == 100.0 and kpi["Berlin", "Usa"].channel_count == 1
    assert kpi["Oslo", "Norway"].total_bookings == 1 and kpi["Oslo", "Norway"].channel_count == 0
    assert t["fact_bookings"].where("booking_id = '3'").first().avg_nightly_rate == 5.0
    assert t["dim_date"].count() == 366 and t["dim_hotel"].count() == 2


def test_models_bring_what_they_read(spark, monkeypatch):
    monkeypatch.setattr(models, "MODELS", {"c": "SELECT n + 1 AS n FROM {b}", "b": "SELECT n + 1 AS n FROM {a}",
                                           "other": "SELECT * FROM {missing}"})
    got = models.run_models(spark, {"a": spark.range(1).toDF("n")}, ["c"])
    assert set(got) == {"b", "c"} and got["c"].first().n == 2
    monkeypatch.setattr(models, "MODELS", {"x": "SELECT * FROM {y}", "y": "SELECT * FROM {x}"})
    with pytest.raises(ValueError):
        models.run_models(spark, {}, ["x"])


def test_date_roles(spark):
    rows = [(1, dt.date(2023, 1, 1), dt.datetime(2024, 12, 31, 23, 59)), (2, None, dt.datetime(2024, 2, 29)),
            (3, dt.date(2022, 12, 31), None), (4, dt.date(2025, 1, 1), dt.datetime(1900, 1, 1))]
    df = spark.createDataFrame(rows, "id int, d date, t timestamp")
    days = cal.calendar_over(spark.createDataFrame(rows[:2], df.schema), ["d", "t"])
    assert days.count() == 731
    got = {r.id: r for r in cal.date_roles(df, days, ["d", "t"]).collect()}
    assert (got[1].d_Year, got[1].d_QuarterNo, got[1].t_MonthNo, got[1].t_Day) == (2023, 1, 12, 31)
    assert (got[2].d_Year, got[2].t_Year, got[2].t_Day) == (None, 2024, 29)
    assert got[3].d_Year is got[4].d_Year is got[4].t_Year is None   # a day before, a day after, long before
    assert [r.d_Year for r in cal.date_roles(df, days.limit(0), ["d"]).collect()] == [None] * 4
    for bad in (days.where("Date <> '2024-02-01'"), days.unionByName(days.limit(1))):
        with pytest.raises(Exception, match="gaps, repeated"):
            cal.date_roles(df, bad, ["d"]).collect()


def test_date_roles_read_the_calendar_once(spark, tmp_path):
    cal.dim_date(spark).selectExpr("date_key AS Date", "year AS Year").write.parquet(str(tmp_path / "c"))
    df = spark.range(5).selectExpr("id", *[f"date_add(DATE '2024-01-01', cast(id * {k} AS INT)) AS d{k}" for k in range(1, 14)])
    out = cal.date_roles(df, spark.read.parquet(str(tmp_path / "c")), [f"d{k}" for k in range(1, 14)], ["Year"])
    assert [r.d13_Year for r in out.collect()] == [2024] * 5
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]   # as it ran
    assert "Join" not in plan and plan.count("FileScan") == 1
