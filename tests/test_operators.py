"""Operators on small literal frames: NULL, blank, duplicate and tie rows."""

import os

import pytest
from pyspark.sql import functions as F

from staywise.operators import clean, columns, dedup, enrich, quality
from staywise.operators.split import positional_split


def test_union_by_name_aligns_types(spark):
    a = spark.createDataFrame([(1, 2.5)], "booking_id bigint, total_price double")
    b = spark.createDataFrame([("x-1", "abc")], "booking_id string, total_amount string")
    u = columns.union_by_name(a, b)
    assert dict(u.dtypes) == {"booking_id": "string", "total_price": "string", "total_amount": "string"}
    assert u.count() == 2


def test_standardize_and_dedup_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF(" Booking ID ", "x", "booking_id")
    s = columns.standardize_names(df)
    assert s.columns == ["booking_id", "x", "booking_id"]
    d = columns.dedup_column_names(s)
    assert d.columns == ["booking_id", "x"] and d.first()["booking_id"] == 1


def test_reconcile_policies(spark):
    df = spark.createDataFrame([(None, 5.0), (7.0, 8.0)], "total_amount double, total_price double")
    drop = columns.reconcile_columns(df, policy="drop")
    assert drop.columns == ["total_amount"] and [r[0] for r in drop.collect()] == [None, 7.0]
    co = columns.reconcile_columns(df, policy="coalesce")
    assert [r[0] for r in co.collect()] == [5.0, 7.0]
    ren = columns.reconcile_columns(df.drop("total_amount"), policy="drop")
    assert ren.columns == ["total_amount"]


def test_hotel_lookup_fill(spark):
    batch = spark.createDataFrame([("b1", "HTL-7", "Grand", "berlin"), ("b0", "HTL-7", "Old", "paris"),
                                   ("b2", "HTL-9", "Sea", "nice")],
                                  "booking_id string, hotel_id string, hotel_name string, city string")
    stream = spark.createDataFrame([("s1", "7", None, ""), ("s2", "9", "Unknown", "x"), ("s3", None, None, None)],
                                   "booking_id string, hotel_id string, hotel_name string, city string")
    out = {r.booking_id: (r.hotel_name, r.city) for r in columns.hotel_lookup_fill(stream, batch).collect()}
    # smallest booking_id wins in the dimension; only NULL/blank/Unknown are replaced
    assert out == {"s1": ("Old", "paris"), "s2": ("Sea", "x"), "s3": (None, None)}


def test_dedup_latest_total_order(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 2, "z"), ("k", 2, "a"), (None, 1, "n1"), (None, 3, "n2")],
                               "key string, ts int, tie string")
    out = {r.key: r.tie for r in dedup.dedup_latest(df, ["key"], ["ts"], ["tie"]).collect()}
    assert out == {None: "n2", "k": "a"}


def test_surrogate_key_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).cast("string").alias("city"))
    keyed = dedup.surrogate_key(df, ["city"], "city_key", partitions=5).collect()
    got = sorted((r.city, r.city_key) for r in keyed)
    assert [k for _, k in got] == list(range(1, 1001))


def test_surrogate_key_many_wide_rows(spark):
    df = spark.range(100_000).selectExpr("concat('city ', id % 100000) AS city", "id AS a", "repeat('x', 50) AS b")
    keyed = dedup.surrogate_key(df, ["city"], "city_key", partitions=7)
    got = keyed.selectExpr("count(*) n", "count(DISTINCT city_key) d", "min(city_key) lo", "max(city_key) hi").first()
    assert tuple(got) == (100_000, 100_000, 1, 100_000)
    assert keyed.selectExpr("city_key - row_number() OVER (ORDER BY city) AS off").filter("off <> 0").isEmpty()


def test_positional_split(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    for few in (10_000, 5):
        out = positional_split(df, ["k"], 0.7, pivots=3, few=few)
        parts = {r.k: r.part for r in out.collect()}
        assert sum(1 for v in parts.values() if v == "batch") == 70
        assert all(parts[k] == "batch" for k in range(70)) and parts[70] == "stream"


@pytest.mark.parametrize("pivots,few", [(63, 10_000), (4, 7)])
def test_positional_split_of_equal_values(spark, pivots, few):
    """Repeated order values, NULLs, and rows equal in every column."""
    import random
    rnd = random.Random(few)
    data = [(rnd.choice([None, 1, 2, 2, 3]), rnd.choice("ab"), i) for i in range(150)] + [(2, "b", 7)] * 120
    df = spark.createDataFrame(data, "k int, s string, i int").repartition(5)
    for fraction in (0.0, 0.55, 0.7):
        out = positional_split(df, ["k", "s"], fraction, pivots=pivots, few=few)
        got = [tuple(r) for r in out.collect()]
        assert out.columns == ["k", "s", "i", "part"]
        assert sorted(map(str, (r[:3] for r in got))) == sorted(map(str, data))
        order = lambda r: (r[0] is not None, r[0] or 0, r[1])
        batch, rest = ([order(r) for r in got if r[3] == p] for p in ("batch", "stream"))
        assert len(batch) == int(len(data) * fraction) and (not batch or not rest or max(batch) <= min(rest))
        again = [tuple(r) for r in positional_split(df.repartition(3), ["k", "s"], fraction).collect()]
        assert sorted(map(str, again)) == sorted(map(str, got))
    plan = out._jdf.queryExecution().toString()
    assert "Exchange rangepartitioning" not in plan


def test_classify_parity_vs_default(spark):
    df = spark.createDataFrame([("1", "HTL-1", "near", 1.0)],
                               "booking_id string, hotel_id string, nearby_attractions string, temperature_c double")
    p = clean.classify_columns(df, parity=True)
    d = clean.classify_columns(df, parity=False)
    assert "hotel_id" in p.phones and "nearby_attractions" in p.dates and "temperature_c" in p.strings
    assert "hotel_id" in d.untouched and "nearby_attractions" in d.strings and "temperature_c" in d.untouched


def test_drop_constant_time_cols(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-01 10:00:00"), ("x", "2024-01-02")], "a string, b string")
    out = clean.split_datetime(df, ["a", "b"])
    kept = clean.drop_constant_time_cols(out, ["a_time", "b_time"])
    assert "a_time" not in kept.columns and "b_time" in kept.columns
    assert out.where(F.col("a") == F.to_date(F.lit("1900-01-01"))).count() == 1   # sentinel


def test_dq_suite(spark):
    df = spark.createDataFrame([("a", "c", "h", "2024-01-01", -1.0, 1.0, "EUR"),
                                ("a", None, "h", "2024-01-01", 2.0, None, "XXX"),
                                (None, "c", "h", "2024-01-01", 3.0, 1.0, None)],
                               "booking_id string, customer_id string, hotel_id string, booking_date string, "
                               "total_amount double, room_price double, currency string")
    res = {(r.check, r.column): (r.failing, r.success) for r in quality.dq_suite(df).collect()}
    assert res[("not_null", "booking_id")] == (1, False)
    assert res[("unique", "booking_id")] == (2, False)
    assert res[("between[0,None]", "total_amount")] == (1, False)
    assert res[("between[0,None]", "room_price")] == (0, True)
    assert res[("in_set", "currency")] == (1, False)
    assert res[("of_type[DoubleType]", "total_amount")] == (0, True)
    rep = quality.dq_report(quality.dq_suite(df)).first()
    assert rep.total == 11 and rep.passed + rep.failed == 11


def test_city_sources_fallback(spark):
    empty = spark.createDataFrame([], "city_clean string")
    bronze = spark.createDataFrame([(" Rome ",), ("Oslo",), (None,)], "city string")
    got = sorted(r.city for r in enrich.city_sources(empty, bronze).collect())
    assert got == ["Oslo", "Rome"]
    got = sorted(r.city for r in enrich.city_sources(empty, bronze.where("false")).collect())
    assert got == sorted(["Amsterdam", "Berlin", "Paris", "London", "Istanbul"])


def test_rates_and_weather_payloads(spark):
    from staywise.sources.files import explode_rates, flatten_weather
    p = spark.createDataFrame([('{"base_code":"EUR","time_last_update_utc":"Mon, 01 Jan 2024 00:00:01 +0000",'
                                '"rates":{"USD":1.1,"CHF":0.9,"TRY":34.5}}',),
                               ('{"rates":{"GBP":0.8},"time_last_update_utc":"2024-02-01T10:00:00"}',)], "payload string")
    got = sorted((r.base_currency, r.target_currency, r.rate, str(r.timestamp)) for r in explode_rates(p).collect())
    assert got == [("EUR", "GBP", 0.8, "2024-02-01 10:00:00"), ("EUR", "TRY", 34.5, "2024-01-01 00:00:01"),
                   ("EUR", "USD", 1.1, "2024-01-01 00:00:01")]
    w = spark.createDataFrame([(" berlin", '{"results":[{"latitude":52.5,"longitude":13.4,"country":"Germany"}]}',
                                '{"current":{"temperature_2m":-5.0,"relative_humidity_2m":80,"weather_code":3,'
                                '"time":"2024-01-01T10:00"}}'),
                               ("atlantis", '{}', '{"current":{"temperature_2m":1.0}}')],
                              "city string, geocode_json string, weather_json string")
    rows = flatten_weather(w).collect()
    assert len(rows) == 1 and rows[0].city == "Berlin" and rows[0].temperature_c == -5.0


def test_stream_fanout_idempotent(spark, tmp_path):
    from staywise.streaming import events as ev
    recs = spark.createDataFrame([("b1", 1, "7", "2024-01-01 10:00:00", "Single", 10.0, "EUR", "Web",
                                   "2024-01-01 10:00:00"),
                                  ("b2", 2, "x", "bad", "Suite", 20.0, "USD", "Web", "2024-01-01 11:00:00")],
                                 ev.S.EVENT_SCHEMA)
    landing = str(tmp_path / "landing")
    ev.land_events_json(recs, landing)
    raw, typed, ck = str(tmp_path / "raw"), str(tmp_path / "typed"), str(tmp_path / "ck")
    ev.run_available(spark, landing, raw, typed, ck, max_files=1)
    ev.run_available(spark, landing, raw, typed, ck, max_files=1)   # restart: nothing re-read
    assert spark.read.parquet(raw).count() == 2
    t = {r.booking_id: r for r in spark.read.parquet(typed).collect()}
    assert t["b2"].hotel_id is None and t["b2"].booking_date is None and t["b1"].hotel_id == 7
    assert os.path.isdir(ck)


def test_layers_written_and_consistent(spark, tmp_path):
    from staywise.plans.medallion import run_layers
    counts = run_layers(spark, "/root/testdata/sf0.001", str(tmp_path / "lake"))
    assert counts["silver_bookings"] > 0 and counts["gold_fact_bookings"] > 0
    kpi = spark.read.parquet(str(tmp_path / "lake" / "gold_kpi_revenue"))
    fact = spark.read.parquet(str(tmp_path / "lake" / "gold_fact_bookings"))
    # KPI groups partition the fact table: counts add up
    assert kpi.agg(F.sum("total_bookings")).first()[0] == fact.count()
    assert "booking_year" in fact.columns   # partition column of the fact layout


def test_parity_silver_reproduces_quirks(spark):
    """parity=True: ids through the phone rule (short -> Unknown), the rate
    zero-filled (never NULL), amounts reconciled by dropping total_price."""
    from staywise.plans import medallion as M
    b = M.bronze_from_testdata(spark, "/root/testdata/sf0.001")
    par = M.silver_bookings(b, parity=True, drop_midnight=False)
    fixed = M.silver_bookings(b, parity=False, drop_midnight=False)
    assert par.where(F.col("hotel_id") == "Unknown").count() > 0
    assert fixed.where(F.col("hotel_id") == "Unknown").count() == 0
    assert par.where(F.col("exchange_rate_to_eur").isNull()).count() == 0
    assert dict(par.dtypes)["temperature_c"] == "string"
    assert dict(fixed.dtypes)["temperature_c"] == "double"
    # the drop policy loses the batch amounts that coalesce keeps
    zero_par = par.where(F.col("total_amount") == 0).count()
    zero_fixed = fixed.where(F.col("total_amount") == 0).count()
    assert zero_par > zero_fixed


def test_overwrite_if_nonempty_and_inventory(spark, tmp_path):
    from staywise.sources.tables import overwrite_if_nonempty, overwrite_table, table_inventory
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3), path)
    assert overwrite_if_nonempty(spark.range(0), path) is False
    assert spark.read.parquet(path).count() == 3          # old table kept
    assert overwrite_if_nonempty(spark.range(5).withColumnRenamed("id", "x"), path) is True
    assert spark.read.parquet(path).columns == ["x"]       # data and schema replaced
    spark.range(4).createOrReplaceTempView("inv_present")
    rows = {r.table_name: (r.row_count, r.status)
            for r in table_inventory(spark, ["inv_present", "inv_absent"]).collect()}
    assert rows == {"inv_present": (4, "ok"), "inv_absent": (None, "not found")}


def test_kpi_groups_sum_to_fact(spark):
    """Property: KPI groups partition the fact table (counts and revenue)."""
    import __spark_entry__ as E
    q = E.queries()
    fact = q["fact_bookings"](spark, "/root/testdata/sf0.001")
    kpi = q["kpi_revenue"](spark, "/root/testdata/sf0.001")
    assert kpi.agg(F.sum("total_bookings")).first()[0] == fact.count()
    a = kpi.agg(F.sum("total_revenue_eur")).first()[0]
    b = fact.agg(F.sum("total_amount_eur")).first()[0]
    assert abs(a - b) < 0.01 * len(kpi.collect()) + 1e-6
    # dedup leaves unique keys; the left joins keep the fact row count
    assert fact.select("booking_id").distinct().count() == fact.count()
    assert q["star_join"](spark, "/root/testdata/sf0.001").count() == fact.count()


def test_multi_file_scan_skips_corrupt_files(spark, tmp_path):
    from staywise.sources.files import multi_file_scan
    d = tmp_path / "cities"
    d.mkdir()
    (d / "a.csv").write_text("city,country\nBerlin,DE\nParis,FR\n")
    (d / "b.csv").write_text("city,country\nRome,IT\n")
    (d / "c.csv.gz").write_bytes(b"not gzip at all")          # unreadable file
    got = sorted(r.city for r in multi_file_scan(spark, [str(d / "*.csv*")]).collect())
    assert got == ["Berlin", "Paris", "Rome"]


def test_weather_skip_counts(spark):
    from staywise.sources.files import weather_skip_counts
    p = spark.createDataFrame([('{"results":[{"latitude":1.0,"longitude":2.0,"country":"X"}]}',), ('{}',),
                               ('{"results":[]}',)], "geocode_json string")
    r = weather_skip_counts(p).first()
    assert (r.cities, r.not_found) == (3, 2)


def test_empty_lookup_first_run(spark, tmp_path):
    """First run: lookups absent -> empty typed tables, enrichment leaves NULLs."""
    from staywise.sources.schemas import RATES_TABLE_SCHEMA, WEATHER_TABLE_SCHEMA
    from staywise.sources.tables import read_or_empty
    w = read_or_empty(spark, str(tmp_path / "none_w"), WEATHER_TABLE_SCHEMA)
    r = read_or_empty(spark, str(tmp_path / "none_r"), RATES_TABLE_SCHEMA)
    df = spark.createDataFrame([("b1", "Berlin", "USD"), ("b2", "Rome", "EUR")],
                               "booking_id string, city_clean string, currency string")
    out = {x.booking_id: x for x in enrich.enrich_weather_rates(df, enrich.latest_weather(w),
                                                                 enrich.latest_rates(r)).collect()}
    assert out["b1"].temperature_c is None and out["b1"].exchange_rate_to_eur is None
    assert out["b2"].exchange_rate_to_eur == 1.0


def test_stream_processing_time_trigger(spark, tmp_path):
    """The production form: processing-time trigger with a byte cap per batch."""
    from staywise.streaming import events as ev
    recs = spark.createDataFrame([(f"b{i}", i, str(i), "2024-01-01 10:00:00", "Single", 1.0 * i, "EUR", "Web",
                                   "2024-01-01 10:00:00") for i in range(20)], ev.S.EVENT_SCHEMA)
    landing = str(tmp_path / "landing")
    ev.land_events_json(recs.repartition(4), landing)
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    sdf = ev.stream_events(spark, landing, max_bytes=1024)
    q = ev.stream_fanout(sdf, raw, typed, str(tmp_path / "ck"), trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(raw).count() == 20
    assert spark.read.parquet(typed).where("hotel_id IS NOT NULL").count() == 20
