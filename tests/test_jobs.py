"""The job from landed files to gold, named tables, and what must not be lost."""

import json
import os

import pytest
from pyspark.sql import functions as F

from staywise.operators import enrich, gold
from staywise.plans import medallion as M
from staywise.plans import testdata as td
from staywise.sources import files, tables
from staywise.sources.schemas import WEATHER_TABLE_SCHEMA
from staywise.streaming import events as ev

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Landed files made of the given tables."""
    base = tmp_path_factory.mktemp("landing")
    batch = td.bronze_batch(spark, SF)
    quoted = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    batch.drop("ingestion_time", "source_file").write.options(**quoted).csv(f"{base}/batch")
    td.bronze_stream(spark, SF).write.json(f"{base}/stream")
    latest = td.weather_payloads(spark, SF).groupBy("city").agg(
        F.first("geocode_json").alias("g"), F.max("weather_json").alias("w"))
    for folder in ("geocode", "forecast", "rates"):
        os.makedirs(f"{base}/{folder}")
    for r in latest.collect():
        open(f"{base}/geocode/{r.city}.json", "w").write(r.g)
        open(f"{base}/forecast/{r.city}.json", "w").write(r.w)
    rates = {"base_code": "EUR", "time_last_update_utc": "Mon, 01 Jan 2024 00:00:01 +0000",
             "rates": {"USD": 1.25, "GBP": 0.5, "XXX": 9.0}}
    open(f"{base}/rates/latest.json", "w").write(json.dumps(rates))
    return str(base)


def test_two_passes_by_name(spark, landing, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS jobs_test LOCATION '" + str(tmp_path / "db") + "'")
    sources = (f"{landing}/batch", f"{landing}/stream")
    first = M.run_job(spark, str(tmp_path / "out"), *sources, database="jobs_test")
    n = first["silver_bookings"].count()
    assert n > 0 and first["silver_bookings"].where("temperature_c IS NOT NULL").isEmpty()
    assert first["city_requests"].count() > 0
    M.run_job(spark, str(tmp_path / "out"), *sources, weather=(f"{landing}/geocode", f"{landing}/forecast"),
              rates=f"{landing}/rates", database="jobs_test")
    silver = tables.read_table(spark, "jobs_test.silver_bookings")
    assert silver.count() == n and not silver.where("temperature_c IS NOT NULL").isEmpty()
    usd = silver.where("currency = 'USD'").select("exchange_rate_to_eur").distinct().collect()
    assert [r[0] for r in usd] == [1.25]
    fact = tables.read_table(spark, "jobs_test.gold_fact_bookings")
    kpi = tables.read_table(spark, "jobs_test.gold_kpi_revenue")
    assert kpi.agg(F.sum("total_bookings")).first()[0] == fact.count()
    city = tables.read_table(spark, "jobs_test.gold_dim_city")
    assert city.select("city_key").distinct().count() == city.count()
    inferred = dict(files.ingest_csv(spark, sources[0]).dtypes)
    assert inferred["ingestion_time"] == "timestamp" and inferred["longitude"] != "string"


def test_failed_write_keeps_the_named_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), path, "kept_table")
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_table(bad, path, "kept_table")
    assert tables.read_table(spark, "kept_table").count() == 3
    tables.overwrite_table(spark.range(5).withColumn("y", F.lit(1)), path, "kept_table")
    assert tables.read_table(spark, "kept_table").columns == ["id", "y"]
    spark.sql("DROP TABLE kept_table")


def test_only_a_missing_lookup_is_empty(spark, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "none"), WEATHER_TABLE_SCHEMA).count() == 0
    assert tables.read_or_empty(spark, "no_such_table", WEATHER_TABLE_SCHEMA).count() == 0
    os.makedirs(tmp_path / "bad")
    open(tmp_path / "bad" / "part-0.parquet", "w").write("this is no parquet file")
    with pytest.raises(Exception):  # noqa: B017 - which error depends on the reader
        tables.read_or_empty(spark, str(tmp_path / "bad"), WEATHER_TABLE_SCHEMA).count()


def test_new_checkpoint_adds_slices(spark, tmp_path):
    records = ev.event_records(td.bronze_stream(spark, SF)).limit(20)
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    for k, part in enumerate((records.where("customer_id % 2 = 0"), records.where("customer_id % 2 = 1"))):
        landed = ev.land_events_json(part, str(tmp_path / f"landing{k}"))
        ev.run_available(spark, landed, raw, typed, str(tmp_path / f"ck{k}"))
        ev.run_available(spark, landed, raw, typed, str(tmp_path / f"ck{k}"))
    assert spark.read.parquet(raw).count() == spark.read.parquet(typed).count() == 20
    run = spark.read.parquet(raw).select("run_id").first()[0]
    kept = ev.compact(spark, raw, run, 100, str(tmp_path / "one"))
    assert kept.count() == spark.read.parquet(raw).where(F.col("run_id") == run).count()


def test_unread_files_are_listed(spark, tmp_path):
    open(tmp_path / "a b.csv", "w").write("city\nrome\n")
    open(tmp_path / "bad.csv.gz", "w").write("this is no gzip file")
    got = files.unread_files(spark, str(tmp_path / "*.csv*")).collect()
    assert [(os.path.basename(r.file), r.n_bytes) for r in got] == [("bad.csv.gz", 20)]
    assert [r.city for r in files.multi_file_scan(spark, str(tmp_path / "*.csv*")).collect()] == ["rome"]


def test_skip_counts_cover_missing_readings(spark):
    hit = json.dumps({"results": [{"latitude": 1.0, "longitude": 2.0, "country": "X"}]})
    full = json.dumps({"current": {"temperature_2m": 1.0, "relative_humidity_2m": 2, "weather_code": 3, "time": "t"}})
    rows = [("a", hit, full), ("b", hit, "{}"), ("c", "{}", full)]
    p = spark.createDataFrame(rows, "city string, geocode_json string, weather_json string")
    assert tuple(files.weather_skip_counts(p).first()) == (3, 1, 1)
    assert files.flatten_weather(p).count() == 1


def test_zero_rate_divides_to_null(spark):
    silver = spark.createDataFrame([(1, 10.0, 0.0)], "booking_id int, total_amount double, exchange_rate_to_eur double")
    for c, t in (("hotel_id", "int"), ("nights", "int"), ("star_rating", "int")):
        silver = silver.withColumn(c, F.lit(1).cast(t))
    for c in ("customer_id", "city_clean", "country", "hotel_name", "hotel_type", "room_type", "adults", "children",
              "booking_status", "source_system", "currency", "room_price", "temperature_c", "weather_code"):
        silver = silver.withColumn(c, F.lit(None).cast("string"))
    silver = silver.withColumn("booking_date", F.to_date(F.lit("2024-01-01")))
    assert gold.fact_bookings(silver, rate_direction="divide").first().total_amount_eur is None


def test_every_bronze_city_is_requested(spark):
    bronze = spark.range(1200).selectExpr("concat('city ', id) AS city")
    none = bronze.where("false").withColumn("city_clean", F.col("city"))
    assert enrich.city_sources(none, bronze).count() == 1200


def test_exact_totals_whatever_the_partitions(spark):
    from staywise.operators.report import default_summarize, report_cards
    df = spark.range(50_000).selectExpr("id AS booking_id", "cast(id % 997 as double) / 100 AS total_amount_eur",
                                        "cast(id % 13 as double) / 7 AS avg_nightly_rate_eur")
    for f in (report_cards, lambda d: default_summarize(d, ["total_amount_eur", "avg_nightly_rate_eur"])):
        assert {tuple(f(df.repartition(k)).first()) for k in (1, 8, 200)} == {tuple(f(df).first())}


def test_managed_tables_and_views_are_refused(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("managed_kept")
    spark.range(2).createOrReplaceTempView("view_kept")
    for name in ("managed_kept", "view_kept"):
        with pytest.raises(ValueError, match="only external"):
            tables.overwrite_table(spark.range(1), "/nowhere", name)
    assert spark.table("managed_kept").count() == 4 and spark.table("view_kept").count() == 2
    spark.sql("DROP TABLE managed_kept")


def test_failed_write_keeps_the_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_table(spark.range(3).select(F.raise_error(F.lit("broken")).alias("x")), path)
    assert spark.read.parquet(path).count() == 3
    new = tables.overwrite_table(spark.range(5).withColumn("y", F.col("id") % 2), path, partition_by=("y",))
    assert new.count() == 5 and sorted(new.columns) == ["id", "y"]
    same = tables.overwrite_table(spark.read.parquet(path).where("id > 1"), path)   # a table may read its old self
    assert same.count() == 3 and [f for f in os.listdir(tmp_path) if ".old-" in f] == []


def test_bronze_keeps_text_as_landed(spark, tmp_path):
    os.makedirs(tmp_path / "csv")
    open(tmp_path / "csv" / "a.csv", "w").write("hotel_id,phone\n00123,05551234567\n00007,+4917012345\n")
    rows = files.ingest_csv(spark, str(tmp_path / "csv"), infer=False).orderBy("hotel_id").collect()
    assert [(r.hotel_id, r.phone) for r in rows] == [("00007", "+4917012345"), ("00123", "05551234567")]
    out = lambda n: {"path": str(tmp_path / "out" / n)}
    os.makedirs(tmp_path / "json")
    b = M.bronze_from_landing(spark, out, str(tmp_path / "csv"), str(tmp_path / "json"))
    assert sorted(r.hotel_id for r in b.batch.collect()) == ["00007", "00123"]


def test_lines_that_are_no_objects_are_rescued(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    good = '{"booking_id": "1", "customer_id": 5, "total_amount": 2.5}'
    typed = '{"booking_id": "2", "customer_id": "x", "total_amount": 3.5}'
    bad = ['{"booking_id": "3", "custo', "[1, 2]", "plain text", '"quoted"', "17"]
    open(tmp_path / "in" / "a.json", "w").write("\n".join([good, bad[0], typed, "", *bad[1:3]]) + "\n")
    sinks = [str(tmp_path / n) for n in ("raw", "typed", "bad")]
    run = lambda: ev.run_available(spark, str(tmp_path / "in"), *sinks[:2], str(tmp_path / "ck"), bad_path=sinks[2])
    run()
    open(tmp_path / "in" / "b.json", "w").write("\n".join(bad[3:]) + "\n")
    run()   # goes on from the checkpoint
    raw, real, rescued = (spark.read.parquet(p) for p in sinks)
    assert sorted((r.booking_id, r.customer_id, r.total_amount) for r in raw.collect()) == [("1", 5, 2.5), ("2", None, 3.5)]
    assert real.count() == 2 and "rescued" not in raw.columns
    got = {r.rescued: os.path.basename(r.landed_file) for r in rescued.collect()}
    assert got == {b: "a.json" if b in bad[:3] else "b.json" for b in bad}


def scratch_folders(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir")))


def test_scratch_block_leaves_what_is_kept(spark):
    before = scratch_folders(spark)
    with tables.scratch(spark):
        with tables.scratch(spark) as keep:
            rows = tables.materialize(spark.range(10), "inner")
            kept = keep(rows.where("id > 3"), "kept")
            assert len(scratch_folders(spark) - before) == 2
        assert kept.count() == 6 and len(scratch_folders(spark) - before) == 1
    assert scratch_folders(spark) == before
    with tables.scratch(spark) as keep:
        kept = keep(tables.materialize(spark.range(3), "inner"), "kept")
    assert kept.count() == 3
    tables.discard(kept, spark.range(1))
    assert scratch_folders(spark) == before


def test_scratch_goes_after_an_error(spark):
    before = scratch_folders(spark)
    with pytest.raises(ZeroDivisionError), tables.scratch(spark):
        tables.materialize(spark.range(3), "lost")
        1 / 0  # noqa: B018
    assert scratch_folders(spark) == before


def test_job_leaves_its_tables_only(spark, landing, tmp_path):
    before = scratch_folders(spark)
    out = M.run_job(spark, str(tmp_path / "out"), f"{landing}/batch", f"{landing}/stream")
    assert scratch_folders(spark) == before
    assert all(df.count() for n, df in out.items() if n != "silver_city_dim")
    assert M.run_layers(spark, SF, str(tmp_path / "layers"))["silver_bookings"] > 0
    assert scratch_folders(spark) == before


def test_old_versions_go(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_test LOCATION '" + str(tmp_path / "db") + "'")
    place, name = str(tmp_path / "t"), "versions_test.t"
    for n in (1, 2, 3):
        tables.overwrite_table(spark.range(n), place, name)
    assert len(tables.remove_versions(spark, place, name)) == 2
    assert spark.read.table(name).count() == 3
    assert tables.remove_versions(spark, place, name) == []
