"""Landings that change only the buckets they touch."""

import os

import pytest
from pyspark.sql import functions as F

from staywise.operators import gold
from staywise.plans import incremental as I
from staywise.plans import medallion as M
from staywise.sources import bucketed
from staywise.sources.tables import materialize

SF = "/root/testdata/sf0.001"


def files(spark, path):
    """The files of each bucket."""
    out = {}
    for r in spark.read.parquet(path).select("bucket", F.col("_metadata.file_path").alias("f")).distinct().collect():
        out.setdefault(r.bucket, set()).add(r.f)
    return out


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_merge_latest_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(200).selectExpr("id", "1 AS at", "'old' AS v")
    bucketed.merge_latest(first, path, ["id"], ["at"], ["v"], buckets=16)
    before = files(spark, path)
    second = spark.createDataFrame([(3, 2, "new"), (900, 2, "new"), (4, 0, "late")], "id long, at int, v string")
    touched = bucketed.merge_latest(second, path, ["id"], ["at"], ["v"], buckets=99)   # the layout stays at 16
    after = files(spark, path)
    assert 1 <= len(touched) <= 3 and {b for b in before if before[b] != after[b]} == set(touched)
    got = {r.id: r.v for r in bucketed.read_buckets(spark, path, first.schema).collect()}
    assert len(got) == 201 and got[3] == got[900] == "new" and got[4] == "old"
    assert bucketed.merge_latest(second, path, ["id"], ["at"], ["v"]) == touched   # run again: the same rows
    assert bucketed.read_buckets(spark, path, first.schema).count() == 201
    assert bucketed.merge_latest(second.limit(0), path, ["id"], ["at"]) == []


def test_a_bucket_without_rows_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("bucket", (F.col("id") % 2).cast("int"))
    bucketed.replace_buckets(df, path, [0, 1])
    bucketed.replace_buckets(materialize(df.where("bucket = 1"), "one"), path, [0, 1])
    assert [r[0] for r in spark.read.parquet(path).select("bucket").distinct().collect()] == [1]


def test_a_merge_reads_its_own_table_without_a_scratch_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    kept = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(kept))
    for at in (1, 2):
        bucketed.merge_latest(spark.range(100).selectExpr(f"id * {at} AS id", f"{at} AS at"), path, ["id"], ["at"])
    assert set(os.listdir(kept)) == before
    got = {r.id: r["at"] for r in spark.read.parquet(path).collect()}
    assert got == {i: 1 for i in range(1, 100, 2)} | {i: 2 for i in range(0, 200, 2)}


def test_rows_without_keys_and_repeated_keys_stay_one_each(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in ("a", "b"):
        bucketed.merge_latest(spark.sql(f"SELECT * FROM VALUES (NULL, 1, '{v}'), ('x', 1, '{v}') t(id, at, v)"),
                              path, ["id"], ["at"], ["v"])
    assert sorted((str(r.id), r.v) for r in spark.read.parquet(path).collect()) == [("None", "a"), ("x", "a")]


@pytest.fixture(scope="module")
def bronze(spark):
    b = M.bronze_from_testdata(spark, SF)
    return M.Bronze(*[materialize(x, "bronze") for x in (b.batch, b.stream, b.weather, b.rates)])


def check_kpi(spark, state, silver):
    """The KPI of the stored partials, in both forms, is that of all bookings."""
    fact = gold.fact_bookings(silver)
    assert rows(I.kpi(spark, state)) == rows(gold.kpi_groups(fact))
    assert rows(I.kpi(spark, state, cancelled=("Canceled",), channels=True)) == rows(gold.kpi_channel_groups(fact))


def test_landings_equal_the_full_run(spark, bronze, tmp_path):
    state, found = str(tmp_path), M.lookups(bronze)
    number = F.col("booking_id").cast("long")
    few = number.isin(*[r[0] for r in bronze.batch.select(number).orderBy(number).limit(3).collect()])
    part = lambda c, s: M.Bronze(bronze.batch.where(c), bronze.stream.where(s), bronze.weather, bronze.rates)
    I.land(spark, state, part(~few, F.lit(True)), found)
    before = files(spark, f"{state}/silver")
    landed = I.land(spark, state, part(few, F.lit(False)), found)
    after = files(spark, f"{state}/silver")
    assert 1 <= len(landed.compared) <= 3 and set(landed.compared) <= set(landed.replaced)
    assert {b for b in {*before, *after} if before.get(b) != after.get(b)} <= set(landed.replaced)
    whole = materialize(M.silver_bookings(bronze), "whole")
    assert rows(I.silver(spark, state)) == rows(whole)
    check_kpi(spark, state, whole)
    again = I.land(spark, state, part(few, F.lit(False)), found)   # a landing lost half-way is run again
    assert again.compared == landed.compared and rows(I.silver(spark, state)) == rows(whole)


def test_a_new_hotel_attribute_reaches_older_bookings(spark, bronze, tmp_path):
    """Stream bookings land before the batch that knows their hotels."""
    state, found = str(tmp_path), M.lookups(bronze)
    none = F.lit(False)
    I.land(spark, state, M.Bronze(bronze.batch.where(none), bronze.stream, bronze.weather, bronze.rates), found)
    I.land(spark, state, M.Bronze(bronze.batch, bronze.stream.where(none), bronze.weather, bronze.rates), found)
    whole = materialize(M.silver_bookings(bronze), "whole")
    assert rows(I.silver(spark, state)) == rows(whole)
    check_kpi(spark, state, whole)


FACT = ("city string, country string, booking_year int, booking_month int, hotel_type string, booking_channel string, "
        "booking_status string, total_amount_eur double, avg_nightly_rate_eur double, nights double, adults int, "
        "children double")


def test_partials_add_up(spark):
    """NULLs in every measure and key, averages that round, channels shared
    between parts, and a group without rows that count."""
    data = [("a", "x", 2024, 1, "h", "web", "Canceled", 10.005, 3.335, 1.0, 2, 1.0),
            ("a", "x", 2024, 1, "h", "web", "Confirmed", 0.01, None, 2.0, None, None),
            ("a", "x", 2024, 1, "h", "app", "Cancelled", None, 0.02, None, 1, None),
            ("a", "x", 2024, 1, "h", None, None, 1e9, 7.0, 4.0, 1, 2.0),
            (None, None, None, None, None, None, None, None, None, None, None, None),
            ("b", "y", 2023, 12, "h", "app", "Canceled", -5.555, 1.0, 1.0, 3, 0.0)] * 3
    fact = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], FACT + ", i int")
    parts = gold.kpi_partials(fact.where("i < 4")).unionByName(gold.kpi_partials(fact.where("i >= 4")))
    assert rows(gold.kpi_from_partials(parts)) == rows(gold.kpi_groups(fact))
    assert rows(gold.kpi_from_partials(parts, ("Canceled",), True)) == rows(gold.kpi_channel_groups(fact))


def test_kpi_before_any_landing(spark, tmp_path):
    assert I.kpi(spark, str(tmp_path)).count() == 0
