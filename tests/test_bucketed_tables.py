"""Tables bucketed for joins without a shuffle."""

import pytest
from pyspark.sql import functions as F

from staywise.operators import gold
from staywise.sources.tables import write_bucketed


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_between_bucketed_tables(spark, tmp_path, no_broadcast):
    fact = spark.range(3000).select(F.col("id").cast("string").alias("booking_id"),
                                    F.when(F.col("id") % 3 != 0, (F.col("id") % 40).cast("string")).otherwise("7").alias("hotel_id"))
    hotels = spark.range(30).selectExpr("cast(id AS string) AS hotel_id", "'Premium' AS hotel_tier", "'h' || id AS hotel_name")
    assert "Exchange" in plan(gold.hotel_join(fact, hotels))
    f = write_bucketed(fact, str(tmp_path / "f"), "t_bucketed_fact", "hotel_id", 4)
    h = write_bucketed(hotels, str(tmp_path / "h"), "t_bucketed_hotels", "hotel_id", 4)
    joined = gold.hotel_join(f, h)
    assert "Exchange" not in plan(joined) and "Exchange" not in plan(f.groupBy("hotel_id").count())
    assert sorted(joined.collect()) == sorted(gold.hotel_join(fact, hotels).collect())
    assert f.select(F.col("_metadata.file_path")).distinct().count() <= 4


def test_replaced_by_name_and_managed_tables_refused(spark, tmp_path):
    df = spark.range(10)
    write_bucketed(df, str(tmp_path / "t"), "t_bucketed", "id", 2)
    assert write_bucketed(df.limit(3), str(tmp_path / "t"), "t_bucketed", "id", 3).count() == 3
    spark.createDataFrame([(1,)], "id long").createOrReplaceTempView("t_bucketed_view")
    with pytest.raises(ValueError, match="only external"):
        write_bucketed(df, str(tmp_path / "v"), "t_bucketed_view", "id", 2)
