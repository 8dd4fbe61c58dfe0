"""The state of a running stream against the landed table."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from staywise.plans import testdata as td
from staywise.streaming import events as ev
from staywise.streaming import validation as val

SF = "/root/testdata/sf0.001"


def brute(rows, n):
    """Latest records of (event_time, texts) rows in plain Python."""
    def key(r):
        t = None if r[0] is None else r[0].timestamp()
        return (t is None, -(t or 0), *[(v is not None, v or "") for v in r[1:]])
    return sorted(rows, key=key)[:n]


def taken(df):
    return [(r.event_time, *[r[c] for c in val.TEXTS]) for r in df.collect()]


def test_state_after_every_batch_and_a_restart(spark, tmp_path):
    landing, states, ck = (str(tmp_path / n) for n in ("landing", "states", "ck"))
    source = (td.bronze_stream(spark, SF).limit(600)
              .withColumn("event_time", F.when(F.crc32("booking_id") % 9 == 0, "no time").otherwise(F.col("event_time")))
              .withColumn("hotel_id", F.when(F.crc32("booking_id") % 5 > 0, F.col("hotel_id"))).cache())
    first = source.where(F.crc32("booking_id") % 2 == 0)
    # two landings; the second one is taken in by a query restarted from the checkpoint
    n = 0
    for part in (first, source.exceptAll(first)):
        part.repartition(3).write.mode("append").json(landing)
        val.run_watch(ev.stream_events(spark, landing, source.schema, max_files=2), states, ck, latest=7, shards=2)
        n += part.count()
        assert val.seen_count(spark, states).first()[0] == n
    batches = {r[0] for r in spark.read.parquet(states).select("batch_id").distinct().collect()}
    assert len(batches) >= 4
    # the file source's log says which files each batch read
    log = (spark.read.text(f"{ck}/sources/0").where("value LIKE '{%'")
           .select(F.get_json_object("value", "$.path").alias("path"),
                   F.get_json_object("value", "$.batchId").cast("int").alias("b")).distinct().collect())
    for b in sorted(batches):
        rows = (spark.read.schema(source.schema).json([r.path for r in log if r.b <= b])
                .select(F.try_to_timestamp("event_time"), *val.TEXTS).collect())
        assert val.seen_count(spark, states, b).first()[0] == len(rows)
        assert taken(val.seen_latest(spark, states, 7, b)) == brute([tuple(r) for r in rows], 7)
    # nothing new: nothing changes
    val.run_watch(ev.stream_events(spark, landing, source.schema), states, ck, latest=7, shards=2)
    assert val.seen_count(spark, states).first()[0] == n


@pytest.mark.parametrize("n", [1, 3, 50])
def test_latest_of_orders_missing_values(n):
    rows = [(5, "b", None, "x", "y", "z"), (5, "b", "", "x", "y", "z"), (val.NO_TIME, None, "h", "x", "y", "z"),
            (9, None, "h", None, "y", "z"), (9, "a", "h", "x", "y", None), (9, "a", "h", "x", "y", None), (-3, "é", "h", "x", "y", "z")]
    got = val.latest_of(pd.DataFrame(rows, columns=val.COLUMNS), n)
    want = sorted(rows, key=lambda r: (-r[0], *[(v is not None, v or "") for v in r[1:]]))[:n]
    assert [tuple(None if v is None or v != v else v for v in r) for r in got.itertuples(index=False)] == want
