"""Validation of a running event stream: how many records came, and the latest.

A stateful operator keeps both, so that a look at a stream of any age reads a
few rows instead of the landed table.  Every task first reduces its part of a
micro-batch to its count and its latest records; only these are shuffled, to
one of SHARDS states, whatever key the records have.  A state holds a count
and at most ``latest`` records.  It lies in Spark's state store below the
query's checkpoint: a batch that is run again starts from the state before
it, so a restart neither loses nor repeats a record.

Order of "latest": event time descending (unreadable ones last), then
booking id and the other columns ascending, missing ones first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship_package
from .events import _write_slice, run_id_of

LATEST = 100
SHARDS = 16
NO_TIME = -(1 << 63)   # event time of a record without one, in microseconds
TEXTS = ["booking_id", "hotel_id", "room_type", "currency", "booking_status"]
RECORD = "micros long, " + ", ".join(f"{c} string" for c in TEXTS)
COLUMNS = ["micros", *TEXTS]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_of(records: pd.DataFrame, n: int) -> pd.DataFrame:
    """The first ``n`` records in the order above."""
    # Missing texts sort before all others, the empty one included.
    keys = pd.DataFrame({"micros": records["micros"]} | {
        c: records[c].map(lambda v: "" if v is None or v != v else " " + v) for c in TEXTS}, index=records.index)
    first = keys.sort_values(COLUMNS, ascending=[False, *[True] * len(TEXTS)], kind="stable").index[:n]
    return records.loc[first].reset_index(drop=True)


def reduced(batches: Iterator[pd.DataFrame], latest: int, shards: int) -> Iterator[pd.DataFrame]:
    """One task's part: its latest records, the number of all on the first."""
    n, held = 0, None
    for b in batches:
        n += len(b)
        held = latest_of(b if held is None else pd.concat([held, b], ignore_index=True), latest)
    if n:
        held.insert(0, "n", [n] + [0] * (len(held) - 1))
        held.insert(0, "shard", TaskContext.get().partitionId() % shards)
        yield held


class Seen(StatefulProcessor):
    """State of a shard: records so far, and the latest of them."""

    def __init__(self, latest: int):
        self.latest = latest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")
        self.records = handle.getListState("latest", RECORD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        held = pd.DataFrame(list(self.records.get()) if self.records.exists() else [], columns=COLUMNS)
        for b in rows:
            n += int(b["n"].sum())
            held = latest_of(pd.concat([held, b[COLUMNS]], ignore_index=True) if len(held) else
                             b[COLUMNS].reset_index(drop=True), self.latest)
        self.count.update((n,))
        self.records.put([(int(r[0]), *[None if v is None or v != v else v for v in r[1:]])
                          for r in held.itertuples(index=False)])
        yield held.assign(shard=key[0], n=[n] + [0] * (len(held) - 1))[["shard", "n", *COLUMNS]]

    def close(self) -> None:
        pass


def watched(events: DataFrame, latest: int = LATEST, shards: int = SHARDS) -> DataFrame:
    """(shard, n, RECORD): per micro-batch the whole state of every shard that
    took part; a shard's number of records stands on the first of its rows.
    ``events`` is a stream with the columns of the landing table."""
    ship_package(events.sparkSession)
    micros = F.coalesce(F.unix_micros(F.try_to_timestamp("event_time")), F.lit(NO_TIME))
    schema = f"shard int, n long, {RECORD}"
    return (events.select(micros.alias("micros"), *[F.col(c).cast("string").alias(c) for c in TEXTS])
            .mapInPandas(lambda batches: reduced(batches, latest, shards), schema)
            .groupBy("shard").transformWithStateInPandas(Seen(latest), schema, "Update", "None"))


def run_watch(events: DataFrame, path: str, checkpoint: str, latest: int = LATEST, shards: int = SHARDS) -> None:
    """Takes in all that is landed; the state after each micro-batch is a
    slice of the table at ``path``, at most shards * latest rows."""
    spark = events.sparkSession
    run: list[str] = []

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_id_of(batch_df.sparkSession, checkpoint))
        _write_slice(batch_df, path, run[0], batch_id)

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        q = (watched(events, latest, shards).writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def states(spark: SparkSession, path: str, until: int | None = None) -> DataFrame:
    """The newest state of every shard, or that after batch ``until``."""
    rows = spark.read.parquet(path)
    if until is not None:
        rows = rows.where(F.col("batch_id") <= until)
    newest = F.max("batch_id").over(Window.partitionBy("run_id", "shard"))
    return rows.withColumn("_newest", newest).where(F.col("batch_id") == F.col("_newest")).drop("_newest")


def seen_count(spark: SparkSession, path: str, until: int | None = None) -> DataFrame:
    """total_rows: all records so far."""
    return states(spark, path, until).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))


def seen_latest(spark: SparkSession, path: str, latest: int = LATEST, until: int | None = None) -> DataFrame:
    """The latest records so far.  Each shard's are its own latest, so the
    latest of all are among them."""
    return (states(spark, path, until).orderBy(F.col("micros").desc(), *TEXTS).limit(latest)
            .select("booking_id", F.timestamp_micros(F.when(F.col("micros") != NO_TIME, F.col("micros"))).alias("event_time"),
                    *TEXTS[1:]))
