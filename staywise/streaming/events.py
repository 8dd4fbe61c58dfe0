"""Booking event stream: JSON files -> raw landing table + typed real-time table.

One Structured Streaming query reads the landed JSON with the declared
9-field schema and fans every micro-batch out to two sinks inside
``foreachBatch``.  Each sink is partitioned by ``run_id``, the identity of the
query's checkpoint, and ``batch_id``, and written with dynamic partition
overwrite: a micro-batch replayed after a failure replaces its own slice
instead of appending duplicates, and a query with a new checkpoint, whose
batches count from 0 again, adds slices of its own.  ``compact`` gathers many
small slices of a run into one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..sources import schemas as S


def event_records(bronze_stream: DataFrame) -> DataFrame:
    """The declared event record (booking_id .. ingestion_time) from a
    landing-table frame; used to produce test landings."""
    return bronze_stream.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.EVENT_SCHEMA.fields])


def land_events_json(records: DataFrame, path: str) -> str:
    """Write event records as JSON lines (one file per partition)."""
    records.write.mode("overwrite").json(path)
    return path


def stream_events(spark: SparkSession, path: str, schema=S.EVENT_SCHEMA,
                  max_files: int = K.STREAM_MAX_FILES, max_bytes: int | None = None) -> DataFrame:
    """Streaming source over landed JSON files with the declared schema.

    The micro-batch cap is a file count OR a byte size (Spark rejects both
    at once); the bytes form takes a plain byte number.
    """
    r = spark.readStream.schema(schema)
    r = r.option("maxBytesPerTrigger", str(max_bytes)) if max_bytes else r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


RESCUED, FILE = "rescued", "landed_file"


def stream_events_rescued(spark: SparkSession, path: str, schema=S.EVENT_SCHEMA,
                          max_files: int = K.STREAM_MAX_FILES, max_bytes: int | None = None) -> DataFrame:
    """:func:`stream_events` with two more columns: ``rescued``, the text of a
    line that is no JSON object, and ``landed_file``, where the line lies.  A
    field of another type costs that field only: it is NULL, as in the mapping,
    and its line is not rescued."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    whole = F.startswith(F.schema_of_variant(F.try_parse_json("_corrupt_record")), F.lit("OBJECT"))
    return stream_events(spark, path, wide, max_files, max_bytes).select(
        *[f.name for f in schema.fields],
        F.when(~F.coalesce(whole, F.lit(False)), F.col("_corrupt_record")).alias(RESCUED),
        F.col("_metadata.file_path").alias(FILE))


def realtime_mapping(df: DataFrame) -> DataFrame:
    """JSON record -> typed real-time columns; unparsable values become NULL."""
    return df.select(*[
        (F.try_to_timestamp(F.col(f.name)) if f.dataType.typeName() == "timestamp"
         else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in S.REALTIME_SCHEMA.fields])


SLICE = ("run_id", "batch_id")


def _write_slice(df: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    (df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*SLICE).parquet(path))


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The query id that Spark keeps in a checkpoint: the same for every
    restart from it, another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def fanout_writer(raw_path: str, typed_path: str, checkpoint: str, bad_path: str | None = None):
    """foreachBatch body: one micro-batch -> both sinks, idempotent per
    checkpoint and batch id.  With ``bad_path`` the stream comes from
    :func:`stream_events_rescued`, and its rescued lines go there, as text with
    their file, and to no other sink."""
    run: list[str] = []

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_id_of(batch_df.sparkSession, checkpoint))
        batch_df.persist()
        try:
            good = batch_df
            if bad_path:
                bad = F.col(RESCUED).isNotNull()
                _write_slice(batch_df.where(bad).select(RESCUED, FILE), bad_path, run[0], batch_id)
                good = batch_df.where(~bad).drop(RESCUED, FILE)
            _write_slice(good, raw_path, run[0], batch_id)
            _write_slice(realtime_mapping(good), typed_path, run[0], batch_id)
        finally:
            batch_df.unpersist()
    return write


def compact(spark: SparkSession, path: str, run_id: str, below: int, out: str, files: int = 1) -> DataFrame:
    """Write the slices of a run with batch ids under ``below`` as ``files``
    files to ``out``, a table of its own; the caller swaps it in and drops the
    slices once no reader holds them.  Columns stay as they are."""
    old = spark.read.parquet(path).where((F.col("run_id") == run_id) & (F.col("batch_id") < below))
    old.repartition(files).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def stream_fanout(sdf: DataFrame, raw_path: str, typed_path: str, checkpoint: str,
                  trigger: str | None = K.STREAM_TRIGGER, available_now: bool = False,
                  bad_path: str | None = None) -> StreamingQuery:
    """Start the fan-out query.  ``available_now`` drains what is landed and
    stops (tests, catch-up runs); otherwise a processing-time trigger."""
    w = sdf.writeStream.foreachBatch(fanout_writer(raw_path, typed_path, checkpoint, bad_path)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def land_stream(sdf: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain a stream into one landing table, slice by slice."""
    run: list[str] = []

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_id_of(batch_df.sparkSession, checkpoint))
        _write_slice(batch_df, path, run[0], batch_id)

    q = (sdf.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_available(spark: SparkSession, landing: str, raw_path: str, typed_path: str, checkpoint: str,
                  max_files: int = K.STREAM_MAX_FILES, bad_path: str | None = None) -> None:
    """Process everything landed so far, then stop.  With ``bad_path`` lines
    that are no JSON objects land there instead of as rows of NULLs."""
    source = stream_events_rescued if bad_path else stream_events
    q = stream_fanout(source(spark, landing, max_files=max_files), raw_path, typed_path, checkpoint,
                      available_now=True, bad_path=bad_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
