"""Tables of one row per key, dealt to a fixed number of hash buckets.

A bucket is a partition folder, so a landing reads and replaces only the
buckets that hold its keys; the others keep their files.  Replacing a bucket
with the same landing again gives the same rows, so a landing that was lost
half-way is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_latest
from .tables import read_or_empty

BUCKET = "bucket"
LAYOUT = "_layout"   # a name that readers of the table pass over


def bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def layout(spark: SparkSession, path: str, buckets: int) -> int:
    """The number of buckets a table has; a new table gets ``buckets``."""
    where = f"{path.rstrip('/')}/{LAYOUT}"
    schema = T.StructType([T.StructField("buckets", T.IntegerType())])
    found = read_or_empty(spark, where, schema, "json").first()
    if found is None:
        spark.createDataFrame([(buckets,)], schema).write.mode("overwrite").json(where)
        return buckets
    return int(found[0])


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
    """The table, or the buckets ``only``; before the first landing, none of
    its rows."""
    from pyspark.errors import AnalysisException
    try:
        df = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        df = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]))
    return df if only is None else df.where(F.col(BUCKET).isin(only) if only else F.lit(False))


def buckets_in(df: DataFrame) -> list[int]:
    """Which buckets occur: at most as many numbers as the table has buckets."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def files_of(spark: SparkSession, path: str, buckets) -> dict[int, frozenset]:
    """The files of those buckets that have a folder; names are never used
    twice."""
    fs, out = None, {}
    for b in buckets:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{BUCKET}={b}")
        fs = fs or folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(folder):
            out[b] = frozenset(f.getPath().getName() for f in fs.listStatus(folder))
    return out


def replace_buckets(df: DataFrame, path: str, buckets: list[int], dealt: bool = False) -> None:
    """Puts the rows of ``df`` in the place of ``buckets``.  A bucket that has
    no row any more loses its folder: its files are still the old ones when the
    others stand.  ``df`` runs once and may read ``path``, whose folders make
    place only when all new files are complete.  ``dealt``: the rows of a
    bucket lie in one task already."""
    spark = df.sparkSession
    old = files_of(spark, path, buckets)
    ((df if dealt else df.repartition(F.col(BUCKET))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    now = files_of(spark, path, old)
    for b in sorted(b for b in old if now.get(b) == old[b]):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{BUCKET}={b}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def merge_latest(landing: DataFrame, path: str, keys, order_desc, tie=(), buckets: int = 64) -> list[int]:
    """Keeps the latest row of each key over all landings; returns the buckets
    that were compared and replaced.  The landing is read once more for each
    of its two uses: pass a written table.

    Rows are dealt by bucket, in which all rows of a key lie: one shuffle and
    one sort serve the comparison and the write."""
    spark = landing.sparkSession
    new = landing.withColumn(BUCKET, bucket_of(keys, layout(spark, path, buckets)))
    touched = buckets_in(new)
    if touched:
        old = read_buckets(spark, path, landing.schema, touched)
        both = old.unionByName(new, allowMissingColumns=True).repartition(F.col(BUCKET))
        replace_buckets(dedup_latest(both, [BUCKET, *keys], order_desc, tie), path, touched, dealt=True)
    return touched
