"""Keep-one-row-per-key operators and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize

def _order(cols, desc: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if desc else col.asc_nulls_last())
    return out


def dedup_latest(df: DataFrame, keys, order_desc, tie=()) -> DataFrame:
    """Keep the latest row per key: ``row_number`` over ``order_desc``
    descending, then ``tie`` ascending as a total order.

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task ships at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order_desc, True), *_order(tie, False))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def collapsed_nulls(df: DataFrame, key: str) -> DataFrame:
    """Rows that share the NULL key and of which keeping one per key leaves
    one: null_rows, lost."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_rows")).select(
        "null_rows", F.greatest(F.col("null_rows") - 1, F.lit(0)).alias("lost"))


def dedup_by_key(df: DataFrame, keys, order=()) -> DataFrame:
    """One row per key; the first by ``order`` ascending (all non-key columns
    are used as the final tie-break so the choice is deterministic)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*_order(list(order) + rest, False))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def surrogate_key(df: DataFrame, order_cols, name: str = "key", partitions: int | None = None) -> DataFrame:
    """Dense 1..n key in ``order_cols`` order without a single-partition window.

    Range-partition and sort by the order columns, number rows within each
    partition, and add the row count of all earlier partitions (a table with
    one row per partition, so its size is bounded by the partition count).

    The numbered rows are written once, with partition number and local
    number, and both the counts and the result read that table: two
    evaluations of a range partitioning may sample different bounds, and
    then the counts would not belong to the numbers.  Rows equal in all order
    columns get distinct keys in an unspecified order among themselves.
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = materialize(
        df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)),
        "numbered")
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_n"))
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (ranged.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local") + 1)
            .drop("_pid", "_local", "_off"))
