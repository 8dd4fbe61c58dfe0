"""Positional split (first share of rows by an order key vs the rest)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..sources.tables import materialize

PIVOTS = 63       # values that cut a range, each round
FEW = 10_000      # rows of the last range, which are sorted


def _one(df: DataFrame, row, schema, name: str) -> DataFrame:
    """A table of one row with a value taken from ``df``'s keys."""
    return F.broadcast(df.sparkSession.createDataFrame([(row,)], schema).toDF(name))


def nth_key(keys: DataFrame, n: int, rows: int, pivots: int = PIVOTS, few: int = FEW):
    """The value of rank ``n`` (from 1) in the column ``key`` of ``keys``,
    which has ``rows`` rows, without sorting them.

    Each round takes ``pivots`` values of the range that holds the rank (those
    of the least hashes, a bounded sample), counts the rows between them and
    equal to them, and goes on with the range that the rank falls into: about
    64 times fewer rows, so that a trillion rows take five rounds, and always
    fewer, as the pivots themselves fall out.  The last ``few`` are
    sorted.  What reaches the driver is the pivots and their counts."""
    kind = keys.schema["key"].dataType.simpleString()
    here, left, n_here = keys, n, rows
    while n_here > few:
        sample = sorted_pivots(here.orderBy(F.xxhash64("key", F.lit(n_here))).limit(pivots))
        table = F.broadcast(sample)
        below = F.size(F.filter("pivots", lambda p: p < F.col("key")))
        # even: between two pivots; odd: equal to one
        slot = 2 * below + F.array_contains("pivots", F.col("key")).cast("int")
        counts = {r.b: r["count"] for r in here.crossJoin(table).groupBy(slot.alias("b")).count().collect()}
        at = 0
        while left > counts.get(at, 0):
            left -= counts.get(at, 0)
            at += 1
        values = sample.first()[0]
        if at % 2:
            return values[at // 2], kind
        inside = F.lit(True)
        if at > 0:
            inside &= F.col("key") > F.element_at("pivots", at // 2)
        if at // 2 < len(values):
            inside &= F.col("key") < F.element_at("pivots", at // 2 + 1)
        here, n_here = here.crossJoin(table).where(inside).select("key"), counts[at]
    return here.orderBy("key").offset(left - 1).limit(1).first()[0], kind


def sorted_pivots(sample: DataFrame) -> DataFrame:
    """One row with the sample's different values in order, at most as many as
    there are pivots; kept as values, so that later rounds don't sample again."""
    df = sample.agg(F.array_sort(F.collect_set("key")).alias("pivots"))
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def positional_split(df: DataFrame, order_cols, fraction: float = K.BATCH_SHARE,
                     label: str = "part", first: str = "batch", rest: str = "stream",
                     pivots: int = PIVOTS, few: int = FEW) -> DataFrame:
    """Label the first floor(fraction * n) rows in ``order_cols`` order
    (ascending, NULLs first).

    Rows of equal order values go by a hash of the whole row, so the split is
    the same on every run; rows equal in all columns are told apart by their
    place in a written table of just those rows.  The value at the cut is
    found by :func:`nth_key` from the order columns; no row is moved or
    written but the equal ones at the cut.
    """
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    key: Column = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)],
                           F.xxhash64(*plain).alias("tie"))
    keys = df.select(key.alias("key"))
    n = keys.count()
    cut = math.floor(n * fraction)
    if cut <= 0 or cut >= n:
        return df.withColumn(label, F.lit(first if cut > 0 else rest))
    value, kind = nth_key(keys, cut, n, pivots, few)
    at = _one(keys, value, f"key {kind}", "_cut")
    below, equal = (keys.crossJoin(at).agg(F.count_if(F.col("key") < F.col("_cut")),
                                           F.count_if(F.col("key") == F.col("_cut"))).first())
    marked = df.withColumn("_key", key).crossJoin(at)
    if below + equal == cut:
        return marked.withColumn(label, F.when(F.col("_key") <= F.col("_cut"), F.lit(first)).otherwise(F.lit(rest))
                                 ).drop("_key", "_cut")
    other = marked.where(F.col("_key") != F.col("_cut")).withColumn(
        label, F.when(F.col("_key") < F.col("_cut"), F.lit(first)).otherwise(F.lit(rest)))
    same = numbered(marked.where(F.col("_key") == F.col("_cut")), "_pos").withColumn(
        label, F.when(F.col("_pos") <= cut - below, F.lit(first)).otherwise(F.lit(rest))).drop("_pos")
    return other.unionByName(same).drop("_key", "_cut")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows numbered from 1 in the order of a written table: the place in the
    task that wrote them, after the rows of earlier tasks."""
    rows = materialize(df.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)), "numbered")
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_pid").agg(F.count("*").alias("_n")).select(   # one row a task
        "_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (rows.join(F.broadcast(before), "_pid").withColumn(name, F.col("_off") + F.col("_local") + 1)
            .drop("_pid", "_local", "_off"))
