"""Connected components, and comparing all members of a bucket in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, lookup, written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One large-star or small-star step over edges (a, b), a > b: each node's
    neighbours (small: those below it) are linked to the least of them.  The
    table of ``edges`` goes once the next one is written."""
    near = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(near.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
                    .withColumn("m", F.least("a", "m")), "least")
    linked = lookup(near, least, ["a"], "n", F.xxhash64("b"))
    out = linked.filter("b > a" if not small else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    out = written(out.filter("a <> b").distinct(), "edges" if small else "large")
    discard(least, edges)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node
    of its component.

    Alternating large-star and small-star steps end in stars around the least
    nodes after few rounds; every round is written, so lineage stays short.
    A hub's links are dealt over many tasks by ``lookup``.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        edges = _star(_star(edges, small=False), small=True)
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def block_pairs(members: DataFrame, bucket: str, size: str, item: str, block: int) -> DataFrame:
    """Deals each bucket's members to pairs of blocks of about ``block`` rows:
    adds ``part`` (the row's block) and the task key (``bucket``, bi, bj).  A
    bucket of up to ``block`` rows is one task; a larger one is compared by
    tasks of two blocks, each row going to as many tasks as there are blocks."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    return (members.withColumn("part", F.pmod(F.xxhash64(item, bucket), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("bi", F.least("part", "other")).withColumn("bj", F.greatest("part", "other")).drop("other"))


def by_task(rows: DataFrame, keys: list[str], fn, schema: str, partitions: int) -> DataFrame:
    """``fn(table)`` for the rows of each key, one key after the other in a
    streamed, sorted partition (a call per key costs far less this way than a
    grouped map with many small groups).  Memory holds one key's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(b.num_rows, bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                key = tuple(c[lo] for c in cols)
                if last is not None and key != last:
                    yield from fn(pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(lo, hi - lo))
                last = key
        if held:
            yield from fn(pa.Table.from_batches(held))

    return rows.repartition(partitions, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """Least index of each of ``n`` nodes' component under ``pairs``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tasks_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salted(col: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")
