"""Ranked lexical search by norm buckets, the LEMP way.

Items are the queries and documents the rows searched.  A document's impact
vector has one coordinate for each item term it holds, so that the inner
product with an item's vector is the score:

    w = floor(1000 ln((2N+2) / (2 df+1))),  m = 100-50 + (50 n N) div L,
    impact = (1000000000 tf) div (1000 tf + 20 m),  score = sum of w * impact.

With sqrt(w) on both sides, x = sqrt(w) * impact and q = sqrt(w), lengths of
documents and items weigh evenly.  Documents are dealt by falling length
|x|; consecutive runs of BUCKET of them are the buckets.  An item passes a
bucket by if |q| * greatest length < its threshold (Cauchy-Schwarz), the
k-th best score known so far.  Inside a bucket the item's heaviest
coordinates are summed from their lists; with the rest bounded by
|q rest| * |x rest|, documents that cannot reach the threshold fall out.
The survivors are scored again in 64-bit integers.  First thresholds come
from the PRIMER longest documents, which are ordinary candidates as well.

Items are taken in blocks of at most ITEMS rows and TERMS distinct terms;
the documents are read once for each block.  What tasks are handed is one
block: its terms, weights and thresholds.

Defined cases: a null or empty text has no term, is no candidate, and an
item without terms has no row; a null doc_id is a candidate, ranks last among
equals and stays null; of repeated documents each is a candidate, of repeated
items each is searched and ranked for itself, and so is an item of null id;
equal scores go by doc_id; texts are read whole, however long; empty tables
give an empty result; other columns do not enter.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import python_workers, table, written
from .graph import tasks_of

K = 50
BUCKET = 2048       # documents of a bucket
PRIMER = 4096       # longest documents, for the first thresholds
ITEMS = 4000        # items of a block
TERMS = 400_000     # distinct terms of a block
NO_ID = (1 << 63) - 1
# Bytes of a text after this are space between terms, or belong to a term;
# bytes from 0x80 are parts of code points beyond ASCII, all of them term.
FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
             for c in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(FOLD).split() if raw else []


class Block:
    """Items and their terms as numbers."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.items: list[np.ndarray] = []
        self.number: dict[bytes, int] = {}

    def add(self, item_id, text: str | None) -> None:
        terms = dict.fromkeys(terms_of((text or "").encode("utf-8", "replace")))
        self.ids.append(item_id)
        self.items.append(np.array([self.number.setdefault(t, len(self.number)) for t in terms], np.int64))

    def full(self) -> bool:
        return len(self.items) >= ITEMS or len(self.number) >= TERMS


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The items, a block at a time."""
    block = Block()
    for r in items.select(F.col(id_col), F.col(text_col)).toLocalIterator():
        block.add(r[0], r[1])
        if block.full():
            yield block
            block = Block()
    if block.items:
        yield block


def vectors(docs: DataFrame, block: Block, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, and the block's terms in the document with their counts, of
    every document that has a term."""
    number = docs.sparkSession.sparkContext.broadcast(block.number)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = number.value.get
        for b in batches:
            ids, ns, held, counts = [], [], [], []
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text")):
                terms = terms_of(raw.as_py())
                if terms:
                    found = np.array([i for i in map(find, terms) if i is not None], np.int32)
                    t, tf = np.unique(found, return_counts=True)
                    ids.append(doc_id)
                    ns.append(len(terms))
                    held.append(t)
                    counts.append(tf.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(held, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return written(rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>"), "term-vectors")


def weights(rows: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each term of the block."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(terms, np.int64)
    for t, c in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term of the block
        df[t] = c
    return n, total, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def offsets(column: pa.Array) -> np.ndarray:
    at = column.offsets.to_numpy().astype(np.int64)
    return at - at[0]


def impacts(b: pa.RecordBatch, n_docs: int, total: int, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """For the entries of a batch: row, term, w * impact; and the rows' squared
    lengths, the sums of w * impact^2."""
    at = offsets(b.column("terms"))
    term = b.column("terms").flatten().to_numpy().astype(np.int64)
    tf = b.column("tfs").flatten().to_numpy()
    m = np.array([50 + 50 * n * n_docs // total for n in b.column("n").to_pylist()], np.int64)
    row = np.repeat(np.arange(b.num_rows), np.diff(at))
    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
    square = np.bincount(row, w[term].astype(float) * impact.astype(float) ** 2, b.num_rows)
    return row, term, w[term] * impact, square


class Bucket:
    """Documents of a run of lengths, with a list of entries for each term."""

    def __init__(self, batch: pa.RecordBatch, n_docs: int, total: int, w: np.ndarray):
        self.ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        row, term, score, self.square = impacts(batch, n_docs, total, w)
        self.longest = math.sqrt(self.square.max(initial=0.0))
        order = np.argsort(term, kind="stable")
        self.rows, self.scores = row[order], score[order]
        self.terms, starts = np.unique(term[order], return_index=True)
        self.starts = np.append(starts, len(order))

    def lists(self, terms: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(term, rows, scores) of those of ``terms`` that occur here."""
        at = np.searchsorted(self.terms, terms)
        return [(int(t), self.rows[self.starts[i]:self.starts[i + 1]], self.scores[self.starts[i]:self.starts[i + 1]])
                for t, i in zip(terms, at) if i < len(self.terms) and self.terms[i] == t]

    def search(self, item: "Item", floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that reach ``floor`` and their exact scores.  ``item.terms``
        fall by weight; the first half of them are the focus."""
        found = self.lists(item.terms)
        focus = set(item.terms[:(len(item.terms) + 1) // 2].tolist())
        part, used = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for t, rows, scores in found:
            if t in focus:
                part[rows] += scores
                used[rows] += scores.astype(float) ** 2 / item.w[t]
        rest = np.sqrt(np.maximum(self.square - used, 0)) * item.rest
        keep = (part + rest) * (1 + 1e-9) + 1 >= floor
        exact = np.zeros(len(self.ids), np.int64)
        for _t, rows, scores in found:
            near = keep[rows]
            exact[rows[near]] += scores[near]
        at = np.flatnonzero(keep & (exact >= max(floor, 1)))
        return at, exact[at]


class Item:
    """An item's terms by falling weight, its length, and the length of the
    coordinates outside the focus."""

    def __init__(self, terms: np.ndarray, w: np.ndarray):
        self.terms = terms[np.argsort(-w[terms], kind="stable")]
        self.w = w
        self.length = math.sqrt(w[terms].sum())
        self.rest = math.sqrt(w[self.terms[(len(terms) + 1) // 2:]].sum())


class Best:
    """The k best (score, smaller id first) of an item so far."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.heap = k, floor, []

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for s, i in zip(scores.tolist(), ids.tolist()):
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, (s, -i))
            else:
                heapq.heappushpop(self.heap, (s, -i))
        if len(self.heap) == self.k:
            self.floor = max(self.floor, self.heap[0][0])


def in_buckets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined, or cut, to ``size`` rows, order kept."""
    held, n = [], 0
    for b in batches:
        while b.num_rows:
            take = min(size - n, b.num_rows)
            held.append(b.slice(0, take))
            b, n = b.slice(take), n + take
            if n == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def search_block(rows: DataFrame, block: Block, k: int, bucket: int, primer: int) -> DataFrame:
    """(qid, doc_id, score): of each task the k best of each item, which hold
    the k best of all."""
    spark = rows.sparkSession
    n_docs, total, w = weights(rows, len(block.number))
    items = [Item(t[w[t] > 0], w) for t in block.items]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = np.sqrt(impacts(b, n_docs, total, w)[3]) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(length)], [*b.schema.names, "length"])

    schema = "doc_id long, n long, terms array<int>, tfs array<long>"
    held = (rows.filter(F.size("terms") > 0).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
            .mapInArrow(measure, f"{schema}, length double"))

    def run(floors: list[int]):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = [Best(k, f) for f in floors]
            for b in in_buckets(batches, bucket):
                here = Bucket(b, n_docs, total, w)
                for item, kept in zip(items, best):
                    if item.length * here.longest * (1 + 1e-9) + 1 >= kept.floor:  # Cauchy-Schwarz
                        at, scores = here.search(item, kept.floor)
                        kept.add(here.ids[at], scores)
            found = [(q, -i, s) for q, kept in enumerate(best) for s, i in kept.heap]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                 ["qid", "doc_id", "score"])
        return search

    result = "qid long, doc_id long, score long"
    floors = [1] * len(items)
    longest = held.orderBy(F.col("length").desc(), "doc_id").limit(primer)  # a bounded sample
    order = Window.partitionBy("qid").orderBy(F.col("score").desc())
    for r in (longest.mapInArrow(run(floors), result).withColumn("r", F.row_number().over(order))
              .filter(F.col("r") == k).collect()):  # one row an item
        floors[r.qid] = r.score
    dealt = (held.repartitionByRange(tasks_of(rows), F.col("length").desc(), F.xxhash64("doc_id", "n", "terms"))
             .sortWithinPartitions(F.col("length").desc()))
    best = dealt.mapInArrow(run(floors), result)
    first = Window.partitionBy("qid").orderBy(F.col("score").desc(), "doc_id")
    ids = spark.createDataFrame(list(enumerate(block.ids)), "qid long, item_id long")
    return (best.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
            .join(F.broadcast(ids), "qid")  # one row an item of the block
            .select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score"))


def rank(docs: DataFrame, items: DataFrame, k: int = K, *, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", bucket: int = BUCKET, primer: int = PRIMER) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    python_workers(docs.sparkSession)
    parts = []
    for block in blocks(items, item_id, item_text):
        rows = vectors(docs, block, id_col, text_col)
        parts.append(search_block(rows, block, k, bucket, primer))
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT rid, doc_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents)),
q AS (
  SELECT DISTINCT qid, item_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS qid, item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark)),
n AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM d GROUP BY rid),
t AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM n),
tf AS (SELECT rid, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, t GROUP BY term),
m AS (SELECT rid, doc_id, 50 + (50 * n * nn) // l AS m FROM n, t),
s AS (SELECT qid, any_value(item_id) AS item_id, rid, any_value(doc_id) AS doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY qid, rid),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0)
SELECT item_id, k::INT AS rank, doc_id, score FROM r WHERE k <= 50
"""
