"""Exact deduplication by 128-bit content hash, DataFrame functions only.

Texts are equal when identical after each run of ASCII white space became one
space.  Rows are grouped by the MD5 of the normalised text; inside a hash
group the bytes themselves are compared (the text is a grouping key of
``_collisions``), so a hash collision never merges different texts.

Defined cases: a null text counts as empty, so null and empty texts are one
group; null ids sort last; of repeated rows (same id, same text) one stays;
an empty table gives an empty result; other columns are carried untouched,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, content_key, keep_rows, lookup, table, written


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def content_hash(normal: Column) -> Column:
    return F.unhex(F.md5(normal.cast("binary")))


def _collisions(docs: DataFrame, text_col: str) -> DataFrame:
    """(hash, sha) pairs shared by different texts.  The first grouping
    compares whole texts byte by byte; copies collapse before the shuffle."""
    texts = docs.select(normalised(F.col(text_col)).alias("t"))
    return (texts.select(content_hash(F.col("t")).alias("hash"), "t").groupBy("hash", "t").agg(F.count("*").alias("n"))
            .groupBy("hash", F.sha2("t", 256).alias("sha")).agg(F.count("*").alias("texts"))
            .filter("texts > 1"))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id (id of the row that stays),
    group_size, kept, text_sha256, hash (of the text as it is).

    Groups are keyed by the 128-bit hash and, to tell apart texts that
    collide in it, the SHA-256; ``_collisions`` proves by their bytes that a
    group holds one text only and stops the job otherwise.
    """
    t = normalised(F.col(text_col))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), content_key(F.col(text_col)).alias("own_hash"),
                               content_hash(t).alias("hash"),
                               F.sha2(t, 256).alias("sha"), F.monotonically_increasing_id().alias("rid")),
                   "digests")
    if not _collisions(docs, text_col).isEmpty():
        raise ValueError("different texts share both digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    groups = written(rows.groupBy("hash", "sha").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    return (lookup(rows, groups, ["hash", "sha"], "group_size", F.xxhash64("rid"))
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("first.rid")).alias("kept"), F.col("sha").alias("text_sha256"),
                    F.col("own_hash").alias("hash")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    return keep_rows(docs, assign(docs, id_col, text_col).filter("kept"), id_col, text_col)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents")).drop("hash")


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST)
"""
