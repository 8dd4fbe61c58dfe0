"""Mixing sources to target weights, DataFrame functions only.

Tokens (white-space words) are summed per source; each source's target is its
share by weight of all words, capped at ``max_rate`` times what it has, the
excess reshared by weight among the others until no target is above its cap.
A document is taken floor(rate) times and once more if a hash of seed and
document falls below the fraction of the rate.

Defined cases: a null text has size 0; null sources are one source of their
own, last in order; a source without words gets target 0 and rate 0; a
document with a null id is seeded by its text; repeated rows are taken alike;
an empty table gives an empty result; other columns are carried untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import surrogate_key
from .common import WORD, lookup, table, whole_row, written

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = 17
# Rates of up to so many sources are broadcast (under 1 MB); more are joined
# by a salted shuffle.
BROADCAST_SOURCES = 10_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fraction(seed: int, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5: the same in every run, and
    in any engine that has MD5."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(1 << 52))


def rates(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """One row per source: source, n_docs, source_size, target.

    Resharing raises one level for all sources that are not capped: target =
    min(cap, level * weight).  Each round takes three sums to the driver and
    the level only rises, so it ends when no further source reaches its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = per.withColumn("none", F.col("source").isNull())
    order = F.pmod(F.col("k") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (order + 1).cast("int"))
    per = written(surrogate_key(per, ["none", "source"], "k").withColumn("weight", weight)
                  .withColumn("cap", F.col("source_size") * max_rate), "sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped_before = 0.0, -1
    while True:
        below = F.col("cap") <= F.lit(level) * F.col("weight")
        n, caps, rest = per.agg(F.count_if(below), F.sum(F.when(below, F.col("cap"))),
                                F.sum(F.when(~below, F.col("weight")))).first()
        if n == capped_before or not rest:
            break
        capped_before, level = n, (total - (caps or 0)) / rest
    below = F.col("cap") <= F.lit(level) * F.col("weight")
    return per.select("source", "n_docs", "source_size",
                      F.when(below, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight"))
                      .alias("target"))


def decide(docs: DataFrame, *, seed: int = SEED, weights=WEIGHTS, max_rate: int = MAX_RATE,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``row`` (the whole input row), doc_id, size, source_size, target,
    copies (how often the document is taken) and taken (size * copies)."""
    rows = docs.select(whole_row(docs), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       size_of(F.col(text_col)).alias("size"),
                       fraction(seed, F.col(id_col), F.col(text_col)).alias("draw"))
    per = written(rates(rows.select("source", "size"), weights, max_rate), "rates")
    keyed = rows.withColumns({"none": F.col("source").isNull(), "src": F.coalesce("source", F.lit(""))}).drop("source")
    per = per.withColumns({"none": F.col("source").isNull(), "src": F.coalesce("source", F.lit(""))}).drop("source")
    if per.count() <= BROADCAST_SOURCES:
        joined = keyed.join(F.broadcast(per), ["none", "src"])
    else:
        joined = lookup(keyed, per, ["none", "src"], "n_docs", F.xxhash64("doc_id", "draw"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")
    return (joined.withColumn("copies", copies)
            .select("row", "doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return (decide(docs, **options).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*"))


def op5_source_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return decide(docs).select("doc_id", "size", "source_size", "target", "taken")


# Sources sorted by cap per weight: the first k are capped, where k is the
# least number for which the level of the rest stays below the next ratio.
SQL = r"""
WITH d AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
p AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight
  FROM d GROUP BY source),
q AS (
  SELECT *, row_number() OVER s AS k, sum(cap) OVER s AS caps,
         sum(weight) OVER () - sum(weight) OVER s AS rest, sum(source_size) OVER () AS total,
         lead(cap / weight) OVER s AS next_ratio
  FROM p WINDOW s AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (
  SELECT 0 AS k, (total / (SELECT sum(weight) FROM p))::DOUBLE AS level, min(cap / weight) AS next_ratio FROM q GROUP BY total
  UNION ALL SELECT k, ((total - caps) / rest)::DOUBLE, next_ratio FROM q WHERE rest > 0),
v AS (SELECT min_by(level, k) AS level FROM l WHERE level < next_ratio),
t AS (
  SELECT p.*, CASE WHEN cap / weight <= level THEN cap::DOUBLE ELSE level * weight END AS target FROM p, v),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || md5('17:' || coalesce(d.doc_id::VARCHAR, 'text:' || coalesce(d.text, '')))[1:13])::BIGINT
           / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken
FROM r
"""
