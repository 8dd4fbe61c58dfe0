"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.tables import discard, materialize, scratch  # noqa: F401 - for the operators

# Runs of ASCII white space, and what stands between them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# At most so many keys are salted.  Every other key holds at most
# 1/HOT_KEYS of the rows, so no task receives more than that from one key.
HOT_KEYS = 1000
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once,
    lineage cut, still there when an executor is lost."""
    return materialize(df, f"llm-{name}")


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that working columns beside it
    can clash with none of them; ``select("row.*")`` restores the row."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("row")


def lookup(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str, spread: Column) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row for each key
    and that key's number of rows in ``weight``.

    The at most HOT_KEYS heaviest keys are dealt over SALTS tasks by
    ``spread`` (a hash of the row), their group rows repeated for each salt;
    the list of them is the only broadcast and has a fixed bound.  ``groups``
    is read twice: pass a written table.
    """
    hot = (groups.filter(F.col(weight) >= SALTS).orderBy(F.col(weight).desc(), *keys).limit(HOT_KEYS)
           .select(*keys, F.lit(True).alias("_hot")))
    salted = (rows.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", F.when(F.col("_hot"), F.pmod(spread, F.lit(SALTS))).otherwise(0).cast("int"))
              .drop("_hot"))
    copies = (groups.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                                             .otherwise(F.array(F.lit(0)))))
              .drop("_hot"))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def python_workers(spark: SparkSession, rows: int = 500) -> None:
    """What every operator with Python tasks needs: the package on the
    workers, and small Arrow batches (with documents of very different
    lengths, one of the default 10,000 rows could outgrow a worker)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def content_key(text: Column) -> Column:
    """128-bit hash of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, hash of the text) is in ``kept``.

    Repeated rows (same id and text) first collapse to the smallest of them
    by their sortable columns, before the shuffle where they meet there.
    """
    sortable = [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rows = docs.select(whole_row(docs), F.col(id_col).alias("doc_id"), content_key(F.col(text_col)).alias("hash"))
    one = rows.groupBy("doc_id", "hash").agg(
        F.min_by("row", F.struct(*[F.col("row")[c].alias(f"c{i}") for i, c in enumerate(sortable)])).alias("row"))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("hash").alias("kept_hash"))
    return (one.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")),
                     "left_semi").select("row.*"))
