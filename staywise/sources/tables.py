"""Table sinks and catalog helpers."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def overwrite_table(df: DataFrame, path: str, name: str | None = None, fmt: str = "parquet",
                    partition_by=()) -> DataFrame:
    """Replace a table's data AND schema at ``path`` (shared storage).  Returns
    the table read back, which also cuts the lineage for later steps.

    The new data is always complete before the old is touched; a failed write
    leaves the old table as it was.  By path it is written beside the old
    folder, which then makes place by renaming (:func:`swap`).  With ``name``
    the table is an external catalog table: the new data goes to a fresh folder
    below ``path``, and then the name points to it; earlier folders stay
    until they are cleaned up.  A managed table or a view of that name is
    refused, since dropping the name would drop its data or meaning.
    """
    spark = df.sparkSession
    if name:
        _refuse_unless_external(spark, name)
    path = path.rstrip("/")
    beside = not name and _exists(spark, path)
    target = f"{path}/v-{uuid.uuid4().hex[:12]}" if name else f"{path}.new-{uuid.uuid4().hex[:12]}" if beside else path
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)
    if beside:
        swap(spark, target, path)
    if not name:
        return spark.read.format(fmt).load(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: only the name goes
    spark.catalog.createTable(name, path=target, source=fmt)
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.read.table(name)


def _refuse_unless_external(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{name} is a {kind} table; only external tables are replaced")


def write_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> DataFrame:
    """An external catalog table in ``buckets`` hash buckets of ``key``, one
    sorted file for each, in a fresh folder below ``path``.

    Tables with the same key type and number of buckets join and group by the
    key without a shuffle: a daily fact pays for its exchange once, on
    writing.  A bucket is read by one task, so choose the number for buckets
    of a few hundred MB; a key that alone holds more than that belongs in a
    join by shuffle, which AQE can split.
    """
    spark = df.sparkSession
    _refuse_unless_external(spark, name)
    version = uuid.uuid4().hex[:12]
    (df.repartition(buckets, key).write.format("parquet").option("path", f"{path.rstrip('/')}/v-{version}")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{name}_{version}"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external, and the new one is complete: only the name goes
    spark.sql(f"ALTER TABLE {name}_{version} RENAME TO {name}")
    return spark.read.table(name)


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Puts the folder ``new`` in the place of ``path``.  The old folder is
    renamed, and removed only when the new one stands in its place; should the
    job end in between, both are still there, the old one as ``.old-...``."""
    fs, p = _folder(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex[:12]}")
    if not fs.rename(p, old):
        raise OSError(f"cannot rename {path}")
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(new), p):
        fs.rename(old, p)
        raise OSError(f"cannot rename {new} to {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def read_table(spark: SparkSession, where: str) -> DataFrame:
    """A table by catalog name, or a parquet folder by path."""
    return spark.read.parquet(where) if "/" in where else spark.read.table(where)


#: Folders of scratch tables: by the frame that reads each, and of the open
#: :func:`scratch` blocks, the innermost last.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_blocks", default=())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in a fresh folder below the shared
    checkpoint folder and read it back: later consumers share one
    computation, and the lineage is cut (a lost executor recomputes from
    this table, not from the raw inputs).  It stays until it is discarded or
    the :func:`scratch` block it was written in ends."""
    return _materialize(df, name, _blocks.get()[-1:])


def _materialize(df: DataFrame, name: str, owners: tuple[list[str], ...]) -> DataFrame:
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    for owner in owners:
        owner.append(path)
    out = overwrite_table(df, path)
    _folders[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes the scratch tables behind frames that :func:`materialize`
    returned; other frames are left alone.  Call it once what was derived from
    them is written: no reader may be left."""
    for df in frames:
        path = _folders.pop(df, None)
        if path:
            _remove(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A block whose scratch tables go when it ends, also by an error.

    It yields ``keep(df, name)``, which writes a table that outlasts the block
    (and belongs to the block around it, if any).  An operator keeps its
    result; a job wraps operator and write::

        with scratch(spark):
            overwrite_table(operator(rows), place)
    """
    around, mine = _blocks.get(), []
    token = _blocks.set((*around, mine))
    try:
        yield lambda df, name: _materialize(df, name, around[-1:])
    finally:
        _blocks.reset(token)
        for path in mine:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def remove_versions(spark: SparkSession, path: str, name: str) -> list[str]:
    """Removes the folders below ``path`` that earlier :func:`overwrite_table`
    calls by ``name`` left, all but the one the name points to, and returns
    them.  Call it when no reader of an earlier version is left."""
    _refuse_unless_external(spark, name)
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    fs, p = _folder(spark, path.rstrip("/"))
    now = spark._jvm.org.apache.hadoop.fs.Path(rows[0]["data_type"]).getName()
    old = [f.getPath() for f in fs.listStatus(p)
           if f.isDirectory() and f.getPath().getName().startswith("v-") and f.getPath().getName() != now]
    for f in old:
        fs.delete(f, True)
    return sorted(f.getName() for f in old)


def overwrite_if_nonempty(df: DataFrame, path: str, name: str | None = None, fmt: str = "parquet") -> bool:
    """Write only when rows exist; otherwise keep the old table and warn.  The
    plan runs once, into a scratch table; what is there decides."""
    new = materialize(df, "candidate")
    if new.isEmpty():
        log.warning("no rows for %s; previous table kept", name or path)
        return False
    overwrite_table(new, path, name, fmt)
    return True


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: declared order, casts, missing
    columns as typed NULLs, undeclared columns dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in schema.fields])


def create_empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def table_inventory(spark: SparkSession, names) -> DataFrame:
    """Row count per catalog table; absent tables are reported 'not found'."""
    parts = []
    for n in names:
        if spark.catalog.tableExists(n):
            parts.append(spark.table(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count"),
                                            F.lit("ok").alias("status")))
        else:
            parts.append(spark.createDataFrame([(n, None, "not found")],
                                               "table_name string, row_count bigint, status string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_or_empty(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """A lookup table, or an empty table of its schema when it does not exist
    yet (first run of a cyclic enrichment: silver before the API landing).
    Any other fault, such as a corrupt file or a lack of rights, is raised."""
    try:
        if "/" in path:
            return spark.read.format(fmt).load(path)
        return spark.read.table(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise
        log.warning("lookup %s missing; using an empty table", path)
        return spark.createDataFrame([], schema)
