"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (oracle parity), ANSI mode
# (Spark 4 default; dirty text goes through try_* functions), AQE for
# runtime re-planning (coalescing, skew join, broadcast conversion by
# measured size).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Generated methods above the JVM's JIT limit (8000 bytes of bytecode)
    # run interpreted; past it Spark falls back to per-operator code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "staywise") -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster ``master`` stays None and the launcher decides; locally
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("STAYWISE_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher names shared storage there; without it the job
    stops, as a folder of one machine would be unseen by the others.  Only
    a local session gets a scratch folder of its own.  The folder is handed to
    the context once per application.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="staywise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if _checkpoints.get(sc.applicationId) != d:
        sc.setCheckpointDir(d)
        _checkpoints[sc.applicationId] = d
    return d


_checkpoints: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session for per-session caches of lazy plans: the
    application id and the JVM session id, so a stopped and re-created
    session never sees the previous one's DataFrames."""
    return (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, so that
    functions run in tasks can import it wherever the executors are.  The
    archive lies on the driver, whose file server hands it out."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="staywise-code-")) / "staywise.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
