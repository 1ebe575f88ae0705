"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Codec of intermediate tables.
CODEC = "zstd"

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MAX_BATCH_BYTES = 8 << 20

# The JVM does not compile methods above 8000 bytes; Spark's per-operator
# code is faster than one large method that stays interpreted.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
MAX_METHOD_BYTES = "8000"

# Folders that this process removes when it ends; on other file systems the
# cluster's own clean-up of its checkpoint folder does it.
_LOCAL: set[str] = set()

# Settings the operators are designed around.  All of them are runtime
# choices of Spark itself: partition coalescing, skewed-join splitting and
# size-checked broadcast conversion.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    METHOD_LIMIT: MAX_METHOD_BYTES,
}


def build_session(master: str | None = None, app: str = "salesweft", **conf: str) -> SparkSession:
    """Start (or reuse) a session with the recommended settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``, else one
    below ``spark.sql.warehouse.dir``, which executors share with the driver
    as well.  A cluster that names neither gets an error instead of a folder
    that only one machine can see.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.split("[")[0] == "local" and not conf.contains("spark.sql.warehouse.dir"):
        raise ValueError("set spark.checkpoint.dir (or spark.sql.warehouse.dir) to a folder that all machines share")
    return f"{warehouse.rstrip('/')}/salesweft-work"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it lies.

    Executors elsewhere need it installed or sent along (``--py-files``).
    Batches of texts to Python are kept small, which bounds workers' memory,
    unless the session has a size of its own.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, MAX_BATCH_BYTES)
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def compilable(spark: SparkSession) -> None:
    """Keep the code of wide projections in methods that the JVM compiles, unless the session has a limit of its own."""
    if METHOD_LIMIT not in spark.conf.getAll:
        spark.conf.set(METHOD_LIMIT, MAX_METHOD_BYTES)


def session_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{work_root(spark)}/salesweft/{spark.sparkContext.applicationId}"


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under :func:`session_dir` (never reused between runs)."""
    folder = session_dir(spark)
    local = urlparse(folder)
    if local.scheme in ("", "file") and folder not in _LOCAL:
        _LOCAL.add(folder)
        atexit.register(shutil.rmtree, local.path, ignore_errors=True)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read back.

    Used where a result feeds several later steps: the plan is cut, the work
    is done once, it outlives lost executors, and the table has a known size,
    so Spark can tell by itself whether a later join may broadcast it.  Zstd
    buffers lie in the heap; Snappy's wait outside it for a garbage collection.
    """
    path = new_work_dir(df.sparkSession, purpose)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
