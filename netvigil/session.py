"""Session helper and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings a job should run with; each can be overridden by the caller.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # The JVM does not compile methods above this size; Spark then splits the stage instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the call site of every column expression takes longer than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "netvigil", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the recommended settings (``conf`` keys use ``__`` for dots)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Folder that all executors can reach, for written intermediate tables.

    It is the folder named in ``spark.checkpoint.dir``. Only a local master may
    go without that setting; it then gets a temporary folder of its own.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/netvigil/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="netvigil-")
    return f"{_local_roots[app]}/{app}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used path below the work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def at_once(spark: SparkSession, action: Callable, items: Iterable, threads: int = 4) -> list:
    """Run independent small Spark actions side by side, so that short jobs do not leave the cluster idle."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(inheritable_thread_target(spark)(action), items))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the work folder and continue from the written table.

    Used where several branches read one expensive result. The table survives
    the loss of executors, unlike cached or locally checkpointed blocks.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
