"""Session settings the jobs rely on, and where shared scratch data goes."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

from ontime_spark.sinks import files


def build_session(app: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time, adaptive execution and a state store that spills to disk.

    Master, memory and cluster settings come from ``spark-submit`` or from ``conf``. The number
    of shuffle partitions is left to the cluster: adaptive execution merges small ones in batch,
    while a streaming query keeps the number it first started with.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without; it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ontime-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    try:
        files.delete(spark, path)
    except Exception:  # the session may have ended before the program
        return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is there when the program ends is removed."""
    path = f"{shared_dir(spark)}/ontime_spark/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path
