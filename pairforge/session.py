"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job here relies on.  Joins in this package always have
# the many side on the left, which is the side the skew rule may split, so one
# key holding a third of the rows becomes many tasks.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # text work is heavy per byte, so small inputs may stay in small pieces; large
    # ones are governed by the advisory size
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    # addresses seen by a stream lie on disk, not on the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "pairforge", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter supplies one."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    The folder comes from ``spark.checkpoint.dir`` (or from the context, when
    the caller set one there).  Only a local session may fall back to the
    machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="pairforge-"))
            root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
