"""Session settings, and the shared folder that jobs use to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings the session.

    ``checkpoint_dir`` is the folder that streams and written tables use.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gaugeworks")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Call-site capture asks the JVM several times per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    if checkpoint_dir is not None:
        builder = builder.config(CHECKPOINT_KEY, checkpoint_dir)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_KEY
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="gaugeworks-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder name in the shared folder for one run."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
