"""Session-level helpers: shared scratch storage and a local session for tests.

Scratch data (source/sink round trips, materialised intermediate tables) lives
below ``spark.checkpoint.dir`` -- the shared folder the cluster names.  A
machine-local temporary folder is only used when that setting is unset and the
master is local; on a cluster an unset folder is an error, because executors
would each write to their own disk.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def app_id(spark: SparkSession) -> str:
    """Application id (works for classic and Connect sessions)."""
    return spark.conf.get("spark.app.id", None) or "app"


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only if unset."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the server's setting rules
        if not root:
            raise RuntimeError(f"{CHECKPOINT_KEY} is not set") from None
        return root.rstrip("/")
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_KEY} is not set: on a cluster it must name a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="farebox-ckpt-"))
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)  # DataFrame.checkpoint() writes there too
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-scoped path below the checkpoint folder.

    The application id plus a random suffix keeps concurrent or repeated runs
    from colliding (the reference suffixes outputs with the application id).
    """
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_root(spark: SparkSession) -> str:
    """The folder below which this application's scratch data lie."""
    return f"{checkpoint_root(spark)}/farebox/{app_id(spark)}"


def delete_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch data; for the end of an application,
    when no result that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Settings for a large cluster, applied by the application at submit time
# (the trip queries never change a running session).  Static broadcasts from file
# size estimates are off; AQE still broadcasts a join side whose *measured*
# shuffle output is small, coalesces small shuffles and splits skewed joins.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    # The largest shuffle (line items by order key) asks for its own number of
    # partitions; all others carry aggregates and are small.
    "spark.sql.shuffle.partitions": "2000",
    "farebox.lineItemPartitions": "100000",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(app_name: str = "farebox", cores: str = "*", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
