"""Session settings the library relies on, and shared storage lookup."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job built on this library wants; a cluster sets its own sizes.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # no call-site capture for every Column made in Python: it doubles the time of building a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions_for(shuffle_bytes: float, target_bytes: float = 256 * 2**20, cores: int = 1) -> int:
    """Initial shuffle width so that each reducer gets ~``target_bytes``
    (never fewer than the cores); AQE then coalesces small partitions."""
    return max(int(cores), int(-(-shuffle_bytes // target_bytes)))


def cluster_conf(input_bytes: float = 100 * 2**40, executors: int = 1000, cores_per_executor: int = 8,
                 shuffle_fraction: float = 0.3) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    The biggest shuffles here are the pre-aggregated daily rows and the
    item -> food join; ``shuffle_fraction`` is the share of the input they
    move. Partitions target ~256 MB so each fits an executor core's share of
    memory without spilling much; AQE coalesces the rest and splits skew.
    """
    cores = executors * cores_per_executor
    width = shuffle_partitions_for(input_bytes * shuffle_fraction, cores=cores)
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "platewise",
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def storage_root(spark: SparkSession) -> str:
    """The shared folder for written tables, staged merges and checkpoints.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage). Only a
    local-mode session without that setting (tests, a laptop) gets a private
    folder, which is then recorded in the session so later calls agree. A
    cluster session without it is an error: a driver-local folder would not
    be visible to executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. an object-store path)")
    root = tempfile.mkdtemp(prefix="platewise-", dir=os.environ.get("PLATEWISE_LOCAL_DIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through the file system that Spark uses for it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in shared storage for one run's intermediate tables.

    Lazy results may still read it after the call that made it, so it is
    removed when the driver's Python ends; ``remove_path`` does so earlier.
    """
    path = f"{storage_root(spark)}/platewise/{name}/{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            remove_path(spark, path)
        except Exception:  # the session may be gone; the folder then stays for the cluster's own clean-up
            pass

    atexit.register(remove)
    return path
