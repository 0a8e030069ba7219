"""Spark session defaults and shared-storage locations.

Library code never decides where durable data lives: the cluster names a
shared folder in ``spark.checkpoint.dir``.  Only tests and local runs, where
that setting is missing, get a scratch folder of their own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  Sizes (shuffle partitions, file split
# size) are left to the caller: they depend on the cluster, not on the query.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "eventide",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; a cluster passes its own settings."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  A local session without one gets a
    scratch folder (tests); on a cluster, where executors would each write to their
    own disk, the setting is required."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="eventide-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def state_location(spark: SparkSession, name: str) -> str:
    """A fresh streaming checkpoint location below the shared folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def num_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def cut_lineage(df):
    """Write ``df`` to the shared checkpoint folder and continue from there
    (reliable checkpoint: survives executor loss, unlike a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths`` (filesystem metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        total += hp.getFileSystem(conf).getContentSummary(hp).getLength()
    return int(total)


def scale_settings(total_bytes: int, total_cores: int,
                   target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run: enough shuffle partitions that the
    largest shuffle (about the input size) gives ~128 MB per task, never fewer
    than two waves of the cores; AQE then coalesces small ones and splits skewed
    ones.  Ordered scans cut their input into as many chunks."""
    parts = max(2 * total_cores, -(-total_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def apply_scale_settings(spark: SparkSession, paths: list[str], total_cores: int) -> dict[str, str]:
    """Size the session for the data under ``paths`` (runtime SQL settings)."""
    conf = scale_settings(input_bytes(spark, *paths), total_cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
