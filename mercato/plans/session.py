"""Session defaults and the shared scratch folder.

Library functions never create a session; they take DataFrames. These helpers
are for tests, the bench and command-line use.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}

# Single-machine sessions only (tests, bench): keep the driver on loopback.
LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 2 per core) and AQE coalesces small ones at run time;
    scans read ~256 MB splits; skewed join partitions over 5x the median are
    split. Broadcasts beyond these thresholds stay shuffle joins.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "mercato",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with the settings the queries are written for."""
    builder = SparkSession.builder.master(master or "local[*]").appName(app_name)
    conf = {**DEFAULT_CONF, **LOCAL_CONF}
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the context's checkpoint dir or ``spark.checkpoint.dir``. Where
    neither is set, a folder is created for a local master only; on a cluster
    executors would each write to their own disk, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="mercato-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def input_version(spark: SparkSession, folder: str) -> str:
    """Names, sizes and modification times of all files under a folder, however
    deep, as the session's own file system lists them: one call a level, none a file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    level = jvm.org.apache.hadoop.fs.Path(folder)
    fs = level.getFileSystem(conf)
    seen = hashlib.sha256()
    while True:
        level = jvm.org.apache.hadoop.fs.Path(level, "*")
        found = fs.globStatus(level)
        if not found:
            return seen.hexdigest()
        listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(found)
        # reading a file changes its access time
        seen.update(re.sub(r"access_time=\d+", "", listed).encode())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/mercato-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a frame that
    reads it back (lineage cut: later failures do not recompute the inputs).
    Use when several results are derived from one expensive frame.

    The read has the stored files' size as its estimate. A ``checkpoint()`` keeps
    the estimate of the plan it came from, a product over all joins before, which
    in a loop grows in length with every round. Columns are stored by position,
    so any names will do.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    named = [f"c{i}" for i in range(len(df.columns))]
    stored = df.toDF(*named)
    stored.write.parquet(path)
    out = spark.read.schema(stored.schema).parquet(path).toDF(*df.columns)
    out._mercato_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete the files of materialized frames that nothing will read again.
    Frames that were not materialized are left alone."""
    for df in frames:
        path = getattr(df, "_mercato_path", None)
        if path:
            sc = df.sparkSession.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
