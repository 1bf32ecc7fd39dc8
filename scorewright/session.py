"""Spark session defaults and lineage cutting.

On a cluster the session comes configured (shuffle partitions, checkpoint dir on shared storage); these helpers only
fill in what is unset, so local tests get sane values and a real cluster keeps its own.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; applied only where the session has no value yet.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str = "local[8]", app: str = "scorewright", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session the launcher provides."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for k, v in _DEFAULTS.items():
        if conf.get(k, None) is None:
            conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names. Only a local session may go without one: all its tasks share
    the machine, and it gets a folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = f"/tmp/checkpoints/{uuid.uuid4().hex}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage like a reliable checkpoint (files on shared storage survive executor loss; never
    ``localCheckpoint``), but computes the plan once (an RDD checkpoint without persist computes it twice) and keeps
    the data columnar, so later scans prune columns and push filters.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a ``cut_lineage`` table that nothing reads any more; other files stay."""
    spark = df.sparkSession
    kept = os.path.join(checkpoint_dir(spark), "tables").split(":", 1)[-1].rstrip("/") + "/"
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        if kept.replace("//", "/") in path.replace("//", "/"):
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# Target sizes for partitions at scale: scan splits and post-shuffle partitions of ~256 MB fit comfortably in an
# executor task's memory share and keep task counts manageable on 100 TB inputs.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the input files, read from file-system metadata on the driver (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_partitions(spark: SparkSession, total_bytes: int) -> dict[str, str]:
    """Set scan split size, the initial shuffle partition count and AQE's advisory size from the input size, but
    only for settings the launcher did not set explicitly. AQE then coalesces small shuffle partitions and splits
    skewed ones at run time. Returns the settings applied."""
    launched = spark.sparkContext.getConf()
    parallelism = spark.sparkContext.defaultParallelism
    n = max(parallelism, -(-total_bytes // TARGET_PARTITION_BYTES))
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES // 4),
    }
    applied = {}
    for k, v in wanted.items():
        if not launched.contains(k):
            spark.conf.set(k, v)
            applied[k] = v
    return applied
