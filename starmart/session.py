"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; all of them can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a map task that runs again and deals its rows differently makes its readers run again too
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", partitions: int = 8, memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """A session for tests and benchmarks on one machine; ``shared`` sets the shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is made only for a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/starmart/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete everything this application has staged in the shared folder; frames read from there end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame once and read it back, so later uses neither recompute nor renumber it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


UNKNOWN_BYTES = 2**60  # an estimate of this size or more means that the optimizer has none


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and frames a plan reads, after pruning; runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def range_partitions(df: DataFrame, target_bytes: int = 128 * 2**20) -> int:
    """Partitions for a range shuffle, which the adaptive planner does not resize: by input size, with a
    lower bound of the session's shuffle partitions or cores, whichever are fewer."""
    spark, size = df.sparkSession, input_bytes(df)
    fewest = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(fewest, -(-size // target_bytes)) if size < UNKNOWN_BYTES else max(fewest, spark.sparkContext.defaultParallelism)
