"""Session settings, shared scratch space and input parallelism."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that do not depend on the size of the cluster.  The number of
# shuffle partitions does: start high (AQE merges small ones), about one per
# 200 MB of the widest shuffle.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffled joins whose partitions all turn out small are hashed, not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # Call sites of column expressions: many small calls per query, for error texts only.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tonescale")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediates.

    A cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="tonescale-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder that no other run uses."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_once(frame: DataFrame, name: str) -> DataFrame:
    """Compute a frame now, as a Parquet table in the shared folder.

    Every later read sees this one result, also after lost executors.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fill_cores(frame: DataFrame, key: str) -> DataFrame:
    """Spread an input of fewer splits than cores over all of them.

    Text work is CPU-bound, so a small one-split file would keep one core busy.
    An input that already has a split per core (any large one) is left alone
    and never shuffled here.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, key)
