"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only; memory, cores and shuffle.partitions stay with the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # A query's exchanges go when it ends, instead of when the driver collects garbage. Jobs of
    # many steps would otherwise keep those of all steps on disk.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written work tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if not current:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and continue from the files.

    Cuts lineage like a checkpoint, but computes the last stage once and keeps column
    pruning. The files stay until the folder is cleaned.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table one job writes and reads back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(*frames: DataFrame) -> None:
    """Delete the work tables that ``frames`` read, once nothing will read them any more."""
    for frame in frames:
        spark = frame.sparkSession
        shared = checkpoint_dir(spark).removeprefix("file://").rstrip("/") + "/"
        for folder in {path.rpartition("/")[0] for path in frame.inputFiles()}:
            if shared in folder:
                place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
