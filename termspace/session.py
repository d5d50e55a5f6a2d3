"""Session helpers: the shared folder, and the settings the jobs rely on."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. Partition counts are left to the cluster:
# AQE coalesces and splits shuffle partitions from the sizes it measures.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str) -> SparkSession:
    """The session of a submitted job; master and memory come from the submit command."""
    builder = SparkSession.builder.appName(app)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="termspace-")
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


# Paths handed out, which go at the latest when the program ends.
_scratch: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; removed when the program ends, if its user has not done so before."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch[path] = spark
    return path


@atexit.register
def _remove_scratch() -> None:
    for path, spark in list(_scratch.items()):
        # A stopped session can no longer reach its folder.
        if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
            break
        remove(spark, path)


def settle(df: DataFrame, label: str, work: str | None = None) -> DataFrame:
    """Write an intermediate table once and read it back, so that nothing before it runs again.

    The table goes below ``work`` (a path in the shared folder), or below a fresh
    path there. It outlives lost executors, and its size is known to the planner.
    """
    path = f"{work}/{label}" if work else scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of our own once its tables are no longer read."""
    _scratch.pop(path, None)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread a table that is read in fewer partitions than there are cores.

    Meant before costly expressions on a few small files. A table of more
    partitions, which any large one is, is left where it is. Only for tables as
    they are read: to count the partitions of a derived one is to compute it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
