"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "passages", **conf: str) -> SparkSession:
    """A ``local[cores]`` session, for tests and the benchmark only."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="passages-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch path and read again, for what is read more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder_names(spark: SparkSession, path: str, done: bool = False) -> list[str]:
    """Names of the folders at ``path``, with ``done`` of those that Spark wrote to their end.

    There are none if there is no such path.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [s.getPath() for s in system.listStatus(folder) if s.isDirectory()]
    return [p.getName() for p in found if not done or system.exists(hadoop.Path(p, "_SUCCESS"))]


# Writers close a row group, the least a task can read, at about this size.
ROW_GROUP_BYTES = 128 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a small scan over the cores when its files are fewer than the cores.

    One file with one row group is one task however many cores wait. A scan with a
    row group or a file per core is returned unchanged, so at scale this adds no
    shuffle. ``keys`` must be unique per row, or nearly so.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= cores * ROW_GROUP_BYTES or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(2 * cores, *keys)
