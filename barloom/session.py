"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this library expects. Partition counts are left to the
#: cluster: AQE coalesces small shuffles and splits skewed joins at run time.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call site per column expression: plans here are built from many of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "barloom", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory for intermediate tables.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only where that
    is unset (local tests) does this fall back to a folder under ``/tmp``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="barloom-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read again: evaluated once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this library wrote; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move_folders(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the folders of ``source`` whose names start with ``prefix`` to ``target``, in place of those of their names."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(target))
    for found in fs.listStatus(fs_path(source)):
        name = found.getPath().getName()
        if found.isDirectory() and name.startswith(prefix):
            goal = fs_path(fs_path(target), name)
            fs.delete(goal, True)
            if not fs.rename(found.getPath(), goal):
                raise OSError(f"{found.getPath()} was not moved to {goal}")
