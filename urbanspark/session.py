"""Session and shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "urbanspark", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators assume: UTC, ANSI, AQE.

    Cluster settings (master, executors, shuffle partitions) come from spark-submit; pass ``master``
    only for a local run, where few shuffle partitions and one driver JVM are the right size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The JVM does not compile methods over 8000 bytes; beyond that split methods run faster.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Call sites per column operation cost more than planning itself for wide feature tables.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", "12g")
            .config("spark.sql.shuffle.partitions", "8")
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="urbanspark-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder name below ``spark.checkpoint.dir``, the folder all executors share.

    Where the setting is absent a local folder is taken, which only a local session can use; a
    cluster session without the setting is an error rather than a write to one machine's disk.
    """
    base = _setting(spark, "spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` on any Hadoop file system; empty if the path is absent."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
