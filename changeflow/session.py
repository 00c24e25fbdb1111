"""Session for tests and the bench, and the shared folder jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cpus: int | str = 8, app: str = "changeflow", memory: str = "16g") -> SparkSession:
    """A `local[cpus]` session. Cluster jobs bring their own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.changeflow.textPartitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Do not trace the Python line of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A session on one machine (`local[n]`) that does not set
    `spark.checkpoint.dir` gets that machine's temporary folder. On a cluster
    every executor would write to a disk of its own without any error, so a
    missing setting is one there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.gettempdir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder. Nothing is created yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/changeflow/{app}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) for a location on any Hadoop-compatible storage."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing where there is none."""
    fs, p = hadoop_path(spark, path)
    return [f.getPath().toString() for f in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as file sources report it."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def append_row(spark: SparkSession, path: str, schema: str | T.StructType, *values) -> None:
    """Append one row, as one file, to a small bookkeeping table."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)]
    spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(path)
