"""The shared folder for tables and checkpoints that jobs write in between."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, a local master gets a temporary folder for the life
    of its context; any other master is an error, as a machine-local folder
    would not outlive its machine nor be seen by the others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    For results used more than once: later uses read the table instead of
    computing it again, and losing an executor loses none of it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that :func:`staged` wrote, once nothing reads them any more."""
    for table in tables:
        remove_path(table.sparkSession, table.staged_path)
