"""Where jobs may put data that must outlive an executor."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def _local_only(path: str) -> bool:
    return "://" not in path and not path.startswith(("hdfs:", "dbfs:")) or path.startswith("file:")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder, not yet created, that the driver and all executors share.

    It lies under ``spark.checkpoint.dir``; where that is unset, under the warehouse.  A cluster
    whose warehouse is a local path has no shared folder to offer, so it must set the former.
    The folder goes when the Python driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and _local_only(base):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base.rstrip('/')}/recspark/{label}-{uuid.uuid4().hex}"
    atexit.register(drop, spark, path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if getattr(sc, "_jsc", None) is None or sc._jsc.sc().isStopped():
        return
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, without lineage, safe from lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove what ``written`` wrote, once nothing reads it any more."""
    for table in tables:
        drop(table.sparkSession, table._written_at)
