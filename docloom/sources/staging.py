"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only where driver and executors are one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{tempfile.gettempdir()}/docloom"


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session is gone at exit; there is nothing left to tell
        pass


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back, for plans that need it more than once.

    Unlike a cache it survives the loss of an executor.  The table goes when the
    driver exits.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/docloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)
