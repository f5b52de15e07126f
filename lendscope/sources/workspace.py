"""Folder for checkpoints and intermediate tables.

On a cluster it must be shared storage, named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local session may fall back to
    a folder of this machine; it is then set for the session."""
    configured = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {KEY} to a folder all executors can reach")
    folder = "file://" + tempfile.mkdtemp(prefix="lendscope-")
    spark.conf.set(KEY, folder)
    return folder


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/lendscope/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str, *by: str) -> DataFrame:
    """``frame`` written to the shared folder and read back, in folders of the columns ``by``.

    For rows that several branches of a plan use: each branch reads the files
    instead of computing the rows again, also after an executor is lost.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, purpose)
    (frame.write.partitionBy(*by) if by else frame.write).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
