"""Intermediate tables in the cluster's shared folder.

An operator that must look at its data before it can choose a plan (how many rows has the largest
group, how large is this lookup) writes the intermediate result once and goes on from the written
table. That cuts the lineage, survives the loss of executors, and gives the optimizer the true
size of the table, so that joins with it are broadcast only if it is below
``spark.sql.autoBroadcastJoinThreshold`` and are shuffled otherwise.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="slipstream-"))
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs use ``checkpoint()`` with the cluster's folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
