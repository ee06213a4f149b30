"""The folder that driver and executors share, for results that end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own only where none is set and driver and executors are one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-work-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Writes a result to the shared folder and reads it back."""
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
