"""What driver and executors share: a folder, tables written there to cut lineage, and this package."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder of the session; only where neither is set and everything runs on
    one machine (tests), a fresh local folder that is also made the checkpoint folder."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session, for those that don't have it installed."""
    package, context = os.path.dirname(os.path.abspath(__file__)), spark.sparkContext
    if not getattr(context, "_genoloom_shipped", False):
        at = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="spark-"), "genoloom"), "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(at)
        context._genoloom_shipped = True


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again; columns that are null without a type become text."""
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c, t in df.dtypes if t == "void"})
    at = fresh(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
