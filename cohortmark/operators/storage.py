"""Where operators write what several passes read: below spark.checkpoint.dir, which driver and executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def local(spark: SparkSession) -> str:
    """A folder of this machine, for a local session without spark.checkpoint.dir."""
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="cohortmark-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path that driver and executors share: below spark.checkpoint.dir where the session has one."""
    top = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or local(spark)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: computed once, and lost executors cost no more than a read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="cohortmark-"), "cohortmark_operators")
        sc.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(top), os.path.basename(top)))
        _shipped.add(sc.applicationId)
