"""Lineage cuts of iterative operators: in the checkpoint folder that the executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share; on one machine without a setting, a temporary one."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-work-")
    sc.setCheckpointDir(base)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Computes ``df`` once and keeps it in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
