"""Session settings that the queries rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # tile keys such as "31" stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # rows with rasters are large
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def session(name: str = "emberline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; ``settings`` override them (dots as double underscores)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()
