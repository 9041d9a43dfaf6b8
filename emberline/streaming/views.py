"""The views kept up to date as records arrive: file-source Structured Streaming. An extension; batch views stand alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberline.schema import RECORD
from emberline.sources import records


def follow_detections(spark: SparkSession, observations: str, view: str, checkpoint: str):
    """Starts a query that adds the flares of new records to ``view`` and ends when none are left.

    Each batch writes a folder of its own, named by its number, so a batch that is played again replaces what it wrote.
    """
    stream = (
        spark.readStream.schema(RECORD).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "flares-*.geojson").json(observations)
    )

    def write(batch: DataFrame, number: int) -> None:
        found = records.detections_view(batch)
        found.repartition("mgrs").write.partitionBy("mgrs").mode("overwrite").option("compression", "zstd").parquet(f"{view.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
