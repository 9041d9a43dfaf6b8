"""Table functions for SQL: the block detector, callable from a query over any table that holds blocks."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from emberline.functions.pixels import CLOUDY, QUANTIFICATION
from emberline.operators.detect import FOUND, flares
from emberline.schema import Thresholds


class DetectBlock:
    """detect_block(b12, b11, b8a, scl, width, height, radiometric_offset, quantification, thresholds=None): a row per flare of a block.

    Rows have ``row`` and ``col`` of the peak in the block and what is measured there. Bands are arrays of digital numbers,
    row by row; b8a, scl, offset and quantification may be null. thresholds, map<string, double>, overrides single limits by their
    name (null or left out: none); an unknown name is an error. Blocks that are null, empty or too cloudy give no rows.
    """

    def eval(self, b12, b11, b8a, scl, width, height, offset, quantification, thresholds=None):
        known = {f.name for f in fields(Thresholds)}
        if unknown := set(thresholds or ()) - known:
            raise ValueError(f"unknown thresholds: {', '.join(sorted(unknown))}")
        t = Thresholds(**(thresholds or {}))
        if b12 is None or b11 is None or not width or not height:
            return
        if scl is not None and len(scl) and sum(c in CLOUDY for c in scl) > t.max_cloud_local * len(scl):
            return
        for found in flares(b12, b11, b8a, (height, width), offset or 0.0, quantification or QUANTIFICATION, t):
            yield tuple(found.values())


def register(spark: SparkSession) -> None:
    """Makes ``detect_block`` known to the session's SQL, for use with LATERAL. Batches travel as Arrow."""
    spark.udtf.register("detect_block", udtf(DetectBlock, returnType=FOUND, useArrow=True))
