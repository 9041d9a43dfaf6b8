"""Schemas of detections, views, records, blocks and sites."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import types as T

_TYPES = {
    "double": T.DoubleType(), "string": T.StringType(), "int": T.IntegerType(), "smallint": T.ShortType(), "bigint": T.LongType(),
    "array<int>": T.ArrayType(T.IntegerType()),
}


def _schema(text: str) -> T.StructType:
    """The schema that a list of names and types spells; needs no session, unlike Spark's own parser."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (x.split() for x in text.split(","))])


DETECTION = _schema(
    "lon double, lat double, date string, mgrs string, scene string, max_b12 double, avg_b12 double, peak_b11 double,"
    " b12_b11_ratio double, peakedness double, pixels int, radiance double, saturated smallint, sun_elevation double,"
    " sun_azimuth double, glint_angle double, glint_score double, peak_img_row bigint, peak_img_col bigint"
)
#: The detections view; ``mgrs`` is its partition key.
DETECTION_VIEW = _schema(
    "lon double, lat double, date string, mgrs string, scene string, max_b12 double, avg_b12 double, max_b11 double,"
    " b12_b11_ratio double, peakedness double, pixels int, radiance double, saturated smallint, sun_elevation double,"
    " sun_azimuth double, glint_angle double, glint_score double, method string"
)
CLOUD_VIEW = _schema("glon double, glat double, date string, cloud_frac double, method string")
BLOCK = _schema(
    "br int, bc int, date string, mgrs string, scene string, epsg int, img_min_x double, img_max_y double, res_x double,"
    " res_y double, block_offset_x int, block_offset_y int, width int, height int, sun_elevation double, sun_azimuth double,"
    " radiometric_offset double, quantification double, b12 array<int>, b11 array<int>, b8a array<int>, scl array<int>"
)
RECORD = "type string, schema string, analysis variant, features array<variant>"


@dataclass(frozen=True)
class Thresholds:
    """Limits of the block detector, in reflectance and pixels."""

    b12_min: float = 0.30
    b11_min: float = 0.20
    peak_b12_min: float = 0.50
    contrast_ratio: float = 3.0
    background_floor: float = 0.15
    peakedness_min: float = 1.15
    saturation: float = 1.0
    hot_floor: float = 0.50
    max_pixels: float = 80.0
    large_pixels: float = 30.0
    large_b12_min: float = 0.70
    warm_fraction: float = 0.5
    warm_max_pixels: float = 100.0
    single_pixel_min: float = 0.65
    max_cloud_local: float = 0.75
    cloud_free_thresh: float = 0.30

    def as_json_map(self) -> dict[str, float]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


@dataclass(frozen=True)
class ClusterOptions:
    """merge_distance in metres (0: every detection is a site of its own); observations: cloud-free looks, if known."""

    merge_distance: float = 135.0
    min_dates: int = 4
    min_avg_b12: float = 0.85
    observations: int | None = None
    score_threshold: float = 0.0


BLOCK_SIZE, BLOCK_OVERLAP = 256, 10
