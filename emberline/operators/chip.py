"""Chips: thirteen bands around a site on one 10 m grid, their validity, and flares from them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.detect import detect_blocks
from emberline.schema import Thresholds

#: Metres of a chip's pixel; bands that are 20 m wide and interpolated; the class that a pixel without data gets; the networks' tile.
PIXEL, COARSE, NO_CLASS, TILE = 10, (4, 5, 6, 8, 11, 12), 4, 32
#: Scenes that a task turns to arrays at a time.
TOGETHER = 64


def band_on_grid(values: np.ndarray, corner: tuple[float, float], resolution: int, bounds: tuple[float, float, float, float], offset: float) -> np.ndarray:
    """A band's digital numbers on the chip's grid, each native pixel repeated; zeros where the band doesn't reach.

    corner: west and north edge of the band. The offset is added and limited to 16 bits; zeros stay zeros.
    """
    height, width = (round((bounds[i + 2] - bounds[i]) / PIXEL) for i in (1, 0))
    scale = resolution // PIXEL
    rows, cols = -(-height // scale), -(-width // scale)
    left, top = round((bounds[0] - corner[0]) / resolution), round((corner[1] - bounds[3]) / resolution)
    native = np.zeros((rows, cols))
    y0, y1 = max(top, 0), min(top + rows, values.shape[0])
    x0, x1 = max(left, 0), min(left + cols, values.shape[1])
    if y1 > y0 and x1 > x0:
        native[y0 - top : y1 - top, x0 - left : x1 - left] = values[y0:y1, x0:x1]
    wide = native.repeat(scale, 0).repeat(scale, 1)[:height, :width]
    return np.where(wide == 0, 0, np.floor(np.clip(wide + offset, 0, 65535)))


def interpolated(nearest: np.ndarray) -> np.ndarray:
    """A 20 m band on the 10 m grid by bilinear interpolation between pixel centres, rounded; zero outside."""
    height, width = nearest.shape
    source = np.pad(nearest[::2, ::2], 1)

    def places(n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
        at = (np.arange(n) + 0.5) * m / n - 0.5
        low = np.floor(at).astype(int)
        return low + 1, at - low

    (y, wy), (x, wx) = places(height, source.shape[0] - 2), places(width, source.shape[1] - 2)
    wy = wy[:, None]
    row = lambda i: source[i][:, x] * (1 - wx) + source[i][:, x + 1] * wx
    return np.floor(row(y) * (1 - wy) + row(y + 1) * wy + 0.5)


def mirrored_to_tiles(image: np.ndarray) -> tuple[np.ndarray, tuple[int, int]]:
    """``image`` (bands, rows, columns) mirrored to multiples of TILE, and how many rows and columns came before it."""
    _, height, width = image.shape
    more = [(-n) % TILE for n in (height, width)]
    before = [m // 2 for m in more]
    pads = [(0, 0), *((b, m - b) for b, m in zip(before, more))]
    return np.pad(image, pads, mode="reflect") if min(height, width) > 1 else np.pad(image, pads, mode="edge"), (before[0], before[1])


def read_chips(scenes: DataFrame, clouds: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(id, width, height, values, nearest, valid, clear_percent) of scenes with their bands around a site.

    scenes: id, x0, y0, x1, y1 (UTM), offset, bands: an array in band order of struct(values, width, height, min_x, max_y,
    resolution). clouds maps (bands, rows, columns) of reflectances, mirrored to whole tiles, to a class map; pixels
    without data in any band get the last class, and only class 0 is valid.
    """

    def chip(r: dict) -> dict:
        bounds = (r["x0"], r["y0"], r["x1"], r["y1"])
        near = np.stack([band_on_grid(np.asarray(b["values"]).reshape(b["height"], b["width"]), (b["min_x"], b["max_y"]), b["resolution"], bounds, r["offset"]) for b in r["bands"]])
        _, height, width = near.shape
        tiled, (top, left) = mirrored_to_tiles(near / 10000)
        classes = np.where((near == 0).any(0), NO_CLASS, np.asarray(clouds(tiled))[top : top + height, left : left + width])
        values = np.stack([interpolated(b) if i in COARSE else b for i, b in enumerate(near)])
        return {"id": r["id"], "width": width, "height": height, "values": values.ravel(), "nearest": near.astype(np.int32).ravel(), "valid": (classes == 0).ravel(), "clear_percent": 100.0 * (classes == 0).mean()}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):  # Python objects of a few rows at a time, however many a batch has
                yield pa.RecordBatch.from_pylist([chip(r) for r in batch.slice(at, TOGETHER).to_pylist()], schema)

    schema = pa.schema([("id", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("values", pa.list_(pa.float64())), ("nearest", pa.list_(pa.int32())), ("valid", pa.list_(pa.bool_())), ("clear_percent", pa.float64())])
    return scenes.select(F.col("id").cast("string"), "x0", "y0", "x1", "y1", "offset", "bands").mapInArrow(
        run, "id string, width int, height int, values array<double>, nearest array<int>, valid array<boolean>, clear_percent double"
    )


def chip_flares(chips: DataFrame, thresholds: Thresholds | None = None) -> DataFrame:
    """Flares of chips (id, width, height, nearest, valid, min_x, max_y, epsg, date, mgrs, sun_elevation, sun_azimuth).

    Every second pixel makes a 20 m block without an offset; invalid pixels count as cloud.
    """
    width, height = F.floor(F.col("_w") / 2).cast("int"), F.floor(F.col("_h") / 2).cast("int")
    at = lambda i: (F.floor(i / width) * 2 * F.col("_w") + i % width * 2).cast("int")
    places = F.sequence(F.lit(0), width * height - 1)
    band = lambda k: F.transform(places, lambda i: F.get("nearest", at(i) + F.col("_w") * F.col("_h") * k))
    made = chips.withColumnsRenamed({"width": "_w", "height": "_h"}).where("_w > 1 and _h > 1").select(
        F.lit(0).alias("br"), F.lit(0).alias("bc"), "date", "mgrs", F.col("id").alias("scene"), "epsg", F.col("min_x").alias("img_min_x"), F.col("max_y").alias("img_max_y"),
        F.lit(20.0).alias("res_x"), F.lit(20.0).alias("res_y"), F.lit(0).alias("block_offset_x"), F.lit(0).alias("block_offset_y"), width.alias("width"), height.alias("height"),
        "sun_elevation", "sun_azimuth", F.lit(0.0).alias("radiometric_offset"), F.lit(10000.0).alias("quantification"),
        band(12).alias("b12"), band(11).alias("b11"), band(8).alias("b8a"), F.transform(places, lambda i: F.when(F.get("valid", at(i)), 0).otherwise(9)).alias("scl"),
    )
    return detect_blocks(made, thresholds, canonical=False).drop("br", "bc")
