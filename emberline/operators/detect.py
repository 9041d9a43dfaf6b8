"""Flare detection on raster blocks: native screens around an Arrow-batched array kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions import geo, pixels, scoring
from emberline.schema import BLOCK_OVERLAP, BLOCK_SIZE, Thresholds


def components(mask: np.ndarray, diagonal: bool = False) -> np.ndarray:
    """Labels of connected true cells, numbered from 1 in the order of their first cells; 0 elsewhere.

    Cells of a row form runs; runs that touch in neighbouring rows unite.
    """
    height, width = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    stop = np.nonzero(edge == -1)[1]
    root = np.arange(len(row))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    reach = 1 if diagonal else 0
    first = np.searchsorted(row, np.arange(height + 1))
    for y in range(1, height):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if start[i] < stop[j] + reach and start[j] < stop[i] + reach:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
            if stop[i] < stop[j]:
                i += 1
            else:
                j += 1
    heads = np.array([find(i) for i in range(len(row))], np.int64)
    number = np.zeros(len(row) + 1, np.int64)
    number[np.unique(heads)] = np.arange(1, len(np.unique(heads)) + 1)
    labels = np.zeros(height * width, np.int64)
    for y, a, b, h in zip(row, start, stop, heads):
        labels[y * width + a : y * width + b] = number[h]
    return labels.reshape(height, width)


def grown_from(allowed: np.ndarray, seed: int, cap: int) -> np.ndarray:
    """Cells reached from ``seed`` over 4-neighbours that are allowed, the seed included; more than ``cap`` cells end the growth."""
    height, width = allowed.shape
    flat, seen, queue = allowed.ravel(), {seed}, [seed]
    for at in queue:
        if len(seen) > cap:
            break
        y, x = divmod(at, width)
        for ok, n in ((y > 0, at - width), (y < height - 1, at + width), (x > 0, at - 1), (x < width - 1, at + 1)):
            if ok and n not in seen and flat[n]:
                seen.add(n)
                queue.append(n)
    return np.array(sorted(seen))


def _reflectance(dn, offset: float, quantification: float) -> np.ndarray:
    dn = np.asarray(dn, np.float64)
    return np.where(dn == 0, 0.0, (dn + offset) / quantification)


def flares(b12, b11, b8a, shape: tuple[int, int], offset: float, quantification: float, t: Thresholds) -> list[dict]:
    """Flares of one block: peak, mean, ratio, hot core and place of each component that passes all gates."""
    hot = _reflectance(b12, offset, quantification).reshape(shape)
    low = np.sort(hot[hot < t.b12_min])
    if len(low) < 10:
        return []
    background = float(low[len(low) // 2])
    contrast = max(background, t.background_floor) * t.contrast_ratio
    warm = _reflectance(b11, offset, quantification).reshape(shape)
    mask = (hot > t.b12_min) & (warm > t.b11_min) & (hot > contrast)
    if b8a is None:
        mask &= warm > t.saturation
    else:
        near = _reflectance(b8a, offset, quantification).reshape(shape)
        total = warm + near
        index = np.divide(warm - near, total, out=np.zeros(shape), where=total > 0.01)
        mask &= (index > 0) | (warm > t.saturation) | (hot > t.saturation)
    labels = components(mask)
    flat, values = labels.ravel(), hot.ravel()
    out = []
    if not flat.any():
        return out
    count = np.bincount(flat)
    total = np.bincount(flat, values)
    where = np.flatnonzero(flat)
    order = where[np.lexsort((where, -values[where], flat[where]))]
    peaks = order[np.searchsorted(flat[order], np.arange(1, len(count)))]
    for label, at in enumerate(peaks.tolist(), 1):
        n, peak, mean = int(count[label]), float(values[at]), float(total[label] / count[label])
        if n > t.max_pixels or peak < t.peak_b12_min or (n > t.large_pixels and peak < t.large_b12_min):
            continue
        if (n > 1 and peak < t.peakedness_min * mean and mean < t.saturation) or (n == 1 and peak < t.single_pixel_min):
            continue
        core = grown_from((labels == label) & (hot > max(peak * t.warm_fraction, t.hot_floor)), at, int(t.warm_max_pixels))
        if len(core) > t.warm_max_pixels:
            continue
        under = float(warm.ravel()[at])
        out.append(
            {
                "row": at // shape[1], "col": at % shape[1], "max_b12": peak, "avg_b12": mean, "peak_b11": under,
                "b12_b11_ratio": peak / under if under > 1e-6 else float("inf"), "peakedness": peak / mean, "pixels": len(core),
                "radiance": float(np.maximum(values[core] - background, 0).sum()), "saturated": int(peak >= t.saturation),
            }
        )
    return out


#: What :func:`flares` finds, as columns.
FOUND = "row int, col int, max_b12 double, avg_b12 double, peak_b11 double, b12_b11_ratio double, peakedness double, pixels int, radiance double, saturated smallint"
_META = ("br", "bc", "date", "mgrs", "scene", "epsg", "img_min_x", "img_max_y", "res_x", "res_y", "block_offset_x", "block_offset_y", "width", "height", "sun_elevation", "sun_azimuth")


def detect_blocks(blocks: DataFrame, thresholds: Thresholds | None = None, canonical: bool = True) -> DataFrame:
    """Detections of blocks (schema.BLOCK): schema.DETECTION with br and bc.

    Blocks that no pixel of can reach the floor, or that are too cloudy, are screened out natively in front of the
    kernel; geodesy and glint follow natively behind it. With ``canonical`` a flare in the overlap of blocks counts only
    in the block that its peak lies in. Blocks are independent rows: nothing is shuffled.
    """
    t = thresholds or Thresholds()
    offset, quant = F.coalesce("radiometric_offset", F.lit(0.0)), F.coalesce("quantification", F.lit(pixels.QUANTIFICATION))
    screened = (
        blocks.where((F.col("width") > 0) & (F.col("height") > 0))
        .where(pixels.is_hot(F.col("b12"), t.b12_min, offset, quant))
        .where(pixels.cloud_fraction(F.col("scl")) <= t.max_cloud_local)
        .select(*_META, offset.alias("offset"), quant.alias("quant"), "b12", "b11", "b8a")
    )
    kept = ", ".join(f"{c} {screened.schema[c].dataType.simpleString()}" for c in _META)

    def kernel(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                for found in flares(r.b12, r.b11, r.b8a, (r.height, r.width), r.offset, r.quant, t):
                    rows.append([*(getattr(r, c) for c in _META), *found.values()])
            yield pd.DataFrame(rows, columns=[*_META, *(c.split()[0] for c in FOUND.split(", "))])

    return located(screened.mapInPandas(kernel, f"{kept}, {FOUND}"), canonical)


def located(found: DataFrame, canonical: bool = True) -> DataFrame:
    """Flares (FOUND, row and col in their block) with the block's columns, as detections: place, sun and position in the image."""
    row, col = F.col("block_offset_y") + F.col("row"), F.col("block_offset_x") + F.col("col")
    if canonical:
        found = found.where((F.floor(row / BLOCK_SIZE) == F.col("br")) & (F.floor(col / BLOCK_SIZE) == F.col("bc")))
    place = geo.utm_to_wgs84(
        F.col("img_min_x") + (col + 0.5) * F.col("res_x"), F.col("img_max_y") - (row + 0.5) * F.col("res_y"), geo.utm_zone("epsg"), geo.utm_is_north("epsg")
    )
    sun = F.col("sun_elevation")
    return found.withColumn("place", place).select(
        "br", "bc", F.col("place.lon").alias("lon"), F.col("place.lat").alias("lat"), "date", "mgrs", "scene", "max_b12", "avg_b12", "peak_b11",
        "b12_b11_ratio", "peakedness", "pixels", "radiance", "saturated", "sun_elevation", "sun_azimuth",
        scoring.glint_angle(sun).alias("glint_angle"), scoring.glint_score(sun).alias("glint_score"),
        row.cast("long").alias("peak_img_row"), col.cast("long").alias("peak_img_col"),
    )


def block_clouds(blocks: DataFrame, thresholds: Thresholds | None = None) -> DataFrame:
    """br, bc, date, scene, skip, cloud_free of each block: too cloudy to search; clear enough to count as a look."""
    t = thresholds or Thresholds()
    share = pixels.cloud_fraction(F.col("scl"))
    skip = share > t.max_cloud_local
    return blocks.select("br", "bc", "date", "scene", skip.alias("skip"), (~skip & (share <= t.cloud_free_thresh)).alias("cloud_free"))


def cloud_free_dates(looks: DataFrame) -> DataFrame:
    """n: dates whose last scene (the greatest name) is cloud-free."""
    return looks.groupBy("date").agg(F.max_by("cloud_free", "scene").alias("free")).agg(F.count_if("free").alias("n"))


def overlapping_blocks(images: DataFrame) -> DataFrame:
    """One row (… br, bc, x0, y0, x1, y1) per block of an image that a box in degrees touches.

    images: width, height, min_x, min_y, max_x, max_y (UTM), epsg, w, s, e, n.
    """
    low = geo.wgs84_to_utm("w", "s", geo.utm_zone("epsg"), geo.utm_is_north("epsg"))
    high = geo.wgs84_to_utm("e", "n", geo.utm_zone("epsg"), geo.utm_is_north("epsg"))
    res_x, res_y = (F.col("max_x") - F.col("min_x")) / F.col("width"), (F.col("max_y") - F.col("min_y")) / F.col("height")
    zero = F.lit(0)
    px0 = F.greatest(zero, F.floor((F.greatest(low["easting"], F.col("min_x")) - F.col("min_x")) / res_x))
    py0 = F.greatest(zero, F.floor((F.col("max_y") - F.least(high["northing"], F.col("max_y"))) / res_y))
    px1 = F.least(F.col("width"), F.ceil((F.least(high["easting"], F.col("max_x")) - F.col("min_x")) / res_x))
    py1 = F.least(F.col("height"), F.ceil((F.col("max_y") - F.greatest(low["northing"], F.col("min_y"))) / res_y))
    spans = images.withColumns({"_x0": px0, "_y0": py0, "_x1": px1, "_y1": py1}).where("_x1 > _x0 and _y1 > _y0")
    numbers = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BLOCK_SIZE), F.ceil(F.col(b) / BLOCK_SIZE) - 1))
    placed = spans.withColumn("br", numbers("_y0", "_y1")).withColumn("bc", numbers("_x0", "_x1"))

    def edge(block: Column, size: str, end: bool) -> Column:
        return F.least(F.col(size), (block + 1) * BLOCK_SIZE + BLOCK_OVERLAP) if end else F.greatest(zero, block * BLOCK_SIZE - BLOCK_OVERLAP)

    return placed.withColumns(
        {"x0": edge(F.col("bc"), "width", False), "y0": edge(F.col("br"), "height", False), "x1": edge(F.col("bc"), "width", True), "y1": edge(F.col("br"), "height", True)}
    ).drop("_x0", "_y0", "_x1", "_y1")
