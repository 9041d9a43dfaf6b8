"""Chips from bands, and flares from chips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import chip


def test_band_and_interpolation():
    values = np.arange(1, 17).reshape(4, 4) * 100
    got = chip.band_on_grid(values, (1000.0, 2000.0), 20, (1020.0, 1940.0, 1060.0, 1980.0), -150)
    assert got.shape == (4, 4) and got[0].tolist() == [450, 450, 550, 550] and got[3].tolist() == [850, 850, 950, 950]
    edge = chip.band_on_grid(values, (1000.0, 2000.0), 20, (980.0, 1980.0, 1020.0, 2020.0), -150)
    assert edge[:2].sum() == 0 and edge[2].tolist() == [0, 0, 0, 0] and edge[2:, 2:].tolist() == [[0, 0], [0, 0]], "100 - 150 is limited to 0"
    flat = chip.interpolated(np.full((6, 6), 100.0))
    assert (flat[1:5, 1:5] == 100).all() and flat[0, 0] == pytest.approx(56) and flat.shape == (6, 6)
    tiled, (top, left) = chip.mirrored_to_tiles(np.arange(12.0).reshape(1, 3, 4).repeat(2, 0)[:, :, :].repeat(8, 1).repeat(8, 2))
    assert tiled.shape == (2, 32, 32) and (top, left) == (4, 0)


def test_read_and_detect(spark):
    size = {10: 12, 20: 6, 60: 2}
    resolution = [60, 10, 10, 10, 20, 20, 20, 10, 20, 60, 60, 20, 20]
    bands = []
    for i, r in enumerate(resolution):
        v = np.full((size[r], size[r]), 1500)
        if i in (11, 12):
            v[2, 3] = 9000
        if i == 1:
            v[0, 0] = 0
        bands.append((v.ravel().tolist(), size[r], size[r], 500000.0, 2800000.0, r))
    schema = "id string, x0 double, y0 double, x1 double, y1 double, offset double, bands array<struct<values:array<int>,width:int,height:int,min_x:double,max_y:double,resolution:int>>"
    scenes = spark.createDataFrame([("s", 500000.0, 2799880.0, 500120.0, 2800000.0, 0.0, bands)], schema)
    chips = chip.read_chips(scenes, lambda x: np.zeros(x.shape[1:], int))
    r = chips.first()
    assert (r.width, r.height) == (12, 12) and not r.valid[0] and sum(r.valid) == 143 and r.clear_percent == pytest.approx(100 * 143 / 144)
    more = {"min_x": 500000.0, "max_y": 2800000.0, "epsg": 32639, "date": "2024-01-01", "mgrs": "39RWN", "sun_elevation": 50.0, "sun_azimuth": 1.0}
    found = chip.chip_flares(chips.withColumns({k: F.lit(v) for k, v in more.items()})).collect()
    assert [(f.peak_img_row, f.peak_img_col, f.scene) for f in found] == [(2, 3, "s")] and found[0].max_b12 == pytest.approx(0.9)


def test_chips_in_small_lots(spark):
    """More scenes in one batch than are taken at a time, in an order that stays; no batch becomes Python objects whole."""
    n = 2 * chip.TOGETHER + 3
    band = lambda i: ([i + 1] * 16, 4, 4, 500000.0, 2800000.0, 10)
    schema = "id string, x0 double, y0 double, x1 double, y1 double, offset double, bands array<struct<values:array<int>,width:int,height:int,min_x:double,max_y:double,resolution:int>>"
    scenes = spark.createDataFrame([(str(i), 500000.0, 2799960.0, 500040.0, 2800000.0, 0.0, [band(i)] * 2) for i in range(n)], schema).coalesce(1)
    got = chip.read_chips(scenes, lambda x: np.zeros(x.shape[1:], int)).collect()
    assert [r.id for r in got] == [str(i) for i in range(n)] and all(r.nearest == [i + 1] * 32 and r.valid == [True] * 16 for i, r in enumerate(got))
