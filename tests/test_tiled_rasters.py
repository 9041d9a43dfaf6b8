"""Tiled TIFF files: pixels, places, and how few bytes are read."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import detect
from emberline.sources import tiled_rasters


@pytest.mark.parametrize("deflate", [True, False])
def test_windows(tmp_path, deflate):
    pixels = np.random.default_rng(4).integers(0, 65536, (301, 517)).astype(np.uint16)
    path = tmp_path / "a.tif"
    path.write_bytes(tiled_rasters.encoded(pixels, 64, deflate, 32639, 500000.0, 2800000.0, 20.0))
    r = tiled_rasters.TiledRaster(str(path))
    assert (r.width, r.height, r.epsg, r.min_x, r.max_y, r.res_x) == (517, 301, 32639, 500000.0, 2800000.0, 20.0)
    for x0, y0, x1, y1 in ((0, 0, 517, 301), (60, 60, 70, 70), (516, 300, 517, 301), (0, 128, 64, 192)):
        r = tiled_rasters.TiledRaster(str(path))
        before = r.bytes_read
        assert (r.window(x0, y0, x1, y1) == pixels[y0:y1, x0:x1]).all()
        tiles = (-(-x1 // 64) - x0 // 64) * (-(-y1 // 64) - y0 // 64)
        assert r.bytes_read - before == tiles * 8192 if not deflate else r.bytes_read - before <= tiles * 8300
    assert tiled_rasters.TiledRaster(str(path)).bytes_read <= tiled_rasters.HEAD


def test_other_files(tmp_path):
    """Differences along rows, big-endian numbers, a tile without bytes; other kinds are refused."""
    pixels = np.arange(256, dtype=np.uint16).reshape(16, 16) * 201
    raw = bytearray(tiled_rasters.encoded(pixels, 16, False))
    turned = np.diff(pixels, axis=1, prepend=0).astype("<u2")
    at = raw.index(struct.pack("<HHI", 262, 3, 1))  # stands in for the predictor's tag, which sorts later, too
    raw[at : at + 12] = struct.pack("<HHIHH", 317, 3, 1, 2, 0)
    raw[-512:] = turned.tobytes()
    (tmp_path / "p.tif").write_bytes(raw)
    assert (tiled_rasters.TiledRaster(str(tmp_path / "p.tif")).window(0, 0, 16, 16) == pixels).all()
    entries = [(256, 4, 1, 16), (257, 4, 1, 16), (258, 3, 1, 16 << 16), (322, 4, 1, 16), (323, 4, 1, 16), (324, 4, 1, 200), (325, 4, 1, 512)]
    head = b"MM" + struct.pack(">HI", 42, 8) + struct.pack(">H", len(entries)) + b"".join(struct.pack(">HHII", *e) for e in entries) + b"\0" * 4
    (tmp_path / "b.tif").write_bytes(head.ljust(200, b"\0") + pixels.astype(">u2").tobytes())
    assert (tiled_rasters.TiledRaster(str(tmp_path / "b.tif")).window(2, 3, 16, 16) == pixels[3:, 2:]).all()
    (tmp_path / "e.tif").write_bytes(head.replace(struct.pack(">HHII", 325, 4, 1, 512), struct.pack(">HHII", 325, 4, 1, 0)))
    assert not tiled_rasters.TiledRaster(str(tmp_path / "e.tif")).window(0, 0, 16, 16).any()
    for odd in (b"no image", head.replace(struct.pack(">HHII", 258, 3, 1, 16 << 16), struct.pack(">HHII", 258, 3, 1, 32 << 16))):
        (tmp_path / "o.tif").write_bytes(odd)
        with pytest.raises(ValueError):
            tiled_rasters.TiledRaster(str(tmp_path / "o.tif"))


def test_blocks_and_flares(spark, tmp_path):
    """Flares of blocks that come from files equal those of arrays; a box reads the tiles it touches only."""
    tiled_rasters.register(spark)
    n, block = 120, 48
    rng = np.random.default_rng(8)
    b12 = rng.integers(1500, 2500, (n, n))
    for y, x in ((10, 10), (47, 47), (100, 60), (70, 110)):
        b12[y : y + 2, x : x + 2] = (9000, 8000), (7500, 7000)
    b11 = (b12 * 0.9).astype(int)
    for name, values in (("B12", b12), ("B11", b11)):
        (tmp_path / f"{name}.tif").write_bytes(tiled_rasters.encoded(values, 16, True, 32639, 500000.0, 2800000.0, 20.0))
    read = lambda name: spark.read.format("tiled_raster").options(block=str(block)).load(str(tmp_path / f"{name}.tif"))
    fixed = {"date": F.lit("2024-01-01"), "mgrs": F.lit("39RWN"), "scene": F.lit("s"), "sun_elevation": F.lit(60.0), "sun_azimuth": F.lit(90.0), "radiometric_offset": F.lit(-1000.0), "quantification": F.lit(10000.0), "b8a": F.transform("b12", lambda v: F.lit(1000)), "scl": F.lit(None).cast("array<int>")}
    both = read("B12").withColumnRenamed("pixels", "b12").join(read("B11").select("br", "bc", F.col("pixels").alias("b11")), ["br", "bc"])
    names = {"min_x": "img_min_x", "max_y": "img_max_y", "x0": "block_offset_x", "y0": "block_offset_y"}
    blocks = both.withColumns({**fixed, "width": F.col("x1") - F.col("x0"), "height": F.col("y1") - F.col("y0")}).withColumnsRenamed(names)
    got = {(r.peak_img_row, r.peak_img_col, round(r.max_b12, 6), round(r.radiance, 6)) for r in detect.detect_blocks(blocks, canonical=False).collect()}
    want = set()
    for y in range(0, n, block):
        for x in range(0, n, block):
            one, two = b12[y : y + block, x : x + block], b11[y : y + block, x : x + block]
            want |= {(y + f["row"], x + f["col"], round(f["max_b12"], 6), round(f["radiance"], 6)) for f in detect.flares(one.ravel(), two.ravel(), np.full(one.size, 1000), one.shape, -1000.0, 10000.0, detect.Thresholds())}
    assert got == want and len(got) >= 4
    some = read("B12").where("x0 < 40 and y1 <= 48").collect()
    size = (tmp_path / "B12.tif").stat().st_size
    assert [(r.br, r.bc) for r in some] == [(0, 0)] and np.array_equal(np.reshape(some[0].pixels, (block, block)), b12[:block, :block]) and some[0].bytes_read < tiled_rasters.HEAD + size / 4
    assert spark.read.format("tiled_raster").options(block=str(block), overlap="5").load(str(tmp_path)).where("bc = 1 and br = 1").select("x0", "x1").distinct().collect() == [(43, 101)]
    assert read("B12").where("br = 9").count() == 0
