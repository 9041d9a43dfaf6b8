"""Queries over chips: bands on one grid, flares from chips, distances between images."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.operators import chip, plume
from emberline.plans import proxies
from emberline.plans.proxies import PIXELS
from emberline.plans.rasters import BLOCK_DETECTIONS, _shown
from emberline.work import cut

#: Metres of a pixel of each of the thirteen bands.
RESOLUTIONS = (60, 10, 10, 10, 20, 20, 20, 10, 20, 60, 60, 20, 20)


def _classes(image):
    """A stand-in for the cloud network: class 1 where the second band is over 0.09."""
    return (image[1] > 0.09).astype(int)


def chip_bands(spark, sf_dir):
    """Thirteen bands per vector on an 8 x 8 grid that partly lies outside of them: sums of nearest and interpolated pixels, and clear shares."""
    b = proxies.blocks(spark, sf_dir)
    value = lambda i: F.transform("b12", lambda v, at: F.when((F.col("vec_id") + at + i) % 17 == 0, 0).otherwise(v + 10 * i).cast("int"))
    bands = F.array(*(
        F.struct(value(i).alias("values"), F.lit(8).alias("width"), F.lit(8).alias("height"), F.lit(500000.0).alias("min_x"), F.lit(2800000.0).alias("max_y"), F.lit(r).alias("resolution"))
        for i, r in enumerate(RESOLUTIONS)
    ))
    x0, y1 = 500000.0 + (F.col("vec_id") % 3 - 1) * 20, 2800000.0 - F.col("vec_id") % 2 * 20
    scenes = b.select(F.col("vec_id").cast("string").alias("id"), x0.alias("x0"), (y1 - 80).alias("y0"), (x0 + 80).alias("x1"), y1.alias("y1"), F.lit(-500.0).alias("offset"), bands.alias("bands"))
    read = chip.read_chips(scenes, _classes)
    mixed = lambda name, k: F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, i: a + F.get(name, i + 64 * k).cast("long") * (i + 1))
    each = F.array(*(F.struct(F.lit(k).alias("band"), mixed("nearest", k).alias("near"), mixed("values", k).alias("fine")) for k in range(13)))
    return read.select(F.col("id").cast("long").alias("vec_id"), F.round("clear_percent", 6).alias("clear_percent"), F.inline(each))


CHIP_BANDS = f"""WITH {PIXELS}, rs AS (SELECT unnest(range(0, 13)) AS band, unnest([{", ".join(map(str, RESOLUTIONS))}]) AS res),
g AS (SELECT vec_id, band, res, a.i // 8 AS y, a.i % 8 AS x, CAST(round(vec_id % 2 * 20 / CAST(res AS DOUBLE)) AS INTEGER) + (a.i // 8) // (res // 10) AS r,
             CAST(round((vec_id % 3 - 1) * 20 / CAST(res AS DOUBLE)) AS INTEGER) + (a.i % 8) // (res // 10) AS c FROM embeddings, rs, range(0, 64) AS a(i)),
nr AS (SELECT g.vec_id, band, res, y, x, CASE WHEN idx IS NULL OR (g.vec_id + idx + band) % 17 = 0 THEN 0 ELSE least(65535, greatest(0, px.b12 + 10 * band - 500)) END AS v
       FROM g LEFT JOIN px ON px.vec_id = g.vec_id AND px.idx = g.r * 8 + g.c AND g.r BETWEEN 0 AND 7 AND g.c BETWEEN 0 AND 7),
lo AS (SELECT vec_id, band, y, x, y / 2e0 - 25e-2 AS py, x / 2e0 - 25e-2 AS qx FROM nr WHERE res = 20),
nb AS (SELECT lo.*, floor(py) + d AS sy, floor(qx) + e AS sx, CASE WHEN d = 1 THEN py - floor(py) ELSE 1 - (py - floor(py)) END * CASE WHEN e = 1 THEN qx - floor(qx) ELSE 1 - (qx - floor(qx)) END AS w
       FROM lo, range(0, 2) AS dd(d), range(0, 2) AS ee(e)),
fi AS (SELECT nb.vec_id, nb.band, nb.y, nb.x, floor(sum(w * coalesce(nr.v, 0)) + 5e-1) AS v FROM nb LEFT JOIN nr ON nr.vec_id = nb.vec_id AND nr.band = nb.band AND nr.y = 2 * sy AND nr.x = 2 * sx GROUP BY ALL),
cl AS (SELECT vec_id, round(100e0 * count_if(ok) / count(*), 6) AS clear_percent FROM (SELECT vec_id, y, x, min(v) > 0 AND max(v) FILTER (band = 1) <= 900 AS ok FROM nr GROUP BY ALL) GROUP BY vec_id)
SELECT nr.vec_id, clear_percent, CAST(nr.band AS INTEGER) AS band, CAST(sum(nr.v * (nr.y * 8 + nr.x + 1)) AS BIGINT) AS near, CAST(sum(coalesce(fi.v, nr.v) * (nr.y * 8 + nr.x + 1)) AS BIGINT) AS fine
FROM nr JOIN cl USING (vec_id) LEFT JOIN fi ON fi.vec_id = nr.vec_id AND fi.band = nr.band AND fi.y = nr.y AND fi.x = nr.x GROUP BY nr.vec_id, nr.band, clear_percent"""


def chip_detections(spark, sf_dir):
    """Flares of 16 x 16 chips whose every second pixel is a pixel of the vector's block; the others hold no data."""
    b = cut(proxies.blocks(spark, sf_dir))  # each band once a vector, not once a pixel of the chip
    cells = F.sequence(F.lit(0), F.lit(255))
    used = lambda i: (F.floor(i / 16) % 2 == 0) & (i % 2 == 0)
    place = lambda i: (F.floor(i / 32) * 8 + F.floor(i % 16 / 2)).cast("int")
    band = lambda name: F.transform(cells, lambda i: F.when(used(i), F.get(name, place(i)) - 1000).otherwise(0).cast("int"))
    empty = F.transform(cells, lambda i: F.lit(0))
    cloudy = lambda i: F.get("scl", place(i)).isin(3, 8, 9, 10)
    chips = b.select(
        F.col("scene").alias("id"), F.lit(16).alias("width"), F.lit(16).alias("height"), F.flatten(F.array(*(band({8: "b8a", 11: "b11", 12: "b12"}[k]) if k in (8, 11, 12) else empty for k in range(13)))).alias("nearest"),
        F.transform(cells, lambda i: used(i) & ~cloudy(i)).alias("valid"), F.col("img_min_x").alias("min_x"), F.col("img_max_y").alias("max_y"), "epsg", "date", "mgrs", "sun_elevation", "sun_azimuth",
    )
    return _shown(chip.chip_flares(cut(chips)))  # made once, as read chips are


CHIP_DETECTIONS = BLOCK_DETECTIONS


def image_distances(spark, sf_dir):
    """Distances between neighbouring vectors' images of four equal-shaped bands, matched in brightness and registered."""
    r = proxies.rasters(spark, sf_dir)
    flat = F.transform("prob", lambda p: F.lit(5000.0))
    image = F.concat(flat, flat, flat, F.transform("prob", lambda p: p * 10000))
    valid = F.transform("prob", lambda p, i: (F.col("id") + i) % 5 > 0)
    made = r.select("id", "width", "height", image.alias("target"), valid.alias("target_valid"))
    other = made.select((F.col("id") - 1).alias("id"), F.col("target").alias("background"), F.col("target_valid").alias("background_valid"))
    got = plume.distances(made.join(other, "id"))
    return got.select("id", F.round("distance", 7).alias("distance"))


#: The first three bands are even, so no shift is found and they add nothing; the fourth is scaled to the target's brightness.
IMAGE_DISTANCES = f"""WITH {PIXELS}, p AS (SELECT vec_id AS id, idx, prob AS v, (vec_id + idx) % 5 > 0 AS ok FROM pr),
m AS (SELECT id, avg(v) FILTER (ok) AS mean FROM p GROUP BY id)
SELECT a.id, round(avg(abs(a.v - b.v * CASE WHEN mb.mean <> 0 THEN ma.mean / mb.mean ELSE 1e0 END)) / 4, 7) AS distance
FROM p AS a JOIN p AS b ON b.id = a.id + 1 AND b.idx = a.idx JOIN m AS ma ON ma.id = a.id JOIN m AS mb ON mb.id = b.id WHERE a.ok AND b.ok GROUP BY a.id"""
