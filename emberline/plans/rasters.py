"""Queries over raster blocks, probability rasters and geodesy."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import functions as F

from emberline.functions import geo, pixels, tables
from emberline.functions.binding import let
from emberline.operators import coverage, detect, plume
from emberline.plans import proxies
from emberline.plans.proxies import DETECTIONS, PIXELS
from emberline.schema import Thresholds
from emberline.sources import tiled_rasters
from emberline.work import cut, shared_folder


def _r(digits, *names):
    return [F.round(n, digits).alias(n) for n in names]


def block_pixels(spark, sf_dir):
    """Calibrated pixels over the floor per block."""
    b = proxies.blocks(spark, sf_dir)
    hot = F.transform("b12", lambda v: pixels.calibrate(v, F.col("radiometric_offset"), F.col("quantification")))
    return b.select("vec_id", F.size(F.filter(hot, lambda v: v >= 0.3)).alias("n"), F.round(F.array_max(hot), 9).alias("peak"), pixels.is_hot(F.col("b12"), 0.3, F.col("radiometric_offset"), F.col("quantification")).alias("hot"))


BLOCK_PIXELS = f"WITH {PIXELS} SELECT vec_id, CAST(count_if(b12 >= 3e-1) AS INTEGER) AS n, round(max(b12), 9) AS peak, bool_or(dn12 >= 4000) AS hot FROM pr GROUP BY vec_id"


def block_backgrounds(spark, sf_dir):
    """Upper median of pixels under the floor, and the contrast it asks for; blocks with ten such pixels."""
    b = proxies.blocks(spark, sf_dir)
    cold = F.sort_array(F.filter(F.transform("b12", lambda v: pixels.calibrate(v, F.col("radiometric_offset"), F.col("quantification"))), lambda v: v < 0.3))
    low = b.select("vec_id", cold.alias("cold")).where(F.size("cold") >= 10)
    median = F.element_at("cold", (F.floor(F.size("cold") / 2) + 1).cast("int"))
    return low.select("vec_id", F.round(median, 9).alias("background"), F.round(F.greatest(median, F.lit(0.15)) * 3.0, 9).alias("contrast"))


BLOCK_BACKGROUNDS = f"""WITH {PIXELS} SELECT vec_id, round(m, 9) AS background, round(greatest(m, 15e-2) * 3, 9) AS contrast
FROM (SELECT vec_id, count(*) AS n, list_sort(list(b12))[count(*) // 2 + 1] AS m FROM pr WHERE b12 < 3e-1 GROUP BY vec_id) WHERE n >= 10"""


def block_clouds(spark, sf_dir):
    b = proxies.blocks(spark, sf_dir)
    return b.select("vec_id", F.round(pixels.cloud_fraction(F.col("scl")), 9).alias("share"), (pixels.cloud_fraction(F.col("scl")) > 0.75).alias("skip"))


BLOCK_CLOUDS = f"WITH {PIXELS} SELECT vec_id, round(count_if(scl IN (3, 8, 9, 10)) / 64e0, 9) AS share, count_if(scl IN (3, 8, 9, 10)) > 48 AS skip FROM pr GROUP BY vec_id"

#: Labels of 4-connected hot cells: the least index that a cell reaches.
_MASKED = f"""{PIXELS},
bg AS (SELECT vec_id, greatest(list_sort(list(b12))[count(*) // 2 + 1], 15e-2) * 3 AS contrast, list_sort(list(b12))[count(*) // 2 + 1] AS med FROM pr WHERE b12 < 3e-1 GROUP BY vec_id HAVING count(*) >= 10),
cl AS (SELECT vec_id FROM pr GROUP BY vec_id HAVING count_if(scl IN (3, 8, 9, 10)) <= 48),
mk AS (SELECT pr.*, med FROM pr JOIN bg USING (vec_id) JOIN cl USING (vec_id) WHERE b12 > 3e-1 AND b11 > 2e-1 AND b12 > contrast
       AND ((CASE WHEN b11 + b8a > 1e-2 THEN (b11 - b8a) / (b11 + b8a) ELSE 0 END) > 0 OR b11 > 1 OR b12 > 1)),
ed AS (SELECT a.vec_id, a.idx AS x, b.idx AS y FROM mk AS a JOIN mk AS b ON a.vec_id = b.vec_id AND (abs(a.idx - b.idx) = 8 OR (abs(a.idx - b.idx) = 1 AND a.idx // 8 = b.idx // 8))),
rc AS (SELECT vec_id, idx AS x, idx AS lab FROM mk UNION SELECT rc.vec_id, ed.y, rc.lab FROM rc JOIN ed ON ed.vec_id = rc.vec_id AND ed.x = rc.x),
lb AS (SELECT vec_id, x AS idx, min(lab) AS lab FROM rc GROUP BY vec_id, x),
cp AS (SELECT vec_id, lab, count(*) AS n, max(b12) AS peak, avg(b12) AS mean, arg_min(idx, (-b12, idx)) AS top, any_value(med) AS med FROM lb JOIN mk USING (vec_id, idx) GROUP BY vec_id, lab)"""


def block_components(spark, sf_dir):
    """4-connected components of the spectral mask, before any gate."""
    open_ = Thresholds(max_pixels=1e9, peak_b12_min=0.0, large_pixels=1e9, peakedness_min=0.0, single_pixel_min=0.0, warm_max_pixels=1e6)
    found = detect.detect_blocks(proxies.blocks(spark, sf_dir), open_)
    return found.select("scene", "peak_img_row", "peak_img_col", *_r(9, "max_b12", "avg_b12"))


BLOCK_COMPONENTS = f"WITH RECURSIVE {_MASKED} SELECT 'V' || vec_id AS scene, CAST(top // 8 AS BIGINT) AS peak_img_row, CAST(top % 8 AS BIGINT) AS peak_img_col, round(peak, 9) AS max_b12, round(mean, 9) AS avg_b12 FROM cp"


def block_detections(spark, sf_dir):
    """The whole block detector: gates, hot core, radiance, ratio, glint and place."""
    return _shown(detect.detect_blocks(proxies.blocks(spark, sf_dir)))


def _shown(d):
    return d.select("scene", "date", "peak_img_row", "peak_img_col", "pixels", F.col("saturated").cast("int").alias("saturated"), *_r(7, "lon", "lat"), *_r(9, "max_b12", "avg_b12", "peak_b11", "peakedness", "radiance", "glint_angle", "glint_score"), F.round("b12_b11_ratio", 9).alias("ratio"))


BLOCK_DETECTIONS = f"""WITH RECURSIVE {_MASKED},
gd AS (SELECT * FROM cp WHERE n <= 80 AND peak >= 5e-1 AND NOT (n > 30 AND peak < 7e-1) AND NOT (n > 1 AND peak < 115e-2 * mean AND mean < 1) AND NOT (n = 1 AND peak < 65e-2)),
hc AS (SELECT gd.vec_id, gd.lab, lb.idx FROM gd JOIN lb USING (vec_id, lab) JOIN mk USING (vec_id, idx) WHERE b12 > greatest(peak * 5e-1, 5e-1) OR lb.idx = gd.top),
gr AS (SELECT vec_id, lab, top AS x FROM gd UNION SELECT gr.vec_id, gr.lab, ed.y FROM gr JOIN ed ON ed.vec_id = gr.vec_id AND ed.x = gr.x JOIN hc ON hc.vec_id = gr.vec_id AND hc.lab = gr.lab AND hc.idx = ed.y),
co AS (SELECT gr.vec_id, gr.lab, count(*) AS core, sum(greatest(b12 - mk.med, 0)) AS radiance FROM gr JOIN mk ON mk.vec_id = gr.vec_id AND mk.idx = gr.x GROUP BY gr.vec_id, gr.lab),
ft AS (SELECT gd.*, core, radiance, b11 AS low, 25e0 + gd.vec_id % 6 * 10 AS sun FROM gd JOIN co USING (vec_id, lab) JOIN mk ON mk.vec_id = gd.vec_id AND mk.idx = gd.top),
k AS (SELECT 1 / 298257223563e-9 AS f), c AS (SELECT f * (2 - f) AS e2 FROM k),
q AS (SELECT e2, e2 / (1 - e2) AS ep, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) AS e1, 1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2 * e2 * e2 / 256 AS m1 FROM c),
u AS (SELECT ft.*, q.*, 500000e0 + (top % 8 + 5e-1) * 20 - 500000e0 AS ux, (2800000e0 - (top // 8 + 5e-1) * 20) / 9996e-4 / (6378137e0 * m1) AS mu FROM ft, q),
p AS (SELECT *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 * e1 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu) + 151 * e1 ** 3 / 96 * sin(6 * mu) + 1097 * e1 ** 4 / 512 * sin(8 * mu) AS phi FROM u),
w AS (SELECT *, 1 - e2 * sin(phi) ** 2 AS es, tan(phi) ** 2 AS t1, ep * cos(phi) ** 2 AS c1 FROM p),
v AS (SELECT *, 6378137e0 / sqrt(es) AS n1, 6378137e0 * (1 - e2) / es ** 15e-1 AS r1 FROM w), g AS (SELECT *, ux / (n1 * 9996e-4) AS dd FROM v)
SELECT 'V' || vec_id AS scene, '2024-01-' || lpad(CAST(vec_id % 28 + 1 AS VARCHAR), 2, '0') AS date, CAST(top // 8 AS BIGINT) AS peak_img_row, CAST(top % 8 AS BIGINT) AS peak_img_col,
 CAST(core AS INTEGER) AS pixels, CAST(peak >= 1 AS INTEGER) AS saturated,
 round(51 + degrees((dd - (1 + 2 * t1 + c1) * dd ** 3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * ep + 24 * t1 * t1) * dd ** 5 / 120) / cos(phi)), 7) AS lon,
 round(degrees(phi - n1 * tan(phi) / r1 * (dd ** 2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * ep) * dd ** 4 / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * ep - 3 * c1 * c1) * dd ** 6 / 720)), 7) AS lat,
 round(peak, 9) AS max_b12, round(mean, 9) AS avg_b12, round(low, 9) AS peak_b11, round(peak / mean, 9) AS peakedness, round(radiance, 9) AS radiance,
 90 - sun AS glint_angle, CASE WHEN 90 - sun <= 25 THEN 1e0 WHEN 90 - sun >= 65 THEN 0e0 ELSE (65 - (90 - sun)) / 40 END AS glint_score, round(peak / low, 9) AS ratio FROM g"""


def sql_block_detections(spark, sf_dir):
    """The block detector as a table function of SQL, called per block by LATERAL."""
    tables.register(spark)
    found = spark.sql(
        """SELECT b.*, f.* FROM {blocks} AS b, LATERAL detect_block(b.b12, b.b11, b.b8a, b.scl, b.width, b.height, b.radiometric_offset, b.quantification) AS f""",
        blocks=proxies.blocks(spark, sf_dir),
    )
    return _shown(detect.located(found))


SQL_BLOCK_DETECTIONS = BLOCK_DETECTIONS


def tiled_blocks(spark, sf_dir):
    """Mosaics of 8 x 8 blocks written as tiled TIFF files, and what the left half of their 32-pixel blocks holds when read back."""
    tiled_rasters.register(spark)
    b = proxies.blocks(spark, sf_dir).select(F.floor(F.col("vec_id") / 64).alias("image"), (F.col("vec_id") % 64).alias("place"), "b12")
    folder = f"{shared_folder(spark)}/tiles-{uuid.uuid4().hex}"

    def write(f):
        grid = np.zeros((64, 64), np.uint16)
        for place, values in zip(f["place"], f["b12"]):
            y, x = divmod(int(place), 8)
            grid[8 * y : 8 * y + 8, 8 * x : 8 * x + 8] = np.reshape(values, (8, 8))
        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        with store.open_output_stream(f"{at}/{int(f['image'].iloc[0])}.tif") as out:
            out.write(tiled_rasters.encoded(grid, tile=16, deflate=bool(f["image"].iloc[0] % 2), epsg=32639, min_x=500000.0, max_y=2800000.0, res=20.0))
        return f[["image"]].head(1)

    b.groupBy("image").applyInPandas(write, "image long").write.format("noop").mode("overwrite").save()
    read = spark.read.format("tiled_raster").options(block="32").load(folder).where("x1 <= 32")
    total = F.aggregate("pixels", F.lit(0).cast("long"), lambda a, x: a + x)
    image = F.regexp_extract("path", r"(\d+)\.tif", 1).cast("long")
    return read.select(image.alias("image"), "br", "bc", "epsg", total.alias("total"), F.array_max("pixels").alias("most")).where("total > 0")


TILED_BLOCKS = f"""WITH {PIXELS}, t AS (SELECT vec_id // 64 AS image, vec_id % 64 // 8 * 8 + idx // 8 AS y, vec_id % 8 * 8 + idx % 8 AS x, dn12 FROM pr)
SELECT CAST(image AS BIGINT) AS image, CAST(y // 32 AS INTEGER) AS br, CAST(x // 32 AS INTEGER) AS bc, 32639 AS epsg, CAST(sum(dn12) AS BIGINT) AS total, max(dn12) AS most FROM t WHERE x < 32 GROUP BY ALL"""


def class_histograms(spark, sf_dir):
    """Scene classes of each block, as text, and the cloud fraction of pixels with data."""
    b = proxies.blocks(spark, sf_dir).withColumn("h", pixels.histogram(F.col("scl")))
    return b.select("vec_id", F.array_join(F.col("h").cast("array<string>"), ",").alias("hist"), F.round(pixels.histogram_cloud_fraction(F.col("h")), 9).alias("cloud_frac"))


CLASS_HISTOGRAMS = f"""WITH {PIXELS}, h AS (SELECT vec_id, v, count_if(scl = v) AS n FROM pr CROSS JOIN range(0, 12) AS r(v) GROUP BY vec_id, v)
SELECT vec_id, string_agg(CAST(n AS VARCHAR), ',' ORDER BY v) AS hist, round(coalesce(sum(n) FILTER (v IN (3, 8, 9, 10)) / CAST(nullif(sum(n) FILTER (v <> 0), 0) AS DOUBLE), 0), 9) AS cloud_frac FROM h GROUP BY vec_id"""


def raster_windows(spark, sf_dir):
    """A 3 x 3 window of each block, a window over its corner (zeros outside), every second pixel, a mirrored index."""
    b = proxies.blocks(spark, sf_dir)
    text = lambda a: F.array_join(a.cast("array<string>"), ",")
    lit = F.lit
    return b.select(
        "vec_id", text(pixels.window(F.col("b12"), F.col("width"), lit(2), lit(1), lit(5), lit(4))).alias("inner"),
        text(pixels.padded_window(F.col("b12"), F.col("width"), F.col("height"), lit(-1), lit(-1), 3)).alias("corner"),
        text(pixels.decimated(F.col("b12"), 8, 8, 4)).alias("coarse"), pixels.reflected((F.col("vec_id") % 13 - 4).cast("int"), lit(5)).cast("long").alias("mirrored"),
    )


RASTER_WINDOWS = f"""WITH {PIXELS}, z AS (SELECT vec_id, map_from_entries(list((idx, dn12))) AS m FROM pr GROUP BY vec_id)
SELECT vec_id, array_to_string(list_transform([10, 11, 12, 18, 19, 20, 26, 27, 28], lambda i: m[i]), ',') AS inner, array_to_string([0, 0, 0, 0, m[0], m[1], 0, m[8], m[9]], ',') AS corner,
 array_to_string([m[0], m[4], m[32], m[36]], ',') AS coarse, CAST(CASE WHEN (vec_id % 13 - 4 + 8) % 8 < 5 THEN (vec_id % 13 - 4 + 8) % 8 ELSE 8 - (vec_id % 13 - 4 + 8) % 8 END AS BIGINT) AS mirrored FROM z"""


def plume_parts(spark, sf_dir):
    """8-connected components of at least 5 cells above 0.5, and their weighted centres."""
    parts = plume.plume_components(proxies.rasters(spark, sf_dir), 0.5, 5)
    return plume.weighted_centres(parts, F.lit(8)).select("id", "pixels", *_r(7, "row", "col", "max_weight"))


PLUME_PARTS = f"""WITH RECURSIVE {PIXELS}, mk AS (SELECT vec_id, idx, prob FROM pr WHERE prob > 5e-1),
ed AS (SELECT a.vec_id, a.idx AS x, b.idx AS y FROM mk AS a JOIN mk AS b ON a.vec_id = b.vec_id AND a.idx <> b.idx AND abs(a.idx // 8 - b.idx // 8) <= 1 AND abs(a.idx % 8 - b.idx % 8) <= 1),
rc AS (SELECT vec_id, idx AS x, idx AS lab FROM mk UNION SELECT rc.vec_id, ed.y, rc.lab FROM rc JOIN ed ON ed.vec_id = rc.vec_id AND ed.x = rc.x),
lb AS (SELECT vec_id, x AS idx, min(lab) AS lab FROM rc GROUP BY vec_id, x)
SELECT vec_id AS id, CAST(count(*) AS INTEGER) AS pixels, round(sum((idx // 8) * (prob - 5e-1)) / sum(prob - 5e-1), 7) AS row, round(sum((idx % 8) * (prob - 5e-1)) / sum(prob - 5e-1), 7) AS col,
 round(max(prob - 5e-1), 7) AS max_weight FROM lb JOIN mk USING (vec_id, idx) GROUP BY vec_id, lab HAVING count(*) >= 5"""


def scene_scores(spark, sf_dir):
    return plume.scene_scores(proxies.rasters(spark, sf_dir), 5).select("id", F.round("score", 6).alias("score"))


#: The least probability of a set of five or more cells that hang together is greatest at v; the bisection stops around it.
SCENE_SCORES = f"""WITH RECURSIVE {PIXELS}, nb AS (SELECT a.i AS x, b.i AS y FROM range(0, 64) AS a(i) JOIN range(0, 64) AS b(i) ON a.i <> b.i AND abs(a.i // 8 - b.i // 8) <= 1 AND abs(a.i % 8 - b.i % 8) <= 1),
rc AS (SELECT vec_id, idx AS s, prob AS least, idx AS x FROM pr UNION SELECT rc.vec_id, rc.s, rc.least, nb.y FROM rc JOIN nb USING (x) JOIN pr ON pr.vec_id = rc.vec_id AND pr.idx = nb.y AND pr.prob >= rc.least),
v AS (SELECT vec_id, max(least) AS v FROM (SELECT vec_id, s, least FROM rc GROUP BY vec_id, s, least HAVING count(*) >= 5) GROUP BY vec_id),
bi AS (SELECT vec_id, min(prob) AS low, max(prob) AS high, coalesce(v, -1e0) AS v FROM pr LEFT JOIN v USING (vec_id) GROUP BY vec_id, v
  UNION ALL SELECT vec_id, CASE WHEN (low + high) / 2 < v THEN (low + high) / 2 ELSE low END, CASE WHEN (low + high) / 2 < v THEN high ELSE (low + high) / 2 END, v FROM bi WHERE high - low > 1e-3)
SELECT vec_id AS id, round((low + high) / 2, 6) AS score FROM bi WHERE high - low <= 1e-3"""


def flux_rates(spark, sf_dir):
    """Flux and uncertainty of each raster's cells above one half, taken as enhancements."""
    r = proxies.rasters(spark, sf_dir)
    ppb = F.transform(F.filter("prob", lambda p: p > 0.5), lambda p: p * 2000.0)
    q = plume.flux(plume.summed_enhancement(F.col("ppb")), F.size("ppb"), F.col("id") % 9 + F.lit(0.5))
    return r.withColumn("ppb", ppb).withColumn("q", q).select("id", F.round("q.rate", 5).alias("rate"), F.round("q.sigma", 5).alias("sigma"))


FLUX_RATES = f"""WITH {PIXELS}, t AS (SELECT vec_id AS id, count_if(prob > 5e-1) AS n, coalesce(sum(greatest(-600e0, least(100000e0, prob * 2000)) * 8) FILTER (prob > 5e-1), 0) AS s, vec_id % 9 + 5e-1 AS w FROM pr GROUP BY vec_id),
m AS (SELECT *, s * (100 * 1000 * 1604e-5 / (1e6 * 224e-1)) AS ime, sqrt(n) * (20564270005117675e-14 * 8 * (100 * 1000 * 1604e-5 / (1e6 * 224e-1))) AS si, sqrt(n * 100) AS len, 33e-2 * w + 45e-2 AS ue,
      (33e-2 * 33e-2 + 1e-4) * w * w * 125e-2 - (33e-2 * w) ** 2 + 1e-4 AS vu FROM t)
SELECT id, round(CASE WHEN n = 0 OR s <= 0 THEN 0 ELSE 3600 * ue * ime / len END, 5) AS rate, round(CASE WHEN n = 0 THEN 0 ELSE 3600 / len * sqrt(greatest(0, vu * si * si + vu * ime * ime + si * si * ue * ue)) END, 5) AS sigma FROM m"""


def registrations(spark, sf_dir):
    """Shift between neighbouring vectors' images, and a weighted sum of the pixels of the image that was moved."""
    r = proxies.rasters(spark, sf_dir)
    image = F.concat("prob", "prob", "prob")
    after = r.select((F.col("id") - 1).alias("id"), image.alias("background"))
    got = plume.aligned(r.select("id", "width", "height", image.alias("target")).join(after, "id"), (0, 1, 2))
    total = F.aggregate(F.transform("aligned", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return got.select("id", *_r(5, "tx", "ty"), F.round(total, 4).alias("total"))


def _finer(low: str, high: str) -> str:
    return f"coalesce(CASE WHEN abs({low} - 2 * c + {high}) >= 1e-12 THEN greatest(-5e-1, least(5e-1, 5e-1 * ({low} - {high}) / ({low} - 2 * c + {high}))) END, 0)"


REGISTRATIONS = f"""WITH {PIXELS}, p AS (SELECT vec_id AS id, idx // 8 AS y, idx % 8 AS x, prob AS v FROM pr),
ab AS (SELECT a.id, a.y - b.y AS dy, a.x - b.x AS dx, a.v AS a, b.v AS b FROM p AS a JOIN p AS b ON b.id = a.id + 1 WHERE a.y BETWEEN 1 AND 6 AND a.x BETWEEN 1 AND 6 AND abs(a.y - b.y) <= 5 AND abs(a.x - b.x) <= 5),
sc AS (SELECT id, dy, dx, corr(a, b) AS c FROM ab GROUP BY id, dy, dx HAVING var_pop(a) > 0 AND var_pop(b) > 0),
be AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY id ORDER BY c DESC, dy, dx) = 1),
ne AS (SELECT be.*, l.c AS cl, r.c AS cr, u.c AS cu, d.c AS cd FROM be LEFT JOIN sc AS l ON l.id = be.id AND l.dy = be.dy AND l.dx = be.dx - 1 LEFT JOIN sc AS r ON r.id = be.id AND r.dy = be.dy AND r.dx = be.dx + 1
       LEFT JOIN sc AS u ON u.id = be.id AND u.dx = be.dx AND u.dy = be.dy - 1 LEFT JOIN sc AS d ON d.id = be.id AND d.dx = be.dx AND d.dy = be.dy + 1),
f AS (SELECT id, dx + {_finer("cl", "cr")} AS tx, dy + {_finer("cu", "cd")} AS ty FROM ne),
t AS (SELECT id, CASE WHEN tx * tx + ty * ty <= 25 THEN tx ELSE 0e0 END AS tx, CASE WHEN tx * tx + ty * ty <= 25 THEN ty ELSE 0e0 END AS ty FROM f),
m AS (SELECT id - 1 AS id, map_from_entries(list((y * 8 + x, v))) AS m FROM p GROUP BY id),
g AS (SELECT t.*, m, unnest(range(0, 64)) AS i FROM t JOIN m USING (id)),
h AS (SELECT *, floor(i // 8 - ty) AS ay, floor(i % 8 - tx) AS ax, i // 8 - ty - floor(i // 8 - ty) AS wy, i % 8 - tx - floor(i % 8 - tx) AS wx FROM g),
k AS (SELECT *, CAST(greatest(0, least(7, ay)) AS BIGINT) AS j0, CAST(greatest(0, least(7, ay + 1)) AS BIGINT) AS j1, CAST(greatest(0, least(7, ax)) AS BIGINT) AS i0, CAST(greatest(0, least(7, ax + 1)) AS BIGINT) AS i1 FROM h),
z AS (SELECT *, (m[j0 * 8 + i0] * (1 - wx) + m[j0 * 8 + i1] * wx) * (1 - wy) + (m[j1 * 8 + i0] * (1 - wx) + m[j1 * 8 + i1] * wx) * wy AS v FROM k)
SELECT id, round(tx, 5) AS tx, round(ty, 5) AS ty, round(sum(v * (3 * (i + 1) + 192)), 4) AS total FROM z GROUP BY id, tx, ty"""


_AMF, _COLUMNS = (2.0, 2.2, 2.5, 3.0, 4.0), (1300.0, 1800.0, 2500.0, 4000.0, 8000.0)


def _transmittances() -> dict:
    """A transmittance table of our own."""
    along = lambda k: [[math.exp(-k * a * c / 1e4) for c in _COLUMNS] for a in _AMF]
    own = {"transmittance_b12": along(0.5), "transmittance_b11": along(0.1), "transmittance_b12_bg": [math.exp(-0.09 * a) for a in _AMF], "transmittance_b11_bg": [math.exp(-0.018 * a) for a in _AMF]}
    return {"amf_arr": list(_AMF), "mr_ch4_arr": [list(_COLUMNS)] * 5, "background_concentration": 1800.0, "S2B": own}


def plume_retrievals(spark, sf_dir):
    """Methane in each block's cells above one half, seen under angles of its own."""
    b = proxies.blocks(spark, sf_dir).withColumnRenamed("vec_id", "id")
    shifted = lambda c, by: F.transform(c, lambda v: (v - by).cast("double"))
    six = lambda low, high: F.concat(*[low] * 5, high)
    cells = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get("prob", i) > 0.5)
    chips = b.join(proxies.rasters(spark, sf_dir).select("id", "prob"), "id").select(
        "id", six(shifted("b11", 1000), shifted("b12", 1000)).alias("target"), six(shifted("b11", 900), shifted("b8a", 800)).alias("aligned"), F.transform("scl", lambda v: v % 3 > 0).alias("valid"),
        F.lit("S2B").alias("satellite"), (F.col("id") % 50 + 20).cast("double").alias("sun_zenith"), (F.col("id") % 9).cast("double").alias("view_zenith"),
        F.array(F.struct(F.lit(0).alias("component"), cells.alias("cells"))).alias("parts"),
    )
    total = F.aggregate("ppb", F.lit(0.0), lambda a, v: a + v)
    return plume.retrievals(chips, _transmittances()).select("id", F.size("ppb").alias("cells"), F.round(total, 4).alias("total"), F.round(F.array_max("ppb"), 4).alias("most"), F.round(F.array_min("ppb"), 4).alias("least"))


def _weights(x: list[str], at: str) -> list[str]:
    """SQL of the factors by which the not-a-knot spline through five points takes their values: only the middle one is a knot."""
    over = lambda i, t: "(" + " * ".join(f"(({t}) - {x[j]}) / ({x[i]} - {x[j]})" for j in range(5) if j != i) + ")"
    divided = lambda i: "(1e0 / (" + " * ".join(f"({x[i]} - {x[j]})" for j in range(5) if j != i) + "))"
    cut = lambda t: f"pow(greatest(0e0, ({t}) - {x[2]}), 3)"
    bend = " + ".join(f"{cut(x[i])} * {divided(i)}" for i in range(5))
    rest = f"({cut(at)} - (" + " + ".join(f"{cut(x[i])} * {over(i, at)}" for i in range(5)) + "))"
    return [f"({over(i, at)} + {divided(i)} / ({bend}) * {rest})" for i in range(5)]


def _weighed(values: list[str]) -> str:
    return "(" + " + ".join(f"w{i} * {v}" for i, v in enumerate(values)) + ")"


def _decays(k: float) -> list[str]:
    return [_weighed([f"exp({-k * a * c / 1e4!r}::DOUBLE)" for a in _AMF]) for c in _COLUMNS]


PLUME_RETRIEVALS = f"""WITH {PIXELS}, q AS (SELECT vec_id AS id, prob > 5e-1 AS cell, scl % 3 > 0 AS valid, CASE WHEN b11 <> 0 THEN least(10e0, b12 / b11) END AS rt, (b8a + 2e-2) / (b11 + 1e-2) AS rb FROM pr),
mn AS (SELECT id, coalesce(avg(rt) FILTER (valid AND NOT cell), 1) AS mt, avg(least(10e0, rb)) AS mb FROM q GROUP BY id),
r AS (SELECT id, CASE WHEN rt <> 0 AND rb <> 0 AND mt <> 0 THEN least(10e0, (rt / mt) / (least(10e0, rb) / mb)) ELSE 1e0 END AS r FROM q JOIN mn USING (id) WHERE cell),
g AS (SELECT DISTINCT vec_id AS id, least(4e0, 1 / cos(radians(vec_id % 9)) + 1 / cos(radians(vec_id % 50 + 20))) AS t FROM pr),
w AS (SELECT id, {", ".join(f"{e} AS w{i}" for i, e in enumerate(_weights([f"{a!r}::DOUBLE" for a in _AMF], "t")))} FROM g),
cv AS (SELECT id, {_weighed([f"exp({-0.09 * a!r}::DOUBLE)" for a in _AMF])} / {_weighed([f"exp({-0.018 * a!r}::DOUBLE)" for a in _AMF])} AS base, {", ".join(f"{h} / {low} AS x{i}" for i, (h, low) in enumerate(zip(_decays(0.5), _decays(0.1))))} FROM w),
tb AS (SELECT *, greatest(3e-1, least(108e-2, r)) * base AS t FROM r JOIN cv USING (id)),
ww AS (SELECT id, r, {", ".join(f"{e} AS w{i}" for i, e in enumerate(_weights([f"x{i}" for i in range(5)], "t")))} FROM tb),
pb AS (SELECT id, CASE WHEN r = 1 THEN 0 ELSE {_weighed([f"{c!r}::DOUBLE" for c in _COLUMNS])} - 1800 END AS ppb FROM ww)
SELECT vec_id AS id, CAST(count(ppb) AS INTEGER) AS cells, round(coalesce(sum(ppb), 0), 4) AS total, round(max(ppb), 4) AS most, round(min(ppb), 4) AS least FROM embeddings LEFT JOIN pb ON pb.id = vec_id GROUP BY vec_id"""


def scene_statuses(spark, sf_dir):
    r = proxies.rasters(spark, sf_dir)
    zeros = F.size(F.filter("prob", lambda p: p <= 0.45))
    return r.select("id", plume.status((F.col("id") * 7 % 100).cast("double"), zeros, F.size("prob"), F.col("id") % 3 > 0).alias("status"))


SCENE_STATUSES = f"""WITH {PIXELS} SELECT vec_id AS id, CASE WHEN vec_id * 7 % 100 < 50 THEN 'cloudy' WHEN count_if(prob <= 45e-2) * 2 > 64 THEN 'out_of_swath' WHEN vec_id % 3 = 0 THEN 'no_background' ELSE 'ok' END AS status FROM pr GROUP BY vec_id"""


def _utm(frame: str) -> str:
    """SQL of u: the rows of ``frame`` (lon, lat) with easting and northing in zone 39 north."""
    return f"""k AS (SELECT 1 / 298257223563e-9 AS f), c0 AS (SELECT f * (2 - f) AS e2 FROM k), q AS (SELECT e2, e2 / (1 - e2) AS ep FROM c0),
a AS (SELECT p.*, q.*, radians(lat) AS phi, radians(lon - 51) AS dl FROM {frame} AS p, q), b AS (SELECT *, tan(phi) ** 2 AS t, ep * cos(phi) ** 2 AS cc, cos(phi) * dl AS aa, 6378137e0 / sqrt(1 - e2 * sin(phi) ** 2) AS n0 FROM a),
g AS (SELECT *, 6378137e0 * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * phi - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * phi) + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * phi) - 35 * e2 ** 3 / 3072 * sin(6 * phi)) AS m,
      cos(radians(lat + 25e-2)) AS cb FROM b),
u AS (SELECT *, 9996e-4 * n0 * (aa + (1 - t + cc) * aa ** 3 / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * ep) * aa ** 5 / 120) + 500000 AS easting,
 9996e-4 * (m + n0 * tan(phi) * (aa ** 2 / 2 + (5 - t + 9 * cc + 4 * cc * cc) * aa ** 4 / 24 + (61 - 58 * t + t * t + 600 * cc - 330 * ep) * aa ** 6 / 720)) AS northing FROM g)"""


def projected_places(spark, sf_dir):
    """Places to UTM and back, distances, areas and padded boxes."""
    d = proxies.detections(spark, sf_dir)
    at = geo.wgs84_to_utm("lon", "lat", F.lit(39), F.lit(True))
    back = geo.utm_to_wgs84(at["easting"], at["northing"], F.lit(39), F.lit(True))
    box = geo.pad_bbox(F.col("lon"), F.col("lat"), F.col("lon") + 0.5, F.col("lat") + 0.5, 1.5)
    return d.select(
        "det_id", F.round(at["easting"], 3).alias("easting"), F.round(at["northing"], 3).alias("northing"), F.round(back["lon"], 7).alias("lon"), F.round(back["lat"], 7).alias("lat"),
        F.round(geo.distance_m("lat", "lon", F.lit(25.2), F.lit(51.05)), 4).alias("metres"), F.round(geo.bbox_area_km2(box["w"], box["s"], box["e"], box["n"]), 5).alias("km2"),
        geo.cell_index("lon").alias("i"), geo.cell_index("lat").alias("j"),
    )


PROJECTED_PLACES = f"""WITH {DETECTIONS}, {_utm("d")}
SELECT det_id, round(easting, 3) AS easting, round(northing, 3) AS northing,
 round(lon, 7) AS lon, round(lat, 7) AS lat, round(6371000e0 * sqrt(pow(radians(252e-1 - lat), 2) + pow(radians(5105e-2 - lon) * cos(radians((lat + 252e-1) / 2)), 2)), 4) AS metres,
 round((5e-1 + 2 * 15e-1 / 111) * 111 * (5e-1 + 2 * 15e-1 / (111 * cb)) * 111 * cb, 5) AS km2, CAST(round(lon * 1000) AS BIGINT) AS i, CAST(round(lat * 1000) AS BIGINT) AS j FROM u"""


def grid_cells(spark, sf_dir):
    """The cells that tile each user's box of detections."""
    d = proxies.detections(spark, sf_dir)
    boxes = d.groupBy("uid").agg(F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"))
    return coverage.grid_sites(boxes).select("uid", "i", "j", "cell")


GRID_CELLS = f"""WITH {DETECTIONS}, b AS (SELECT uid, CAST(round(min(lon) * 1000) AS BIGINT) AS w, CAST(round(min(lat) * 1000) AS BIGINT) AS s, CAST(round(max(lon) * 1000) AS BIGINT) AS e, CAST(round(max(lat) * 1000) AS BIGINT) AS n FROM d GROUP BY uid),
x AS (SELECT *, unnest(range(w, e + 1)) AS i FROM b), y AS (SELECT *, unnest(range(s, n + 1)) AS j FROM x) SELECT uid, i, j, printf('%.3f,%.3f', i / 1000e0, j / 1000e0) AS cell FROM y"""


def image_blocks(spark, sf_dir):
    """Blocks of a 10 980-pixel image that each user's box touches."""
    d = proxies.detections(spark, sf_dir)
    boxes = d.groupBy("uid").agg(F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"))
    image = {"width": 10980, "height": 10980, "min_x": 450000.0, "min_y": 2690000.0, "max_x": 559800.0, "max_y": 2799800.0, "epsg": 32639}
    return detect.overlapping_blocks(boxes.withColumns({k: F.lit(v) for k, v in image.items()})).select("uid", "br", "bc", "x0", "y0", "x1", "y1")


IMAGE_BLOCKS = f"""WITH {DETECTIONS}, bx AS (SELECT uid, min(lon) AS w, min(lat) AS s, max(lon) AS e, max(lat) AS n FROM d GROUP BY uid),
co AS (SELECT uid, 0 AS hi, w AS lon, s AS lat FROM bx UNION ALL SELECT uid, 1, e, n FROM bx), {_utm("co")},
x AS (SELECT uid, max(easting) FILTER (hi = 0) AS e0, max(northing) FILTER (hi = 0) AS n0, max(easting) FILTER (hi = 1) AS e1, max(northing) FILTER (hi = 1) AS n1 FROM u GROUP BY uid),
y AS (SELECT uid, greatest(0, floor((greatest(e0, 450000) - 450000) / 10)) AS x0, greatest(0, floor((2799800 - least(n1, 2799800)) / 10)) AS y0,
      least(10980, ceil((least(e1, 559800) - 450000) / 10)) AS x1, least(10980, ceil((2799800 - greatest(n0, 2690000)) / 10)) AS y1 FROM x),
z AS (SELECT uid, unnest(range(CAST(floor(y0 / 256e0) AS BIGINT), CAST(ceil(y1 / 256e0) AS BIGINT))) AS br, x0, x1 FROM y WHERE x1 > x0 AND y1 > y0),
v AS (SELECT uid, br, unnest(range(CAST(floor(x0 / 256e0) AS BIGINT), CAST(ceil(x1 / 256e0) AS BIGINT))) AS bc FROM z)
SELECT uid, br, bc, greatest(0, bc * 256 - 10) AS x0, greatest(0, br * 256 - 10) AS y0, least(10980, (bc + 1) * 256 + 10) AS x1, least(10980, (br + 1) * 256 + 10) AS y1 FROM v"""


def covered_sites(spark, sf_dir):
    """Scene classes around the detections' cells in each vector's image."""
    cells = proxies.detections(spark, sf_dir).select(F.round(F.col("lon"), 3).alias("lon"), F.round(F.col("lat"), 3).alias("lat")).distinct()
    box = geo.corner_bbox(F.col("min_x"), F.col("min_y"), F.col("max_x"), F.col("max_y"), F.col("epsg"))
    image = {"width": 8, "height": 8, "min_x": 500000.0, "max_x": 508000.0, "min_y": 2764000.0, "max_y": 2772000.0}
    scenes = proxies.blocks(spark, sf_dir).drop("width", "height").withColumns({k: F.lit(v) for k, v in image.items()}).withColumn("box", box)
    scenes = scenes.select("date", "scene", "epsg", *image, "box.w", "box.s", "box.e", "box.n", "scl")
    return coverage.cover_sites(cells, scenes).select("lon", "lat", "scene", F.array_join(F.col("hist").cast("array<string>"), ",").alias("hist"), "valid", *_r(9, "cloud_frac"))


COVERED_SITES = f"""WITH {DETECTIONS}, {PIXELS}, cl AS (SELECT DISTINCT round(lon, 3) AS lon, round(lat, 3) AS lat FROM d), {_utm("cl")},
pt AS (SELECT lon, lat, CAST(floor((easting - 500000) / 1000) AS INTEGER) AS x, CAST(floor((2772000 - northing) / 1000) AS INTEGER) AS y FROM u),
xy AS (SELECT DISTINCT x, y FROM pt WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7),
hs AS (SELECT vec_id, x, y, list_transform(range(0, 12), lambda k: CAST(len(list_filter(list(scl), lambda v: v = k)) AS INTEGER)) AS h, CAST(25 - count(*) AS INTEGER) AS beyond FROM pr JOIN xy ON abs(idx % 8 - x) <= 2 AND abs(idx // 8 - y) <= 2 GROUP BY vec_id, x, y),
vd AS (SELECT *, CAST(list_sum(h[2:]) AS INTEGER) AS valid FROM hs)
SELECT lon, lat, 'V' || vec_id AS scene, array_to_string(list_prepend(h[1] + beyond, h[2:]), ',') AS hist, valid, round((h[4] + h[9] + h[10] + h[11]) / CAST(valid AS DOUBLE), 9) AS cloud_frac
FROM vd JOIN pt USING (x, y) WHERE valid > 0"""


def chip_fractions(spark, sf_dir):
    """Share of obscured pixels around cells of a chip, of the pixels with data."""
    b = proxies.blocks(spark, sf_dir)
    cells = F.array(*(F.struct(F.lit(n).alias("cell"), F.lit(x).alias("col"), F.lit(y).alias("row")) for n, x, y in (("a", 0, 0), ("b", 7, 7), ("c", 3, 1))))
    chips = b.select("scene", "width", "height", F.transform("b12", lambda v: F.when(v == 1000, 0).otherwise(v)).alias("blue"), F.transform("scl", lambda v: v % 3).alias("class"), cells.alias("cells"))
    return coverage.chip_cell_fractions(chips).select("scene", "cell", *_r(9, "fraction"))


CHIP_FRACTIONS = f"""WITH {PIXELS}, c AS (SELECT * FROM (VALUES ('a', 0, 0), ('b', 7, 7), ('c', 3, 1)) AS v(cell, col, row))
SELECT 'V' || vec_id AS scene, cell, round(count_if(scl % 3 <> 0) / CAST(count(*) AS DOUBLE), 9) AS fraction FROM pr JOIN c ON abs(idx % 8 - col) <= 5 AND abs(idx // 8 - row) <= 5
WHERE dn12 <> 1000 GROUP BY vec_id, cell"""


def wind_samples(spark, sf_dir):
    """Bilinear samples of an 8 x 8 grid, also beyond its edge."""
    r = proxies.rasters(spark, sf_dir)
    at = lambda m: F.col("id") % m / F.lit(4e0) - 1
    return r.select("id", F.round(geo.bilinear(F.col("prob"), 8, 8, at(37), at(29)), 9).alias("value"))


WIND_SAMPLES = f"""WITH {PIXELS}, z AS (SELECT vec_id, map_from_entries(list((idx, prob))) AS m FROM pr GROUP BY vec_id),
a AS (SELECT vec_id, m, vec_id % 37 / 4e0 - 1 AS x, vec_id % 29 / 4e0 - 1 AS y FROM z), b AS (SELECT *, CAST(floor(x) AS INTEGER) AS i, CAST(floor(y) AS INTEGER) AS j FROM a),
c AS (SELECT *, x - i AS u, y - j AS v, greatest(0, least(7, i)) AS i0, greatest(0, least(7, i + 1)) AS i1, greatest(0, least(7, j)) AS j0, greatest(0, least(7, j + 1)) AS j1 FROM b)
SELECT vec_id AS id, round((m[j0 * 8 + i0] * (1 - u) + m[j0 * 8 + i1] * u) * (1 - v) + (m[j1 * 8 + i0] * (1 - u) + m[j1 * 8 + i1] * u) * v, 9) AS value FROM c"""


def plume_pipeline(spark, sf_dir):
    """The whole plume pipeline on small images of each vector, with a transmittance table of its own: checked in the tests."""
    cells = F.sequence(F.lit(0), F.lit(24 * 24 - 1))
    wide = lambda prob: F.transform(cells, lambda i: F.get(prob, (F.floor(F.floor(i / 24) / 3) * 8 + F.floor(i % 24 / 3)).cast("int")))
    band = lambda w, k: F.transform(w, lambda p, i: 1000 + p * 300 + (i * (37 + k)) % 50)
    image = lambda w: F.flatten(F.array(*(band(w, k) for k in range(6))))
    shown = lambda w, im: F.struct(im.alias("target"), F.when(F.col("id") % 7 > 0, F.transform(im, lambda v, i: v + i % 3)).alias("background"), F.transform(w, lambda p: F.when(p > 0.55, 0.9).otherwise(p / 2)).alias("prob"))
    made = let(F.col("prob"), lambda prob: let(wide(prob), lambda w: let(image(w), lambda im: shown(w, im))))  # each array computed once a vector
    spread = proxies.rasters(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")  # images are a hundred times a vector
    scenes = spread.select("id", made.alias("m")).select(
        "id", F.lit(24).alias("width"), F.lit(24).alias("height"), "m.target", "m.background",
        F.transform(cells, lambda i: F.lit(True)).alias("valid"), F.array(F.lit(3.0), F.col("id") % 5 + F.lit(0.5)).alias("wind"), F.lit("S2B").alias("satellite"), F.lit(35.0).alias("sun_zenith"), F.lit(5.0).alias("view_zenith"),
        (F.col("id") * 13 % 100).cast("double").alias("clear_percent"), "m.prob",
    )
    scenes = cut(scenes)  # made once, as stored scenes are
    got = plume.detect_plumes(scenes, _transmittances()).select("id", "status", F.round("score", 6).alias("score"), F.explode_outer("plumes").alias("p"))
    return got.select("id", "status", "score", "p.component", "p.pixels", *(F.round(f"p.{c}", 4).alias(c) for c in ("row", "col", "max_probability", "rate", "sigma")))
