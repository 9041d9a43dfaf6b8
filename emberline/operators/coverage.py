"""Clear-sky looks: sampling of scene classes, the cloud mask, rescoring of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import geo, pixels, scoring
from emberline.functions.binding import let
from emberline.operators.cluster import set_observations

#: Half width in pixels of the window around a site; the same for the finer cloud classes of chips.
HALF, CHIP_HALF = 2, 5


def grid_sites(boxes: DataFrame) -> DataFrame:
    """(… i, j, lon, lat, cell): the grid cells that tile each box (w, s, e, n), by rows."""
    span = lambda a, b: F.explode(F.sequence(geo.cell_index(a), geo.cell_index(b)))
    cells = boxes.withColumn("j", span("s", "n")).withColumn("i", span("w", "e"))
    placed = cells.withColumns({"lon": F.col("i") / geo.GRID_CELLS, "lat": F.col("j") / geo.GRID_CELLS})
    return placed.withColumn("cell", geo.cell_key("lon", "lat"))


def cover_sites(sites: DataFrame, scenes: DataFrame) -> DataFrame:
    """(site columns, date, scene, hist, valid, cloud_frac): classes around each site in each scene that holds it.

    scenes: date, scene, epsg, width, height, min_x, min_y, max_x, max_y, w, s, e, n (degrees), scl. Scenes of one tile share
    its pixel grid, so sites meet the distinct grids, by the whole degrees that a grid's box touches, an equi-join, before places
    are compared. A scene's raster then meets the distinct pixels of its grid that hold sites, and the windows there their sites:
    a window is counted once, however many sites lie in its pixel. Scenes and pixels are spread over tasks by themselves, as the
    stored rasters may lie in few tasks and one grid may hold all scenes.
    """
    parts = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = F.struct("epsg", "width", "height", "min_x", "min_y", "max_x", "max_y", *(F.floor(c).alias(c) for c in "wsen"))
    held = scenes.select("date", "scene", "scl", grid.alias("_g"))
    touched = lambda a, b: F.explode(F.sequence(F.col(f"_g.{a}"), F.col(f"_g.{b}")))
    spread = held.select("_g").distinct().withColumn("_x", touched("w", "e")).withColumn("_y", touched("s", "n"))
    at = geo.wgs84_to_utm("lon", "lat", geo.utm_zone("_g.epsg"), geo.utm_is_north("_g.epsg"))
    keyed = sites.withColumns({"_x": F.floor("lon"), "_y": F.floor("lat")})
    met = keyed.join(spread, ["_x", "_y"]).withColumn("_at", at)
    col = F.floor((F.col("_at.easting") - F.col("_g.min_x")) / ((F.col("_g.max_x") - F.col("_g.min_x")) / F.col("_g.width"))).cast("int")
    row = F.floor((F.col("_g.max_y") - F.col("_at.northing")) / ((F.col("_g.max_y") - F.col("_g.min_y")) / F.col("_g.height"))).cast("int")
    placed = met.withColumns({"_c": col, "_r": row}).where("_c >= 0 and _r >= 0 and _c < _g.width and _r < _g.height")
    placed = placed.select(*sites.columns, "_g", "_c", "_r")
    pixel = ("_g", "_c", "_r")
    looks = held.repartition(parts, "date", "scene").join(placed.select(*pixel).repartition(parts, *pixel).distinct(), "_g")
    low = lambda c: F.greatest(F.col(c) - HALF, F.lit(0))
    high = lambda c, end: F.least(F.col(c) + HALF + 1, F.col(end).cast("int"))
    x0, y0, x1, y1 = low("_c"), low("_r"), high("_c", "_g.width"), high("_r", "_g.height")
    beyond = (2 * HALF + 1) ** 2 - (x1 - x0) * (y1 - y0)  # cells outside of the image read as class 0, which has no data
    counts = pixels.histogram(pixels.window(F.col("scl"), F.col("_g.width").cast("int"), x0, y0, x1, y1))
    hist = F.transform(counts, lambda n, k: n + F.when(k == pixels.NO_DATA, beyond).otherwise(0))
    valid = lambda h: F.aggregate(F.slice(h, 2, pixels.CLASSES - 1), F.lit(0), lambda a, x: a + x)
    seen = let(hist, lambda h: F.struct(h.alias("hist"), valid(h).alias("valid"), pixels.histogram_cloud_fraction(h).alias("cloud_frac")))
    # a filter of rows would count each window a second time, in the join
    looks = looks.select("date", "scene", *pixel, F.explode(F.filter(F.array(seen), lambda v: v["valid"] > 0)).alias("_seen"))
    return looks.join(placed, list(pixel)).select(*sites.columns, "date", "scene", "_seen.hist", "_seen.valid", "_seen.cloud_frac")


def chip_cell_fractions(chips: DataFrame) -> DataFrame:
    """(scene, cell, fraction): share of obscured pixels among observed ones (blue not 0) around each cell of a chip.

    chips: scene, width, height, blue array<int>, class array<int> (0 clear), cells array<struct<cell, col, row>>.
    """
    one = chips.withColumn("c", F.explode("cells"))
    size = 2 * CHIP_HALF + 1
    window = lambda a: pixels.padded_window(F.col(a), F.col("width"), F.col("height"), F.col("c.col") - CHIP_HALF, F.col("c.row") - CHIP_HALF, size)
    seen = F.filter(F.arrays_zip(window("blue").alias("blue"), window("class").alias("class")), lambda p: p["blue"] != 0)
    return (
        one.withColumn("seen", seen).where(F.size("seen") > 0)
        .select("scene", F.col("c.cell").alias("cell"), (F.size(F.filter("seen", lambda p: p["class"] != 0)) / F.size("seen")).alias("fraction"))
    )


def needed_mask(sites: DataFrame, clouds: DataFrame) -> DataFrame:
    """The rows of the cloud mask (i, j, date, cloud_frac) at the sites' 3 x 3 cells, without repeats.

    A semi-join keeps the mask from ever being materialised whole; Spark broadcasts the cells where they are few.
    """
    cells = _around(sites).select("i", "j").distinct()
    return clouds.join(cells, ["i", "j"], "left_semi").distinct()


def _around(sites: DataFrame) -> DataFrame:
    steps = F.explode(F.array(*(F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a in (-1, 0, 1) for b in (-1, 0, 1)))).alias("d")
    placed = sites.select("site", geo.cell_index("lon").alias("ci"), geo.cell_index("lat").alias("cj"), steps)
    return placed.select("site", (F.col("ci") + F.col("d.di")).alias("i"), (F.col("cj") + F.col("d.dj")).alias("j"), ((F.col("d.di") == 0) & (F.col("d.dj") == 0)).alias("own"))


def clear_dates(sites: DataFrame, clouds: DataFrame) -> DataFrame:
    """(site, clear_dates): dates with a clear look in the site's own cell, or, if that has none, in the 3 x 3 cells around."""
    clear = needed_mask(sites, clouds.where(F.col("cloud_frac") <= scoring.CLEAR_MAX)).select("i", "j", "date").distinct()
    met = _around(sites).join(clear, ["i", "j"])
    by_site = met.groupBy("site").agg(F.collect_set(F.when(F.col("own"), F.col("date"))).alias("own"), F.collect_set("date").alias("near"))
    return by_site.select("site", F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("near")).alias("clear_dates"))


def rescore(sites: DataFrame, clouds: DataFrame, always: bool = False) -> DataFrame:
    """Sites rescored by clear looks united with their own dates. Sites without any look stay as they are unless ``always``."""
    looks = sites.join(clear_dates(sites, clouds), "site", "left")
    own = F.transform("detections", lambda d: d["date"])
    n = F.size(F.array_union(own, F.coalesce("clear_dates", F.array().cast("array<string>")))).cast("long")
    if always:
        return set_observations(looks, n).drop("clear_dates")
    kept = ("persistence", "ratio_score", "persistence_score", "glint_penalty", "total_score")
    before = F.struct(*kept)
    seen = set_observations(looks.withColumn("_before", before), n)
    missed = F.col("clear_dates").isNull()
    return seen.withColumns({c: F.when(missed, F.col(f"_before.{c}")).otherwise(F.col(c)) for c in kept}).drop("clear_dates", "_before")
