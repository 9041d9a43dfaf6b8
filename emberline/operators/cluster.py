"""Detections of many dates grouped into persistent sites."""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions import geo, scoring
from emberline.functions.text import site_id
from emberline.schema import ClusterOptions
from emberline.work import cut

#: Metres of a degree, for the cells that detections are sorted into.
DEGREE = 111320.0
#: Less than the metres of a degree on the sphere of distances, so that rows of the search grid are no lower than the reach.
ROW_DEGREE = 111190.0
#: Rows along a block's side, and places that are settled in one.
BLOCK_CELLS, BLOCK_PLACES = 64, 20_000


def _row(lat: Column, metres: float) -> Column:
    return F.floor(lat / (metres / ROW_DEGREE))


def _reach_degrees(row: Column, metres: float, rows: int = 1) -> Column:
    """Degrees of longitude that ``metres`` take at most in a strip of ``rows`` rows and the rows beside it; 360 around the poles."""
    step = metres / ROW_DEGREE
    least = F.abs(F.cos(F.radians((row + 0.5) * (rows * step)))) - math.radians((rows / 2 + 1) * step)
    return F.least(step / F.greatest(least, F.lit(1e-6)), F.lit(360.0))


def _own_cell(lon: Column, lat: Column, metres: float, rows: int = 1) -> Column:
    """struct(y, x): the cell of a place in strips of ``rows`` rows. Columns widen towards the poles, strip by strip, so that cells keep their size in metres."""
    strip = F.floor(_row(lat, metres) / rows)
    return F.struct(strip.alias("y"), F.floor(lon / (_reach_degrees(strip, metres, rows) * rows)).alias("x"))


def _cells_in_reach(lon: Column, lat: Column, metres: float, rows: int = 1) -> Column:
    """array<struct(y, x)>: the cells of :func:`_own_cell` that hold every place within ``metres``, its own among them: a few at any latitude."""
    row = _row(lat, metres)
    reach = _reach_degrees(row, metres)

    def strip(y: Column) -> Column:
        width = _reach_degrees(y, metres, rows) * rows
        return F.transform(F.sequence(F.floor((lon - reach) / width), F.floor((lon + reach) / width)), lambda x: F.struct(y.alias("y"), x.alias("x")))

    return F.flatten(F.transform(F.sequence(F.floor((row - 1) / rows), F.floor((row + 1) / rows)), strip))


def _in_reach(points: DataFrame, anchors: DataFrame, metres: float, cells: bool) -> DataFrame:
    """(a, ka, b, how): points (a, key ka) and anchors of the same part in reach, by an equi-join on the cells around a point.

    Both carry det_id, key, part, lon, lat, r, c. how = struct(d, r, c, key) orders a point's anchors: the nearest first, in
    a tie the one whose cell comes first, then the brighter. With ``cells``, only anchors in the 3 x 3 cells (r, c) around
    a point are in reach; without, all within ``metres``, and distances that are equal to the micrometre tie.
    """
    near = points.select(F.col("det_id").alias("a"), F.col("key").alias("ka"), "part", F.col("lon").alias("xa"), F.col("lat").alias("ya"), F.col("r").alias("ra"), F.col("c").alias("ca"), F.explode(_cells_in_reach(F.col("lon"), F.col("lat"), metres)).alias("cell"))
    far = anchors.select(F.col("det_id").alias("b"), F.col("key").alias("kb"), "part", F.col("lon").alias("xb"), F.col("lat").alias("yb"), "r", "c", _own_cell(F.col("lon"), F.col("lat"), metres).alias("cell"))
    met = near.join(far, ["part", "cell"]).withColumn("d", geo.distance_m("ya", "xa", "yb", "xb")).where(F.col("d") <= metres)
    if cells:
        met = met.where((F.abs(F.col("r") - F.col("ra")) <= 1) & (F.abs(F.col("c") - F.col("ca")) <= 1))
    else:
        met = met.withColumn("d", F.round("d", 6))
    return met.select("a", "ka", "b", F.struct("d", "r", "c", F.col("kb").alias("key")).alias("how"))


def _settle(rows: pd.DataFrame, metres: float, cells: bool) -> pd.DataFrame:
    """(det_id, state) of a block's own places that its rows decide: 1 anchors, 2 members.

    rows: the block's open places (own) and, from it and its rim, other open places and known anchors. In the order of
    their keys, a place with an anchor in reach is a member; one with an undecided place in reach waits; any other is an anchor.
    """
    rows = rows.sort_values(["b", "date", "scene", "lon", "lat", "det_id"])
    step = metres / ROW_DEGREE
    anchors, waiting, widths = defaultdict(list), defaultdict(list), {}

    def width(row: int) -> float:
        if row not in widths:
            widths[row] = min(step / max(abs(math.cos(math.radians((row + 0.5) * step))) - math.radians(1.5 * step), 1e-6), 360.0)
        return widths[row]

    def meets(held: dict[tuple, list[tuple]], part: str, row: int, r: int, c: int, x: float, y: float) -> bool:
        reach = width(row)
        for near in (row - 1, row, row + 1):
            wide = width(near)
            for column in range(math.floor((x - reach) / wide), math.floor((x + reach) / wide) + 1):
                for u, v, rv, cu in held.get((part, near, column), ()):
                    if cells and (abs(rv - r) > 1 or abs(cu - c) > 1):
                        continue
                    dx, dy = math.radians(u - x) * math.cos(math.radians((y + v) / 2)), math.radians(v - y)
                    if geo.EARTH_RADIUS * math.sqrt(dx * dx + dy * dy) <= metres:
                        return True
        return False

    decided = []
    for own, state, part, r, c, x, y, name in zip(*(rows[k].tolist() for k in ("own", "state", "part", "r", "c", "lon", "lat", "det_id"))):
        row = math.floor(y / step)
        if own:
            state = 2 if meets(anchors, part, row, r, c, x, y) else 0 if meets(waiting, part, row, r, c, x, y) else 1
            if state:
                decided.append((name, state))
        if state < 2:
            (anchors if state else waiting)[part, row, math.floor(x / width(row))].append((x, y, r, c))
    return pd.DataFrame(decided, columns=["det_id", "state"]).astype({"state": "int32"})


def _anchor_round(open_: DataFrame, metres: float, cells: bool) -> tuple[DataFrame, DataFrame]:
    """(anchors, open places left) after one round of joins: a place that is the brightest of all cells in its reach is an anchor, what it reaches a member."""
    least = open_.groupBy("part", _own_cell(F.col("lon"), F.col("lat"), metres).alias("cell")).agg(F.min("key").alias("k"))
    around = least.select("part", "k", F.explode(_cells_in_reach(F.col("k.lon"), F.col("k.lat"), metres)).alias("cell"))
    beside = around.join(least.withColumnRenamed("k", "near"), ["part", "cell"]).groupBy("k").agg(F.min("near").alias("near"))
    top = beside.where("k = near").select(F.col("k.det_id").alias("det_id"))
    anchors = cut(open_.join(top, "det_id", "left_semi"))
    reached = _in_reach(open_, anchors, metres, cells).select(F.col("a").alias("det_id")).distinct()
    return anchors, cut(open_.join(reached, "det_id", "left_anti"))


def anchors_of(places: DataFrame, metres: float, cells: bool = True) -> tuple[DataFrame, int]:
    """(anchors among ``places``, rounds): the first maximal independent set of the places in reach of each other, in the order of their keys.

    places: det_id, key, lon, lat, cells r, c and, unless all belong together, part; each place once. Blocks of BLOCK_CELLS
    rows and about as many columns are settled on their own, as far as their own places and the rim around them decide;
    what waits for a place of another block takes part in the next round, with that block's new anchors. So rounds grow with
    the blocks that a chain of falling brightness crosses, not with its length, and pairs of places are never listed.
    Blocks of more than BLOCK_PLACES places first lose what their brightest places reach, in rounds of joins.
    """
    if "part" not in places.columns:
        places = places.withColumn("part", F.lit(""))
    own_block = lambda: _own_cell(F.col("lon"), F.col("lat"), metres, BLOCK_CELLS)
    anchors, open_, rounds = places.where("false"), places, 0
    while (open_.groupBy(own_block()).count().agg(F.max("count")).first()[0] or 0) > BLOCK_PLACES:
        new, open_ = _anchor_round(open_, metres, cells)
        anchors, rounds = anchors.unionByName(new), rounds + 1
    columns = ["det_id", "part", "lon", "lat", "r", "c", "key.b", "key.date", "key.scene"]
    schema = f"det_id {places.schema['det_id'].dataType.simpleString()}, state int"
    while not open_.isEmpty():
        rows = open_.select(*columns, F.lit(0).alias("state")).unionByName(anchors.select(*columns, F.lit(1).alias("state")))
        spread = rows.withColumn("block", F.explode(_cells_in_reach(F.col("lon"), F.col("lat"), metres, BLOCK_CELLS)))
        spread = spread.withColumn("own", (F.col("state") == 0) & (F.col("block") == own_block()))
        busy = open_.select(own_block().alias("block")).distinct()
        decided = cut(spread.join(busy, "block", "left_semi").groupBy("block").applyInPandas(lambda f: _settle(f, metres, cells), schema))
        new = open_.join(decided.where("state = 1").select("det_id"), "det_id", "left_semi")
        anchors, open_, rounds = cut(anchors.unionByName(new)), cut(open_.join(decided.select("det_id"), "det_id", "left_anti")), rounds + 1
    return anchors, rounds


def assign_sites(detections: DataFrame, metres: float = 135.0, within: str | None = None, cells: bool = True) -> DataFrame:
    """``detections`` (with a unique det_id) with site: the det_id of the anchor that each belongs to.

    Brightest first, a detection joins the nearest earlier anchor within ``metres`` and the 3 x 3 cells around it, or
    becomes one. Ties in brightness fall to date, scene, place, id. Detections without a place are left out. Cells have
    equal degrees, so that towards the poles they keep places apart that are within ``metres``; without ``cells`` the
    distance alone counts. Detections that differ in the column ``within`` never share a site.

    Whether a place holds an anchor depends on the brightest detection there, so the search runs on distinct places,
    however many dates saw them (:func:`anchors_of`). Anchors keep apart, so few are in reach of a place; each detection
    takes the first of these that is earlier than itself. No group is gathered but a place's anchors.
    """
    cell = metres / DEGREE
    key = F.struct((-F.col("max_b12")).alias("b"), "date", "scene", "lon", "lat", "det_id")
    part = F.coalesce(F.concat(F.lit("="), F.col(within).cast("string")), F.lit("")) if within else F.lit("")
    keyed = detections.where("lon is not null and lat is not null").withColumn("_part", part)
    places = keyed.groupBy(F.col("_part").alias("part"), "lon", "lat").agg(F.min(key).alias("key")).withColumns({"det_id": F.col("key.det_id"), "r": F.floor(F.col("lat") / cell), "c": F.floor(F.col("lon") / cell)})
    places = cut(places)
    anchors, _ = anchors_of(places, metres, cells)
    reach = _in_reach(places, anchors, metres, cells).groupBy("a").agg(F.array_sort(F.collect_list(F.struct("how", "b"))).alias("anchors"))
    listed = places.select(F.col("part").alias("_part"), "lon", "lat", F.col("det_id").alias("a")).join(reach, "a").select("_part", "lon", "lat", "anchors")
    own = keyed.withColumn("_key", key).join(listed, ["_part", "lon", "lat"])
    first = F.get(F.filter("anchors", lambda x: x["how"]["key"] <= F.col("_key")), F.lit(0))
    return own.withColumn("site", first["b"]).select(*detections.columns, "site")


def best_per_date(detections: DataFrame, site: str = "site") -> DataFrame:
    """The brightest detection of each site and date; ties as in :func:`assign_sites`."""
    best = Window.partitionBy(site, "date").orderBy(F.desc("max_b12"), "scene", "lon", "lat", "det_id")
    return detections.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def _id_text(lat: Column, lon: Column) -> Column:
    """Coordinates with four digits behind the point."""
    return F.format_string("%.4f,%.4f", lat, lon)


def summarise(best: DataFrame, options: ClusterOptions, site: str = "site") -> DataFrame:
    """One row per site of detections that are the best of their dates (schema of the cluster view)."""
    ratio = scoring.peak_ratio(F.col("b12_b11_ratio"), F.col("max_b12"), F.col("peak_b11"))
    glint = F.coalesce(scoring.glint_score(F.col("sun_elevation")), scoring.finite(F.col("glint_score")))
    top = F.struct((-F.col("max_b12")).alias("b"), "date", "scene", "lon", "lat")
    one = F.struct("date", "max_b12", "peak_b11", "pixels", "radiance", "sun_elevation", "sun_azimuth", "lon", "lat")
    seen = options.observations
    n = F.col("date_count")
    sites = best.groupBy(site).agg(
        F.min_by("mgrs", top).alias("mgrs"), F.min_by("lon", top).alias("lon"), F.min_by("lat", top).alias("lat"),
        F.max("max_b12").alias("max_b12"), F.avg("max_b12").alias("avg_b12"), F.coalesce(F.median("radiance"), F.lit(0.0)).alias("radiance"),
        F.count("*").alias("date_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.bool_and(scoring.in_season(F.col("date"))).alias("seasonal"),
        F.median(F.when(F.col("peak_b11") > 0, F.col("max_b12") / F.col("peak_b11"))).alias("median_b12_b11_ratio"),
        F.min("sun_elevation").alias("min_sun_elevation"), F.max(ratio).alias("max_ratio"), F.min(glint).alias("min_glint"),
        F.array_sort(F.collect_list(one)).alias("detections"),
    )
    if options.merge_distance:
        sites = sites.where((n >= options.min_dates) & (F.col("avg_b12") >= options.min_avg_b12))
    else:
        sites = sites.where(F.col("max_b12") >= options.min_avg_b12)
    sites = sites.withColumns(scoring.scores(F.col("max_ratio"), n, F.lit(seen or 0), F.col("min_glint")))
    if options.score_threshold > 0:
        sites = sites.where(F.col("total_score") >= options.score_threshold)
    return sites.withColumns(
        {
            "id": site_id(_id_text(F.col("lat"), F.col("lon"))),
            "detection_count": n,
            "persistence": (n / seen) if seen else F.lit(None).cast("double"),
            "likely_glint": F.col("median_b12_b11_ratio") < scoring.GLINT_RATIO,
            "glint_suspect": scoring.glint_suspect(F.col("min_glint"), F.col("max_ratio"), n),
        }
    )


def cluster(detections: DataFrame, options: ClusterOptions | None = None) -> DataFrame:
    """Scored sites of ``detections``. Without a merge distance every detection is a site of its own."""
    options = options or ClusterOptions()
    if not options.merge_distance:
        return summarise(detections.withColumn("site", F.col("det_id")), options)
    return summarise(best_per_date(assign_sites(detections, options.merge_distance)), options)


def set_observations(sites: DataFrame, looks: Column) -> DataFrame:
    """Sites rescored with their number of clear looks, which is at least their number of dates."""
    n = F.greatest(looks, F.col("date_count"))
    return sites.withColumn("n_observed", n).withColumns(
        {"persistence": F.try_divide(F.col("date_count"), n), **scoring.scores(F.col("max_ratio"), F.col("date_count"), n, F.col("min_glint"))}
    )
