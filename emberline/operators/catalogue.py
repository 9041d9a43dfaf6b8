"""Catalogues of scenes, facilities and areas: dedup, envelopes, work lists, background choice."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberline.functions.geo import pad_bbox
from emberline.work import cut

#: Background scenes: at least 5 minutes and at most 120 days away, up to this cloud cover; how many; clear shares.
NEAR_S, FAR_S, MOST_CLOUD, BACKGROUNDS, STRICT, LOOSE = 300, 120 * 86400, 95.0, 20, 95.0, 65.0


def dedup_scenes(scenes: DataFrame, most_cloud: float) -> DataFrame:
    """One scene per tile and date: the least cloudy, the first listed (seq) in a tie; then those up to ``most_cloud``.

    The tile is grid_code, else mgrs_tile, else the id; missing cloud cover counts as 100.
    """
    tile = F.coalesce("grid_code", F.concat(F.lit("MGRS-"), F.col("mgrs_tile")), F.col("id").cast("string"))
    cloud = F.coalesce("cloud", F.lit(100.0))
    best = Window.partitionBy("_tile", "date").orderBy(cloud, "seq")
    ranked = scenes.withColumn("_tile", tile).withColumn("_n", F.row_number().over(best))
    return ranked.where((F.col("_n") == 1) & (cloud <= most_cloud)).drop("_n", "_tile")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(index, id, properties map<string,string>, geometry JSON) of the features of a GeoJSON file; other files are read alike, each numbered from 0."""
    texts = spark.read.option("wholetext", True).text(path)
    one = F.from_json(F.get_json_object("value", "$.features"), "array<string>")
    each = texts.select(F.posexplode(one).alias("index", "f"))
    get = lambda p: F.get_json_object("f", p)
    return each.select("index", get("$.id").alias("id"), F.coalesce(F.from_json(get("$.properties"), "map<string,string>"), F.expr("map()").cast("map<string,string>")).alias("properties"), get("$.geometry").alias("geometry"))


def areas(features: DataFrame, pad_km: float = 0.0) -> DataFrame:
    """(id, name, w, s, e, n, properties, geometry) of a FeatureCollection's features: index, id, properties map<string,string>, geometry JSON."""
    box = geometry_bounds(F.col("geometry"))
    some = lambda *names: F.coalesce(*(F.nullif(F.try_element_at("properties", F.lit(x)), F.lit("")) for x in names))
    out = features.select(
        F.coalesce("id", some("id", "ProjectID"), F.col("index").cast("string")).alias("id"),
        F.coalesce(some("name", "TerminalName"), F.lit("")).alias("name"),
        box.alias("box"), "properties", "geometry",
    )
    if pad_km:
        out = out.withColumn("box", pad_bbox("box.w", "box.s", "box.e", "box.n", pad_km))
    return out.select("id", "name", "box.w", "box.s", "box.e", "box.n", "properties", "geometry")


def geometry_bounds(geometry: Column) -> Column:
    """struct(w, s, e, n) of the coordinates in a GeoJSON geometry, however deep they nest: positions are the innermost lists."""
    positions = F.regexp_extract_all(geometry, F.lit(r"\[\s*(-?[0-9][^\[\],]*,\s*-?[0-9][^\[\],]*)[^\[\]]*\]"), F.lit(1))
    number = lambda p, i: F.trim(F.split(p, ",")[i]).cast("double")
    x, y = F.transform(positions, lambda p: number(p, 0)), F.transform(positions, lambda p: number(p, 1))
    return F.struct(F.array_min(x).alias("w"), F.array_min(y).alias("s"), F.array_max(x).alias("e"), F.array_max(y).alias("n"))


def envelopes(units: DataFrame, pad: float = 0.02) -> DataFrame:
    """One row per project of facility units (project, name, status, capacity, lon, lat): box, units, capacity."""
    return units.groupBy("project").agg(
        F.min("name").alias("name"), F.round(F.sum("capacity"), 2).alias("capacity"), F.count("*").alias("units"),
        (F.min("lon") - pad).alias("w"), (F.min("lat") - pad).alias("s"), (F.max("lon") + pad).alias("e"), (F.max("lat") + pad).alias("n"),
    )


def first_per_place(features: DataFrame) -> DataFrame:
    """The first feature by id of each name and place, to two digits."""
    same = Window.partitionBy("name", F.round("lat", 2), F.round("lon", 2)).orderBy("id")
    return features.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")


def parsed_query(text: str) -> Column:
    """The filter of a catalogue query: ``key=value,…`` (all must hold) or a list of ids (any may). Values are literals, never SQL."""
    parts = [p.strip() for p in text.split(",") if p.strip()]
    if parts and all("=" in p for p in parts):
        pairs = [p.split("=", 1) for p in parts]
        out = F.lit(True)
        for k, v in pairs:
            out = out & (F.col(k.strip()).cast("string") == v.strip())
        return out
    return F.col("id").cast("string").isin(parts)


def in_tiles(tiles: list[str] | None, column: str = "mgrs") -> Column:
    """Rows of the named tiles; all rows without names. A leading ``MGRS-`` doesn't matter."""
    return F.regexp_replace(F.col(column), "^MGRS-", "").isin([t.removeprefix("MGRS-") for t in tiles]) if tiles else F.lit(True)


def in_window(start: str | None, end: str | None, box: tuple[float, float, float, float] | None = None) -> Column:
    """Rows with a date from ``start`` to ``end`` and a place in the box (w, s, e, n), ends included; None leaves a side open."""
    out = F.lit(True)
    if start:
        out = out & (F.col("date") >= start)
    if end:
        out = out & (F.col("date") <= end)
    if box:
        w, s, e, n = map(F.lit, box)
        out = out & F.col("lon").between(w, e) & F.col("lat").between(s, n)
    return out


def eligible(scenes: DataFrame, start: str, end: str, most_cloud: float) -> DataFrame:
    return scenes.where(F.col("date").between(start, end) & (F.coalesce("cloud", F.lit(100.0)) <= most_cloud))


def tile_boxes(detections: DataFrame) -> DataFrame:
    """(mgrs, w, s, e, n, detections): the box of each tile's detections."""
    return detections.groupBy("mgrs").agg(F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"), F.count("*").alias("detections"))


def meeting_boxes(left: DataFrame, right: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs of rows whose boxes (w, s, e, n; on the right _w, _s, _e, _n) overlap.

    Boxes meet by the cells they touch; a pair is kept in the cell of its overlap's corner only, so nothing is distinct-ed.
    """
    touched = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
    a = left.withColumn("_i", touched("w", "e")).withColumn("_j", touched("s", "n"))
    b = right.withColumn("_i", touched("_w", "_e")).withColumn("_j", touched("_s", "_n"))
    own = (F.floor(F.greatest("w", "_w") / cell) == F.col("_i")) & (F.floor(F.greatest("s", "_s") / cell) == F.col("_j"))
    overlap = (F.col("w") <= F.col("_e")) & (F.col("_w") <= F.col("e")) & (F.col("s") <= F.col("_n")) & (F.col("_s") <= F.col("n"))
    return a.join(b, ["_i", "_j"]).where(own & overlap).drop("_i", "_j")


def scenes_of_tiles(tiles: DataFrame, scenes: DataFrame) -> DataFrame:
    """Scenes that touch any tile's box, each once."""
    boxes = scenes.withColumnsRenamed({"w": "_w", "s": "_s", "e": "_e", "n": "_n"})
    met = meeting_boxes(tiles.select("w", "s", "e", "n"), boxes).select(*boxes.columns)
    return met.dropDuplicates(["id"]).withColumnsRenamed({"_w": "w", "_s": "s", "_e": "e", "_n": "n"})


def work_list(areas: DataFrame, scenes: DataFrame, done: DataFrame, detector: str, method: str) -> DataFrame:
    """(area, scene) pairs to do: boxes overlap, and no record of the detector and method is complete."""
    pairs = meeting_boxes(areas, scenes.withColumnsRenamed({"w": "_w", "s": "_s", "e": "_e", "n": "_n", "id": "scene"})).select(F.col("id").alias("area"), "scene")
    complete = done.where((F.col("detector") == detector) & (F.col("method") == method)).select("area", "scene")
    return pairs.join(complete, ["area", "scene"], "left_anti")


def background_candidates(targets: DataFrame, scenes: DataFrame) -> DataFrame:
    """(target, id, gap, clear): all scenes of the target's tile within the time limits. For the nearest clear ones see :func:`nearest_backgrounds`.

    Both carry tile and unix time t; scenes id, cloud, clear (percent). Scenes meet targets by tile and 120-day bin, so a
    target sees its own and the neighbouring bins only.
    """
    t = targets.select(F.col("id").alias("target"), "tile", F.col("t").alias("tt"), F.explode(F.sequence(F.floor(F.col("t") / FAR_S) - 1, F.floor(F.col("t") / FAR_S) + 1)).alias("bin"))
    c = scenes.where(F.coalesce("cloud", F.lit(100.0)) <= MOST_CLOUD).withColumn("bin", F.floor(F.col("t") / FAR_S))
    gap = F.abs(F.col("t") - F.col("tt"))
    return t.join(c, ["tile", "bin"]).withColumn("gap", gap).where(F.col("gap").between(NEAR_S, FAR_S)).select("target", "id", "gap", "clear")


def _nearest(at: np.ndarray, times: np.ndarray, ids: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gap, row, there) of the ``few`` nearest rows on either side of each time, 2 * few columns.

    Rows of one time are taken by id on both sides, so the earlier side reads them in an order of their own.
    """
    right, left = np.lexsort((ids, times)), np.lexsort((-ids, times))
    step = np.arange(few)
    ends = np.searchsorted(times[left], at - NEAR_S, "right")[:, None] - 1 - step
    starts = np.searchsorted(times[right], at + NEAR_S, "left")[:, None] + step
    inside = np.concatenate((ends >= 0, starts < len(times)), 1)
    rows = np.concatenate((left[np.maximum(ends, 0)], right[np.minimum(starts, len(times) - 1)]), 1)
    gap = np.abs(times[rows] - at[:, None])
    return gap, rows, inside & (gap <= FAR_S)


#: Tiles of a partition are told apart by so many seconds; targets that are looked at together.
_TILE_S, _TOGETHER = 1 << 44, 1 << 14


def _scan(tile: np.ndarray, t: np.ndarray, ids: np.ndarray, clear: np.ndarray, is_target: np.ndarray, more: pd.DataFrame) -> pd.DataFrame:
    """The chosen backgrounds of the targets of a sorted stretch; ``more`` are scenes from beyond its ends."""
    found = []
    scenes = ~is_target
    names = np.concatenate((tile[scenes], more["tile"].to_numpy(np.int64)))
    known, number = np.unique(np.concatenate((names, tile[is_target])), return_inverse=True)
    times = number[: len(names)] * _TILE_S + np.concatenate((t[scenes], more["t"].to_numpy(np.int64)))
    name, share = np.concatenate((ids[scenes], more["id"].to_numpy(np.int64))), np.concatenate((clear[scenes], more["clear"].to_numpy(float)))
    at, target = number[len(names) :] * _TILE_S + t[is_target], ids[is_target]
    strict = share >= STRICT
    take = lambda x, o: np.take_along_axis(x, o, 1)
    for first in range(0, len(at), _TOGETHER):
        part = slice(first, first + _TOGETHER)
        left = np.ones(len(at[part]), bool)
        for kind in (strict, share >= LOOSE):  # loosely clear ones only where no strictly clear one is there
            todo = np.flatnonzero(left)
            if not len(todo) or not kind.any():
                continue
            gap, near, there = _nearest(at[part][todo], times[kind], name[kind], BACKGROUNDS)
            gap[~there] = FAR_S + 1
            by_id = np.argsort(name[kind][near], axis=1, kind="stable")
            gap, near = take(gap, by_id), take(near, by_id)
            by_gap = np.argsort(gap, axis=1, kind="stable")[:, :BACKGROUNDS]
            gap, near = take(gap, by_gap), take(near, by_gap)
            row, place = np.nonzero(gap <= FAR_S)
            left[todo[row]] = False
            near = near[row, place]
            found.append(pd.DataFrame({"target": target[part][todo[row]], "id": name[kind][near], "place": place + 1, "gap": gap[row, place], "clear": share[kind][near]}))
    return pd.concat(found) if found else pd.DataFrame({"target": [], "id": [], "place": [], "gap": [], "clear": []})


def _edge(tile: np.ndarray, t: np.ndarray, ids: np.ndarray, clear: np.ndarray, at_end: bool) -> list[tuple]:
    """Scenes of the stretch's last (first) tile that targets beyond its end may take: those near the end in time and the BACKGROUNDS strictly and loosely clear ones before them."""
    if not at_end:
        tile, t, ids, clear = tile[::-1], -t[::-1], ids[::-1], clear[::-1]
    rows = np.flatnonzero(tile == tile[-1])
    close = rows[t[rows] > t[rows[-1]] - NEAR_S]
    kept = set(close.tolist())
    for limit in (STRICT, LOOSE):
        fit = rows[(clear[rows] >= limit) & (t[rows] <= t[rows[-1]] - NEAR_S)]
        if len(fit):  # those of the last one's time tie with it
            kept.update(fit[t[fit] >= t[fit[-BACKGROUNDS:][0]]].tolist())
    return [(int(tile[i]), int(t[i]) * (1 if at_end else -1), int(ids[i]), float(clear[i])) for i in sorted(kept) if clear[i] >= LOOSE]


def nearest_backgrounds(targets: DataFrame, scenes: DataFrame) -> DataFrame:
    """(target, id, place, gap, clear): scenes to compare with each target, nearest in time first.

    Of a tile's scenes up to MOST_CLOUD, at least NEAR_S and at most FAR_S away, the BACKGROUNDS nearest strictly clear
    ones, or without any the nearest loosely clear ones; equal gaps fall to the smaller id. Both frames carry tile (long),
    id (long) and unix time t (long); scenes cloud and clear (percent), null clear counts as 0. Targets without a tile or
    time have none.

    Targets and scenes lie in one order by tile and time, over as many tasks as they need, whatever the tile. A task
    walks outward from each target on both sides and stops at BACKGROUNDS scenes a side, so rows touched grow with
    targets times 2 * BACKGROUNDS, not with the scenes within reach. Scenes beyond a task's ends come from the edges of the
    tasks beside it: a few dozen rows a task, which the driver deals out.
    """
    spark = targets.sparkSession
    usable = scenes.where((F.coalesce("cloud", F.lit(100.0)) <= MOST_CLOUD) & (F.col("clear") >= LOOSE))
    kind = lambda df, clear, is_target: df.select(F.col("tile").cast("long"), F.col("t").cast("long"), F.col("id").cast("long"), clear.cast("double").alias("clear"), F.lit(is_target).alias("is_target")).where("tile is not null and t is not null")
    both = kind(targets, F.lit(0.0), True).unionByName(kind(usable, F.col("clear"), False))
    ordered = cut(both.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "tile", "t", "id").sortWithinPartitions("tile", "t", "id"))

    def whole(batches):
        parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(5)] for b in batches]
        return [np.concatenate([p[i] for p in parts]) for i in range(5)] if parts else None

    def edges(batches):
        rows = whole(batches)
        if rows is None:
            return
        tile, t, ids, clear, is_target = rows
        s = ~is_target
        some = [(0, *x) for x in _edge(tile[s], t[s], ids[s], clear[s], False)] + [(1, *x) for x in _edge(tile[s], t[s], ids[s], clear[s], True)] if s.any() else []
        ends = [(2, int(tile[0]), int(t[0]), 0, 0.0), (3, int(tile[-1]), int(t[-1]), 0, 0.0)]
        f = pd.DataFrame([*some, *ends], columns=["side", "tile", "t", "id", "clear"]).astype({"side": np.int32})
        yield pa.RecordBatch.from_pandas(f.assign(part=np.int32(TaskContext.get().partitionId())), preserve_index=False)

    schema = "side int, tile long, t long, id long, clear double, part int"
    beyond = spark.sparkContext.broadcast(_dealt(ordered.mapInArrow(edges, schema).toPandas()))

    def scan(batches):
        rows = whole(batches)
        if rows is None:
            return
        tile, t, ids, clear, is_target = rows
        more = beyond.value.get(TaskContext.get().partitionId(), pd.DataFrame({"tile": [], "t": [], "id": [], "clear": []}))
        out = _scan(tile, t, ids, clear, is_target, more).astype({"target": np.int64, "id": np.int64, "place": np.int32, "gap": np.int64, "clear": float})
        yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    return ordered.mapInArrow(scan, "target long, id long, place int, gap long, clear double")


def _dealt(edges: pd.DataFrame) -> dict[int, pd.DataFrame]:
    """The scenes that each task takes from the tasks beside it: outward while those hold its first (last) tile and enough isn't there."""
    out = {}
    by = {(p, s): g for (p, s), g in edges.groupby(["part", "side"])}
    parts = sorted(edges["part"].unique())
    columns = ["tile", "t", "id", "clear"]
    for n, p in enumerate(parts):
        taken = []
        for end, step, side, far in ((2, -1, 1, 3), (3, 1, 0, 2)):
            own = by[p, end].iloc[0]
            strict = loose = 0
            k = n + step
            while 0 <= k < len(parts) and by[parts[k], far].iloc[0]["tile"] == own["tile"] and abs(by[parts[k], far].iloc[0]["t"] - own["t"]) <= FAR_S and not (strict >= BACKGROUNDS and loose >= BACKGROUNDS):
                some = by.get((parts[k], side))
                if some is not None:
                    some = some[some["tile"] == own["tile"]]
                    taken.append(some[columns])
                    reached = some[(some["t"] - own["t"]).abs() >= NEAR_S]
                    strict, loose = strict + int((reached["clear"] >= STRICT).sum()), loose + len(reached)
                k += step
        if taken:
            out[int(p)] = pd.concat(taken)
    return out


def most_similar(candidates: DataFrame) -> DataFrame:
    """(target, id) with the least similarity distance; the nearest in time, then the smaller id wins a tie, infinite distances never do."""
    finite = candidates.where(F.col("distance") < float("inf"))
    return finite.groupBy("target").agg(F.min_by("id", F.struct("distance", "gap", "id")).alias("id"))


def most_similar_scenes(targets: DataFrame, scenes: DataFrame) -> DataFrame:
    """:func:`most_similar` of the candidates of :func:`background_candidates` where ``distance`` is a column of ``scenes``, without listing pairs.

    targets: id, tile, t (seconds, integers); scenes: id, tile, t, cloud, distance. On either side of a target the best scene
    doesn't depend on the target: least distance, nearest in time, smallest id. Both windows have the same length, so in blocks
    of that length a window is the end of one block and the start of the next: two running minima, each over a block sorted
    once. Rows grow with scenes and targets, not with the scenes within reach.
    """
    length = FAR_S - NEAR_S + 1
    known = scenes.where((F.coalesce("cloud", F.lit(100.0)) <= MOST_CLOUD) & (F.col("distance") < float("inf")))
    best = F.struct(F.col("distance").cast("double").alias("distance"), F.col("t").cast("long").alias("time"), F.col("id").alias("id"))
    late = F.struct(best["distance"].alias("distance"), (-best["time"]).alias("time"), best["id"].alias("id"))
    seen = known.select("tile", F.col("t").cast("long").alias("at"), best.alias("early"), late.alias("late"))
    asked = targets.select(F.col("id").alias("target"), "tile", F.col("t").cast("long").alias("tt"))
    found = []
    for from_start, (before, after) in ((False, (-FAR_S, NEAR_S)), (True, (-NEAR_S, FAR_S))):
        sides = F.explode(F.array(*(F.struct((F.col("tt") + step).alias("at"), F.lit(is_after).alias("after")) for step, is_after in ((before, False), (after, True))))).alias("q")
        both = seen.unionByName(asked.select("target", "tile", "tt", sides).select("target", "tile", "tt", "q.at", "q.after"), allowMissingColumns=True)
        place = F.col("at") if from_start else -F.col("at")
        run = Window.partitionBy("tile", F.floor(F.col("at") / length)).orderBy(place, F.col("tt").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = both.withColumns({"_early": F.min("early").over(run), "_late": F.min("late").over(run)}).where("tt is not null and tile is not null")
        got = F.when(F.col("after"), F.col("_early")).otherwise(F.col("_late"))
        gap = F.when(F.col("after"), got["time"] - F.col("tt")).otherwise(got["time"] + F.col("tt"))
        found.append(met.where(got.isNotNull()).select("target", got["id"].alias("id"), gap.alias("gap"), got["distance"].alias("distance")))
    return most_similar(found[0].unionByName(found[1]))


def upsert(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """``new`` and the rows of ``old`` whose key it lacks."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


def gaps(wanted: DataFrame, scanned: DataFrame, key: str = "id") -> DataFrame:
    """Rows wanted that no shard scanned."""
    return wanted.join(scanned.select(key), key, "left_anti")


def shard(rows: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """Round-robin shards of rows numbered by ``seq``."""
    return rows.withColumn("shard", F.pmod(F.col(seq), F.lit(n)).cast("int"))


def tallies(results: DataFrame) -> DataFrame:
    """Sums of a run's counters."""
    return results.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("scenes", "cached", "flares", "plumes", "errors")))
