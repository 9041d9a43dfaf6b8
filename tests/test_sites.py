"""Clustering, rescoring and coverage."""

import math
import random

import pytest
from pyspark.sql import functions as F

from emberline.operators import cluster, coverage
from emberline.schema import ClusterOptions

COLUMNS = "det_id long, lon double, lat double, date string, mgrs string, scene string, max_b12 double, peak_b11 double, b12_b11_ratio double, radiance double, pixels int, sun_elevation double, sun_azimuth double, glint_score double"


def detections(spark, rows):
    return spark.createDataFrame(
        [(i, lon, lat, date, "T1", f"S{i}", b12, b11, ratio, 1.0, 3, sun, None, None) for i, (lon, lat, date, b12, b11, sun, ratio) in enumerate(rows)], COLUMNS
    )


def seen(b12, b11, sun):
    """Ten looks at one place, two in each month from April to August."""
    return [(51.3, 24.7, f"2023-{m:02d}-{d:02d}", b12, b11, sun, None) for m in range(4, 9) for d in (3, 19)]


def test_glint_and_flare(spark):
    r = cluster.cluster(detections(spark, seen(1.26, 1.2, 58.0))).first()
    assert r.median_b12_b11_ratio == pytest.approx(1.05) and r.min_sun_elevation == 58 and r.likely_glint and r.seasonal and r.date_count == 10
    r = cluster.cluster(detections(spark, seen(1.1, 0.55, 58.0))).first()
    assert r.median_b12_b11_ratio == pytest.approx(2) and not r.likely_glint
    r = cluster.cluster(detections(spark, [(*x[:4], None, None, None) for x in seen(1.1, 0, 0)[:5]])).first()
    assert (r.median_b12_b11_ratio, r.min_sun_elevation, r.likely_glint) == (None, None, None)
    assert [cluster.cluster(detections(spark, seen(1.2, b11, 50.0))).first().likely_glint for b11 in (0.95, 0.97)] == [False, True]


def test_observations_and_threshold(spark):
    sites = cluster.cluster(detections(spark, seen(1.1, 0.5, 58.0)), ClusterOptions(observations=10))
    r = sites.first()
    assert r.ratio_score == 1 and r.persistence_score == 1 and 0 < r.total_score <= 0.9
    assert [cluster.set_observations(sites, F.lit(n)).first().persistence for n in (40, 3)] == [0.25, 1.0]
    glint = detections(spark, seen(0.95, 0.95, 15.0))
    assert cluster.cluster(glint, ClusterOptions(score_threshold=0.45)).count() == 0 and cluster.cluster(glint).count() == 1
    empty = glint.where("false")
    assert cluster.cluster(empty).count() == 0


def test_infinite_ratio_falls_back(spark):
    r = cluster.cluster(detections(spark, [(*x[:6], float("inf")) for x in seen(1.2, 0.75, 58.0)])).first()
    assert r.max_ratio == pytest.approx(1.6)


def sequential(rows, metres=135.0):
    cell = metres / cluster.DEGREE
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][3], rows[i][2], f"S{i}", rows[i][0], rows[i][1], i))
    anchors, out = [], {}
    for i in order:
        lon, lat = rows[i][:2]
        best, least = i, math.inf
        for j in anchors:
            x, y = rows[j][:2]
            if abs(math.floor(lat / cell) - math.floor(y / cell)) > 1 or abs(math.floor(lon / cell) - math.floor(x / cell)) > 1:
                continue
            d = 6371000 * math.hypot(math.radians(x - lon) * math.cos(math.radians((lat + y) / 2)), math.radians(y - lat))
            if d <= metres and d < least:
                best, least = j, d
        if best == i:
            anchors.append(i)
        out[i] = best
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sites_equal_the_sequential_pass(spark, seed):
    """Spread places, places far north, and few places that many dates see."""
    rng = random.Random(seed)
    lat = 62.0 if seed == 2 else 25.0
    step = lambda: rng.randrange(9) * 4e-4 if seed == 3 else rng.random() * 0.01
    rows = [(51 + step(), lat + step(), f"2024-01-{rng.randint(1, 28):02d}", round(0.5 + rng.random(), 1), 0.5, 40.0) for _ in range(250)]
    df = detections(spark, [(*r, None) for r in rows]).repartition(3)
    assert {r.det_id: r.site for r in cluster.assign_sites(df).collect()} == sequential(rows)
    assert cluster.assign_sites(df.withColumn("lon", F.lit(None).cast("double"))).count() == 0


@pytest.mark.parametrize(("cells", "most"), [(64, 20_000), (2, 20_000), (64, 30)])
def test_chains_and_crowds(spark, monkeypatch, cells, most):
    """A long chain of falling brightness, a crowd within a few cells, scattered places; with tiny blocks and limits, too. Rounds follow blocks, not the chain."""
    monkeypatch.setattr(cluster, "BLOCK_CELLS", cells)
    monkeypatch.setattr(cluster, "BLOCK_PLACES", most)
    rng = random.Random(cells + most)
    rows = [(51 + i * 9e-4, 25.0 + (i % 2) * 1e-5, "2024-01-01", 5 - i * 1e-3, 0.5, 40.0) for i in range(400 if cells > 2 and most > 30 else 60)]
    rows += [(51.5 + rng.random() * 5e-3, 26 + rng.random() * 5e-3, "2024-01-02", round(rng.random(), 2), 0.5, 40.0) for _ in range(150)]
    rows += [(51 + rng.random(), -3 + rng.random() * 0.02, "2024-01-03", round(rng.random(), 2), 0.5, 40.0) for _ in range(100)]
    df = detections(spark, [(*r, None) for r in rows]).repartition(3)
    assert {r.det_id: r.site for r in cluster.assign_sites(df).collect()} == sequential(rows)
    if len(rows) == 650:
        cell = 135.0 / cluster.DEGREE
        key = F.struct((-F.col("max_b12")).alias("b"), "date", "scene", "lon", "lat", "det_id").alias("key")
        places = df.select("det_id", "lon", "lat", key, F.floor(F.col("lat") / cell).alias("r"), F.floor(F.col("lon") / cell).alias("c"))
        anchors, rounds = cluster.anchors_of(places, 135.0)
        assert anchors.count() == len(set(sequential(rows).values())) and rounds <= 8


@pytest.mark.parametrize("most", [20_000, 30])
def test_sites_by_distance_alone(spark, monkeypatch, most):
    """Without cells the distance alone counts, at any latitude and beside the pole, and parts share no site."""
    monkeypatch.setattr(cluster, "BLOCK_CELLS", 2)
    monkeypatch.setattr(cluster, "BLOCK_PLACES", most)
    rng = random.Random(most)
    rows = [(51 + n % 3 * 0.01 + rng.randrange(5) * 4e-4, lat + rng.randrange(3) * 4e-4, "2024-01-01", round(rng.random(), 2), 0.5, 40.0) for lat in (25.0, 62.0, -75.0, 86.5, 89.9992) for n in range(40)]
    df = detections(spark, [(*r, None) for r in rows]).withColumn("user", F.col("det_id") % 2).repartition(3)
    order, anchors, expected = sorted(range(len(rows)), key=lambda i: (-rows[i][3], rows[i][2], f"S{i}", rows[i][0], rows[i][1], i)), [], {}
    for i in order:
        lon, lat = rows[i][:2]
        far = {j: 6371000 * math.hypot(math.radians(rows[j][0] - lon) * math.cos(math.radians((lat + rows[j][1]) / 2)), math.radians(rows[j][1] - lat)) for j in anchors if j % 2 == i % 2}
        cell = 135.0 / cluster.DEGREE
        near = [(round(d, 6), math.floor(rows[j][1] / cell), math.floor(rows[j][0] / cell), order.index(j), j) for j, d in far.items() if d <= 135.0]
        if not near:
            anchors.append(i)
        expected[i] = min(near)[-1] if near else i
    assert {r.det_id: r.site for r in cluster.assign_sites(df, within="user", cells=False).collect()} == expected


def test_cover(spark):
    sites = spark.createDataFrame([("a", 51.0, 25.0), ("b", 53.0, 25.0)], "site string, lon double, lat double")
    from emberline.functions import geo

    at = sites.select(geo.wgs84_to_utm("lon", "lat", F.lit(39), F.lit(True)).alias("u")).first().u
    x, y = at.easting - 210, at.northing - 190
    scenes = spark.createDataFrame([("2024-01-01", "s", 32639, 20, 20, x, y, x + 400, y + 400, 50.9, 24.9, 51.1, 25.1, [6] * 400)], "date string, scene string, epsg int, width int, height int, min_x double, min_y double, max_x double, max_y double, w double, s double, e double, n double, scl array<int>")
    rows = coverage.cover_sites(sites, scenes).collect()
    assert len(rows) == 1 and rows[0].site == "a" and rows[0].valid == 25 and rows[0].hist[6] == 25 and rows[0].cloud_frac == 0
    cells = coverage.grid_sites(spark.createDataFrame([(51.0, 25.0, 51.002, 25.001)], "w double, s double, e double, n double")).collect()
    assert len(cells) == 6 and cells[0].cell == "51.000,25.000"


SCENE = "date string, scene string, epsg int, width int, height int, min_x double, min_y double, max_x double, max_y double, w double, s double, e double, n double, scl array<int>"


def join_rows(df):
    """Rows that the joins of a finished query gave, rising."""
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind.startswith("AdaptiveSparkPlan"):
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        else:
            left += [node.children().apply(i) for i in range(node.children().size())]
        if "Join" in kind:
            found.append(node.metrics().get("numOutputRows").get().value())
    return sorted(found)


def test_cover_counts_a_window_once(spark):
    """Places are compared once a grid, not once a scene, and windows counted once a pixel, not once a site."""
    sites = spark.createDataFrame([(i, 51.0 + i * 1e-6, 25.0) for i in range(40)], "site int, lon double, lat double")
    scenes = spark.createDataFrame([("2024-01-01", f"s{i}", 32639, 20, 20, 499810.0, 2764810.0, 500210.0, 2765210.0, 50.9, 24.9, 51.1, 25.1, [6] * 400) for i in range(30)], SCENE)
    df = coverage.cover_sites(sites, scenes)
    assert len(df.collect()) == 1200
    *before, last = join_rows(df)
    assert last == 1200 and before and max(before) <= 40


def test_cover_equals_a_plain_pass(spark):
    """Two grids, windows over edges, nulls in rasters, no raster, a repeated scene, sites with columns named like scenes'."""
    rng = random.Random(8)
    from emberline.functions import geo

    places = [(i, 51.0 + rng.random() * 0.006, 25.0 + rng.random() * 0.006, 0.5, 7) for i in range(60)]
    sites = spark.createDataFrame(places, "site int, lon double, lat double, w double, width int")
    grids = [(32639, 9, 6, 500000.0, 2764900.0, 500450.0, 2765500.0), (32639, 4, 5, 500200.0, 2765000.0, 500600.0, 2765500.0)]
    raster = lambda g: [rng.choice([None, *range(12), 0, 0]) for _ in range(g[1] * g[2])]
    rows = [("2024-01-01", f"s{i}", *(g := grids[i % 2]), 50.99, 24.99, 51.02, 25.02, raster(g)) for i in range(6)]
    rows += [rows[0], ("2024-01-01", "none", *grids[0], 50.99, 24.99, 51.02, 25.02, None), ("2024-01-01", "empty", *grids[0], 50.99, 24.99, 51.02, 25.02, [0] * 54)]
    expected = []
    at = {r.site: r.u for r in sites.select("site", geo.wgs84_to_utm("lon", "lat", F.lit(39), F.lit(True)).alias("u")).collect()}
    for site in at:
        for _, scene, _, width, height, x0, y0, x1, y1, *_, scl in rows:
            c, r = math.floor((at[site].easting - x0) / ((x1 - x0) / width)), math.floor((y1 - at[site].northing) / ((y1 - y0) / height))
            if scl is None or not (0 <= c < width and 0 <= r < height):
                continue
            seen = [scl[y * width + x] if 0 <= x < width and 0 <= y < height else 0 for y in range(r - 2, r + 3) for x in range(c - 2, c + 3)]
            hist = [seen.count(k) for k in range(12)]
            if sum(hist[1:]):
                expected.append((site, scene, hist, sum(hist[1:]), round((hist[3] + hist[8] + hist[9] + hist[10]) / sum(hist[1:]), 9), 0.5, 7))
    got = [(r.site, r.scene, r.hist, r.valid, round(r.cloud_frac, 9), r.w, r.width) for r in coverage.cover_sites(sites, spark.createDataFrame(rows, SCENE)).collect()]
    assert len(got) > 100 and sorted(got) == sorted(expected)


def test_clear_dates_and_rescore(spark):
    sites = cluster.cluster(detections(spark, seen(1.1, 0.5, 58.0)), ClusterOptions(observations=10))
    cloud = lambda rows: spark.createDataFrame(rows, "i long, j long, date string, cloud_frac double")
    own = cloud([(51300, 24700, "2024-01-01", 0.05), (51300, 24700, "2024-01-02", 0.5), (51301, 24700, "2024-01-03", 0.0)])
    assert coverage.rescore(sites, own).first().n_observed == 11
    near = cloud([(51300, 24700, "2024-01-02", 0.5), (51301, 24700, "2024-01-03", 0.0), (51301, 24701, "2024-01-04", 0.0)])
    assert coverage.rescore(sites, near).first().n_observed == 12
    none = cloud([(0, 0, "2024-01-02", 0.0)])
    assert coverage.rescore(sites, none).first().persistence == 1.0 and coverage.rescore(sites, none, always=True).first().n_observed == 10
