"""Records to views and back, catalogues, sinks, the registered queries."""

import json
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from emberline.operators import catalogue
from emberline.plans import catalog
from emberline.schema import DETECTION_VIEW
from emberline.sources import records
from emberline.streaming import views

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def record(scene, features, **more):
    return {"type": "FeatureCollection", "schema": records.SCHEMA_NAME, "analysis": {"detector": "flares", "scene": {"id": scene, "date": "2024-01-02", "mgrs": "31"}, "method": {"fingerprint": "m"}, "target": {"id": "t"}, "area": {"key": "a"}, **more}, "features": features}


def point(lon, **properties):
    return {"type": "Feature", "geometry": {"type": "Point", "coordinates": [lon, 25.5]}, "properties": properties}


@pytest.fixture
def tree(tmp_path):
    one = tmp_path / "observations" / "a" / "s1"
    one.mkdir(parents=True)
    (one / "flares-m.geojson").write_text(json.dumps(record("s1", [point(51.5, max_b12=0.9, peak_b11=0.5, pixels=3, radiance=1.5), point(51.6, max_b12=0.7, max_b11=0.4)]), indent=1))
    (one / "flares-m.err").write_text("late")
    two = tmp_path / "observations" / "a" / "s2"
    two.mkdir(parents=True)
    (two / "flares-m.geojson").write_text(json.dumps(record("s2", [])))
    return tmp_path


def test_views(spark, tree):
    read = records.read_records(spark, f"file://{tree}/observations", "flares-*.geojson")
    view = records.detections_view(read)
    assert view.schema.names == DETECTION_VIEW.names
    rows = {r.lon: r for r in view.collect()}
    assert len(rows) == 2 and rows[51.5].mgrs == "31" and rows[51.5].max_b11 == 0.5 and rows[51.6].max_b11 == 0.4 and rows[51.6].radiance == 0.0
    kept = records.retrievals_view(read, ["t:2024"]).collect()
    assert sorted((r.scene, r.detected, r.valid) for r in kept) == [("s1", True, None), ("s1", True, None), ("s2", False, None)]
    done = records.complete(read).collect()
    assert {(r.detector, r.area, r.scene, r.method) for r in done} == {("flares", "a", "s1", "m"), ("flares", "a", "s2", "m")}
    root = f"file://{tree}/views/detections"
    records.write_detections(view, root)
    again = records.read_detections(spark, root)
    assert sorted(map(str, again.collect())) == sorted(map(str, view.collect()))
    records.write_detections(view, root)
    assert records.read_detections(spark, root).count() == 2
    assert records.any_file(spark, root + "/*") and not records.any_file(spark, root + "x/*")
    assert records.publish(spark, f"file://{tree}/observations", f"file://{tree}/out") == 2
    assert not list((tree / "out").rglob("*.err"))


def test_publish_again(spark, tree):
    """A second run copies only what is new, changed or gone from the target; a run whose manifest is missing is repeated."""
    source, target = tree / "observations", tree / "out"
    (source / "a" / "s 100%").mkdir()
    (source / "a" / "s 100%" / "ü#.json").write_text("{}")
    run = lambda: records.publish(spark, f"file://{source}/", f"file://{target}")
    assert run() == 3 and run() == 0
    assert (target / "a" / "s 100%" / "ü#.json").read_text() == "{}" and not list(target.rglob("*.part"))
    (source / "a" / "s1" / "flares-m.geojson").write_text("changed")
    (target / "a" / "s2" / "flares-m.geojson").unlink()
    (source / "new.json").write_text("")
    assert run() == 3 and (target / "a/s1/flares-m.geojson").read_text() == "changed" and (target / "new.json").read_text() == ""
    assert sorted(r.path for r in records.published(spark, f"file://{target}").select("path").distinct().collect()) == sorted(str(f.relative_to(source)) for f in source.rglob("*.*json"))
    for f in (target / records.MANIFEST).iterdir():
        f.unlink()
    (target / "new.json").write_text("half a copy")
    assert run() == 4 and run() == 0 and (target / "new.json").read_text() == ""
    (tree / "none").mkdir()
    assert records.publish(spark, f"file://{tree}/none", f"file://{tree}/nothing") == 0
    assert records.published(spark, f"file://{tree}/never").count() == 0


def test_commit_and_follow(spark, tree):
    rows = spark.createDataFrame([("x/y/flares-1.geojson", json.dumps(record("s3", [point(52.0, max_b12=0.8)])))], "path string, json string")
    root = f"file://{tree}/observations"
    for _ in range(2):
        records.commit_records(rows, root)
    assert (tree / "observations/x/y/flares-1.geojson").read_text().endswith("}\n") and not list(tree.rglob("*.part"))
    for n in (3, 3):
        views.follow_detections(spark, root, f"file://{tree}/live", f"file://{tree}/state").awaitTermination()
        assert spark.read.parquet(f"file://{tree}/live").count() == n


def test_envelope_and_errors(spark):
    analysis = spark.createDataFrame([("A 1", "{}", ("s", "d"), ("t",), "m", "ok", [])], "area string, area_json string, scene struct<id:string,date:string>, target struct<id:string>, method string, status string, features array<string>")
    r = records.envelope("flares", analysis).first()
    made = json.loads(r.json)
    assert made["features"] == [] and made["analysis"]["scene"]["id"] == "s" and r.path.startswith("observations/A_1-") and r.path.endswith("/s/flares-m.geojson")
    frame = lambda rows: spark.createDataFrame(rows, "area string, scene string, detector string, message string")
    got = records.errors_after(frame([("a", "1", "f", "old"), ("a", "2", "f", "old")]), frame([("a", "1", "f", "new")]), frame([("a", "2", "f", "")])).collect()
    assert [(r.scene, r.message) for r in got] == [("1", "new")]
    assert records.method_fingerprint("n", F.struct(F.lit(1).alias("a"))) is not None


def test_catalogue(spark):
    box = spark.createDataFrame([('{"type":"MultiPolygon","coordinates":[[[[1,2],[3,-4.5]]],[[[0.5,9],[2,2]]]]}',)], "g string").select(catalogue.geometry_bounds(F.col("g")).alias("b")).first().b
    assert (box.w, box.s, box.e, box.n) == (0.5, -4.5, 3.0, 9.0)
    features = spark.createDataFrame([(0, None, {"ProjectID": "P", "TerminalName": "N"}, '{"coordinates":[1,2]}'), (1, None, {}, '{"coordinates":[1,2]}')], "index int, id string, properties map<string,string>, geometry string")
    assert [(r.id, r.name, r.w, r.n) for r in catalogue.areas(features).collect()] == [("P", "N", 1.0, 2.0), ("1", "", 1.0, 2.0)]


def test_catalogue_pages(spark, tmp_path):
    """Pages follow next links in order, searches outside the dates stay unread, a page that fails is tried again."""
    from emberline.sources import catalogue_pages

    catalogue_pages.register(spark)
    rows = [(f"s{y}", i, f"i{y}-{i}", f"{y}-0{1 + i % 9}-01T10:00:00Z", float(i % 7) if i % 3 else None, "MGRS-31TCJ") for y in (2020, 2021, 2022) for i in range(25)]
    folder = str(tmp_path / "pages")
    index = catalogue_pages.record_pages(spark.createDataFrame(rows, "search string, seq long, id string, datetime string, cloud double, grid_code string").repartition(4), folder, page=10)
    assert [tuple(r) for r in index.orderBy("name").collect()][0] == ("s2020", "s2020-0.json", "2020-01-01", "2020-09-01")
    read = lambda **o: spark.read.format("catalogue_pages").options(wait="0", **o).load(folder)
    got = read().orderBy("seq").collect()
    assert [(r.search, r.id, r.datetime, r.cloud, r.grid_code) for r in got] == [(r[0], r[2], r[3], r[4], r[5]) for r in rows]
    (tmp_path / "pages" / "s2020-0.json").write_text("{")  # a broken page
    late = read(attempts="2").where("date >= '2021-02-01' and date < '2022-02-01' and cloud is not null")
    want = [r[2] for r in rows if "2021-02-01" <= r[3][:10] < "2022-02-01" and r[4] is not None]
    assert sorted(r.id for r in late.collect()) == sorted(want)
    with pytest.raises(Exception, match="after 2 attempts"):
        read(attempts="2").count()
    assert read().where("date = '1990-01-01'").count() == 0
    odd = tmp_path / "odd"
    odd.mkdir()
    (odd / "index.json").write_text(json.dumps([{"name": "a", "href": "p.json"}]))
    (odd / "p.json").write_text(json.dumps({"features": [{"id": "x", "assets": {"B11": {"href": "u"}, "q": 1}}, {"id": "y", "bbox": [1, 2, 3, 4], "properties": {"datetime": "2020-01-01T00:00:00Z"}}]}))
    x, y = spark.read.format("catalogue_pages").load(str(odd)).orderBy("seq").collect()
    assert (x.id, x.date, x.cloud, x.assets, y.w, y.n, y.date) == ("x", "", None, {"B11": "u"}, 1.0, 4.0, "2020-01-01")
    areas = spark.createDataFrame([(1.0, 2.0, 1.0, 3.0)], "w double, s double, e double, n double")
    body = json.loads(catalogue_pages.requests(areas, F.lit("2024-01-01"), F.lit("2024-01-31")).first().body)
    assert body == {"collections": ["sentinel-2-l2a"], "bbox": [1 - 1e-6, 2.0, 1 + 1e-6, 3.0], "datetime": "2024-01-01T00:00:00Z/2024-01-31T23:59:59Z", "limit": 100}


@pytest.mark.parametrize("parts", [1, 7])
def test_backgrounds_by_hand(spark, parts):
    """Nearest clear scenes of each target against all pairs: a tile with most rows over several tasks, ties in time, sparse and cloudy tiles, nulls."""
    rng = random.Random(parts)
    day = 86400
    rows = []
    for i in range(1400):
        tile = 5 if i % 3 else rng.choice((1, 2, 9, None))
        t = rng.randrange(0, 2000) * day // 4 if tile == 5 else rng.randrange(0, 900) * day
        clear = rng.choice((99.0, 96.0, 80.0, 70.0, 10.0, None)) if tile != 2 else rng.choice((70.0, 66.0, 20.0))
        rows.append((i, tile, t + rng.choice((0, 0, 100, 299, 300)), rng.choice((None, 5.0, 50.0, 97.0)) if i % 5 else 3.0, clear))
    rows += [(5000 + i, 7, 1000 * day, 1.0, 99.0) for i in range(60)] + [(6000, 7, 1001 * day, 1.0, 99.0), (6001, 8, 5, 1.0, 99.0), (6002, 7, None, 1.0, 99.0)]
    df = spark.createDataFrame(rows, "id long, tile long, t long, cloud double, clear double").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {}
        for r in catalogue.nearest_backgrounds(df.select("id", "tile", "t"), df).orderBy("target", "place").collect():
            got.setdefault(r.target, []).append((r.place, r.gap, r.id, r.clear))
        assert catalogue.nearest_backgrounds(df.select("id", "tile", "t"), df.where("false")).count() == 0
        assert catalogue.nearest_backgrounds(df.select("id", "tile", "t").where("false"), df).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for i, tile, t, _, _ in rows:
        near = [(abs(u - t), j, share or 0.0) for j, k, u, cloud, share in rows if tile is not None and t is not None and k == tile and u is not None and (100.0 if cloud is None else cloud) <= 95 and 300 <= abs(u - t) <= 120 * day]
        near.sort()
        limit = 95 if any(c >= 95 for _, _, c in near) else 65
        chosen = [x for x in near if x[2] >= limit][:20]
        if chosen:
            want[i] = [(n, *x) for n, x in enumerate(chosen, 1)]
    assert got == want


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return con


def normal(rows):
    def cell(v):
        if v is None or v != v:
            return None
        return float(v) if isinstance(v, (int, float, bool)) else str(v)

    return sorted(repr([cell(v) for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    got = [tuple(r[c] for c in order) for r in df.collect()]
    assert got
    if name in catalog.ORACLE:
        made = duck.execute(catalog.ORACLE[name])
        names = [d[0] for d in made.description]
        want = [tuple(r[names.index(c)] for c in order) for r in made.fetchall()]
        assert sorted(names) == order and normal(got) == normal(want)


def test_mask_join_needs_no_full_mask(spark, sf_dir):
    plan = catalog.QUERIES["needed_mask"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Cross" not in plan


def test_most_similar_scenes(spark):
    """Without pairs the same as with them: times that tie, at the limits and across blocks, infinite, missing and negative values."""
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2, None]), rng.randrange(-40, 40) * 864000 + rng.choice([0, 0, 299, 300, 301]), rng.choice([None, 10.0, 95.0, 96.0]), 50.0, rng.choice([None, math.inf, math.nan, 0.0, 1.0, 2.5, 2.5])) for i in range(600)]
    rows += [(1000 + i, 3, t, 10.0, 50.0, 1.0) for i, t in enumerate((0, catalogue.NEAR_S, catalogue.FAR_S, catalogue.FAR_S + 1, 2 * catalogue.FAR_S))]
    df = spark.createDataFrame(rows, "id long, tile long, t long, cloud double, clear double, distance double").repartition(3)
    near = catalogue.background_candidates(df.select("id", "tile", "t"), df).join(df.select("id", "distance"), "id")
    expected = sorted(catalogue.most_similar(near).collect())
    assert expected and sorted(catalogue.most_similar_scenes(df.select("id", "tile", "t"), df).collect()) == expected
    assert catalogue.most_similar_scenes(df.select("id", "tile", "t"), df.where("false")).count() == 0
