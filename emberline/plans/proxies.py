"""Emission-shaped frames over the benchmark's tables, and the same in SQL: plain arithmetic, so that engines agree bit by bit.

Constants are written as 1e-2, because both engines read 0.01 as a decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detection per event: a site per user, five by three places around it."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    user, event = F.col("user_id"), F.col("event_id")
    base = e.select(
        event.alias("det_id"), user.alias("uid"), k.alias("k"),
        (51 + (user % 12) * F.lit(1e-2) + (event % 5) * F.lit(4e-4)).alias("lon"), (25 + F.floor(user / 12) * F.lit(1e-2) + (event % 3) * F.lit(4e-4)).alias("lat"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.concat(F.lit("T"), (user % 3).cast("string")).alias("mgrs"),
        F.concat(F.lit("S"), (event % 7).cast("string")).alias("scene"), (F.lit(3e-1) + F.col("value") * F.lit(1e-2)).alias("max_b12"), F.col("value").alias("radiance"),
    )
    ten, seventeen = F.col("k") % 10 == 0, F.col("k") % 17 == 0
    return base.select(
        "det_id", "uid", "lon", "lat", "date", "mgrs", "scene", "max_b12", "radiance",
        F.when(~ten, F.col("max_b12") / (1 + F.col("k") * (F.col("uid") % 7) * F.lit(12e-4))).alias("peak_b11"),
        F.when(~seventeen, 25 + (F.col("uid") % 6) * F.lit(10.0) + F.col("k") * F.lit(1e-1)).alias("sun_elevation"),
        F.lit(None).cast("double").alias("sun_azimuth"), F.lit(None).cast("double").alias("glint_score"), F.lit(None).cast("double").alias("b12_b11_ratio"),
        (F.col("k") % 40 + 1).cast("int").alias("pixels"),
    )


DETECTIONS = """
d AS (SELECT event_id AS det_id, uid, lon, lat, date, mgrs, scene, max_b12, radiance,
             CASE WHEN k % 10 <> 0 THEN max_b12 / (1 + k * (uid % 7) * 12e-4) END AS peak_b11,
             CASE WHEN k % 17 <> 0 THEN 25 + (uid % 6) * 10e0 + k * 1e-1 END AS sun_elevation, CAST(k % 40 + 1 AS INTEGER) AS pixels
      FROM (SELECT event_id, user_id AS uid, 51 + (user_id % 12) * 1e-2 + (event_id % 5) * 4e-4 AS lon, 25 + (user_id // 12) * 1e-2 + (event_id % 3) * 4e-4 AS lat,
                   strftime(ts, '%Y-%m-%d') AS date, 'T' || (user_id % 3) AS mgrs, 'S' || (event_id % 7) AS scene, 3e-1 + value * 1e-2 AS max_b12, value AS radiance,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def clouds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cloud mask over the detections' cells and dates."""
    d = detections(spark, sf_dir).select(F.round(F.col("lon") * 1000).cast("long").alias("i"), F.round(F.col("lat") * 1000).cast("long").alias("j"), "date").distinct()
    day = F.substring("date", 9, 2).cast("int")
    return d.select("i", "j", "date", ((F.col("i") * 31 + F.col("j") * 17 + day * 7) % 100 / F.lit(100.0)).alias("cloud_frac"))


CLOUDS = """
c AS (SELECT i, j, date, (i * 31 + j * 17 + CAST(substr(date, 9, 2) AS INTEGER) * 7) % 100 / 100e0 AS cloud_frac
      FROM (SELECT DISTINCT CAST(round(lon * 1000) AS BIGINT) AS i, CAST(round(lat * 1000) AS BIGINT) AS j, date FROM d))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An 8 x 8 block per vector, with the detector's columns."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    scaled = lambda x, by: (1000 + F.floor(F.greatest(x, F.lit(0.0)) * F.lit(by))).cast("int")
    return e.select(
        "vec_id", F.lit(0).alias("br"), F.lit(0).alias("bc"), F.concat(F.lit("2024-01-"), F.lpad((F.col("vec_id") % 28 + 1).cast("string"), 2, "0")).alias("date"),
        F.lit("39RWN").alias("mgrs"), F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("scene"), F.lit(32639).alias("epsg"),
        F.lit(500000.0).alias("img_min_x"), F.lit(2800000.0).alias("img_max_y"), F.lit(20.0).alias("res_x"), F.lit(20.0).alias("res_y"),
        F.lit(0).alias("block_offset_x"), F.lit(0).alias("block_offset_y"), F.lit(8).alias("width"), F.lit(8).alias("height"),
        (25 + F.col("vec_id") % 6 * 10).cast("double").alias("sun_elevation"), F.lit(None).cast("double").alias("sun_azimuth"),
        F.lit(-1000.0).alias("radiometric_offset"), F.lit(10000.0).alias("quantification"),
        F.transform("e", lambda x: scaled(x, 4e4)).alias("b12"), F.transform("e", lambda x, i: scaled(x, 2.4e4) + i * 37 % 11 * 50).alias("b11"),
        F.transform(F.reverse("e"), lambda x: scaled(x, 2.4e4)).alias("b8a"),
        F.transform("e", lambda x, i: F.when(F.col("vec_id") % 9 == 0, 9).otherwise((F.col("vec_id") * 7 + i) % 12).cast("int")).alias("scl"),
    )


#: One row per pixel: vec_id, idx (row-major), digital numbers.
PIXELS = """
e AS (SELECT vec_id, unnest(range(0, 64)) AS idx, unnest(embedding) AS x, unnest(list_reverse(embedding)) AS y FROM embeddings),
px AS (SELECT vec_id, CAST(idx AS INTEGER) AS idx, CAST(1000 + floor(greatest(CAST(x AS DOUBLE), 0e0) * 4e4) AS INTEGER) AS b12,
              CAST(1000 + floor(greatest(CAST(x AS DOUBLE), 0e0) * 2.4e4) AS INTEGER) + CAST(idx * 37 % 11 * 50 AS INTEGER) AS b11,
              CAST(1000 + floor(greatest(CAST(y AS DOUBLE), 0e0) * 2.4e4) AS INTEGER) AS b8a,
              CASE WHEN vec_id % 9 = 0 THEN 9 ELSE (vec_id * 7 + idx) % 12 END AS scl, least(1e0, greatest(0e0, CAST(x AS DOUBLE) + 5e-1)) AS prob FROM e),
pr AS (SELECT vec_id, idx, b12 AS dn12, scl, prob, (b12 - 1000) / 10000e0 AS b12, (b11 - 1000) / 10000e0 AS b11, (b8a - 1000) / 10000e0 AS b8a FROM px)"""


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An 8 x 8 probability raster per vector."""
    prob = F.transform("embedding", lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x.cast("double") + F.lit(5e-1))))
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.lit(8).alias("width"), F.lit(8).alias("height"), prob.alias("prob"))


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per user and date, as JSON; each fifth one has no features."""
    d = detections(spark, sf_dir)
    props = F.struct("max_b12", F.col("peak_b11").alias("peak_b11"), "radiance", "pixels", F.concat(F.lit("plume-"), F.col("pixels").cast("string")).alias("id"), F.col("det_id").alias("det_id"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"), props.alias("properties"))
    none = (F.col("uid") + F.substring("date", 9, 2).cast("int")) % 5 == 0
    grouped = d.groupBy("uid", "date").agg(F.collect_list(feature).alias("f"), F.min("mgrs").alias("mgrs"))
    analysis = F.struct(
        F.struct(F.concat_ws("-", F.lit("scene"), "uid", "date").alias("id"), "date", "mgrs").alias("scene"),
        F.struct(F.concat(F.lit("site"), F.col("uid").cast("string")).alias("id")).alias("target"), F.struct(F.lit("abc").alias("fingerprint")).alias("method"),
        F.when(none, "cloudy").otherwise("ok").alias("status"),
    )
    body = F.struct(analysis.alias("analysis"), F.when(none, F.slice("f", 1, 0)).otherwise(F.col("f")).alias("features"))
    return grouped.select(F.to_json(body).alias("json"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scene per order: its customer's tile, date and a cloud cover, null for some."""
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("long")
    return o.select(
        key.alias("id"), key.alias("seq"), (F.col("o_custkey") % 40).cast("long").alias("tile"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(key % 11 != 0, (key * 37 % 100).cast("double")).alias("cloud"), (key * 53 % 100).cast("double").alias("clear"),
        (F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")) * 86400 + key * 997 % 86400).cast("long").alias("t"),
    )


SCENES = """
s AS (SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_orderkey AS BIGINT) AS seq, CAST(o_custkey % 40 AS BIGINT) AS tile, strftime(o_orderdate, '%Y-%m-%d') AS date,
             CASE WHEN o_orderkey % 11 <> 0 THEN CAST(CAST(o_orderkey AS BIGINT) * 37 % 100 AS DOUBLE) END AS cloud, CAST(CAST(o_orderkey AS BIGINT) * 53 % 100 AS DOUBLE) AS clear,
             CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 + CAST(o_orderkey AS BIGINT) * 997 % 86400 AS t FROM orders)"""


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A facility unit per supplier and customer."""
    sup = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("long").alias("project"), F.col("s_acctbal").cast("double").alias("capacity"))
    cus = read(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000000).cast("long").alias("id"), F.concat(F.lit("N"), (F.col("c_custkey") % 9).cast("string")).alias("name"), F.col("c_nationkey").cast("long").alias("project"), F.col("c_acctbal").cast("double").alias("capacity"))
    place = {"lon": F.col("id") % 36 * F.lit(2e-2) + F.col("project"), "lat": F.col("id") % 25 * F.lit(2e-2) - 10 + F.col("project")}
    return sup.unionByName(cus).withColumns(place)


FACILITIES = """
f AS (SELECT *, id % 36 * 2e-2 + project AS lon, id % 25 * 2e-2 - 10 + project AS lat FROM (
        SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS project, CAST(s_acctbal AS DOUBLE) AS capacity FROM supplier
        UNION ALL SELECT CAST(c_custkey + 1000000 AS BIGINT), 'N' || (c_custkey % 9), CAST(c_nationkey AS BIGINT), CAST(c_acctbal AS DOUBLE) FROM customer))"""
