"""Values of scores, geodesy, pixels and texts."""

import math

import pytest
from pyspark.sql import functions as F

from emberline.functions import geo, pixels, scoring, text


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_scores(spark):
    rows = [(1.1, 0.0), (1.4, 0.5), (2.25, 1.0), (None, 0.0), (float("nan"), 0.0)]
    got = spark.createDataFrame([(r,) for r, _ in rows], "r double").select(scoring.ratio_score(F.col("r"))).collect()
    assert [x[0] for x in got] == pytest.approx([e for _, e in rows])
    r = one(
        spark, p0=scoring.persistence_score(F.lit(3.0), F.lit(0)), p1=scoring.persistence_score(F.lit(30.0), F.lit(24)), g0=scoring.glint_penalty(F.lit(0.0)),
        g1=scoring.glint_penalty(F.lit(2.0)), t=scoring.total_score(F.lit(1.0), F.lit(1.0), F.lit(0.0)), s=scoring.glint_suspect(F.lit(0.7), F.lit(1.2), F.lit(1)),
        n=scoring.glint_suspect(F.lit(0.7), F.lit(None).cast("double"), F.lit(1)), e=scoring.glint_score(F.lit(65.0)), h=scoring.glint_score(F.lit(float("nan"))),
    )
    assert (r.p0, r.p1, r.g1, r.e, r.h) == (0.0, 1.0, -0.4, 1.0, None)
    assert math.copysign(1, r.g0) == 1 and r.t == pytest.approx(0.9) and r.s is True and r.n is False


def test_utm(spark):
    there = geo.wgs84_to_utm(F.lit(-102.0208), F.lit(32.0071), F.lit(13), F.lit(True))
    df = spark.range(1).select(there.alias("u")).select("u", geo.utm_to_wgs84("u.easting", "u.northing", F.lit(13), F.lit(True)).alias("w"))
    r = df.first()
    assert abs(r.w.lon + 102.0208) < 1e-7 and abs(r.w.lat - 32.0071) < 1e-7
    names = spark.createDataFrame([("MGRS-39RWN",), ("13SDV",), ("39CWN",)], "g string").select(geo.epsg_from_mgrs("g")).collect()
    assert [x[0] for x in names] == [32639, 32613, 32739]
    z = one(spark, a=geo.utm_zone(F.lit(32739)), b=geo.utm_is_north(F.lit(32739)), k=geo.cell_key(F.lit(51.0013), F.lit(25.0004)))
    assert (z.a, z.b, z.k) == (39, False, "51.001,25.000")


def test_pixels(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6, 7, 8, 9],)], "a array<int>")
    three = F.lit(3)
    r = df.select(
        pixels.window(F.col("a"), three, F.lit(1), F.lit(0), F.lit(3), F.lit(2)).alias("w"), pixels.padded_window(F.col("a"), three, three, F.lit(-1), F.lit(-1), 2).alias("p"),
        pixels.decimated(F.col("a"), 3, 3, 2).alias("d"), pixels.cloud_fraction(F.col("a")).alias("c"), pixels.histogram(F.col("a")).alias("h"),
        geo.bilinear(F.col("a"), 3, 3, F.lit(0.5), F.lit(0.5)).alias("b"), geo.bilinear(F.col("a"), 3, 3, F.lit(9.0), F.lit(-1.0)).alias("e"),
    ).first()
    assert r.w == [2, 3, 5, 6] and r.p == [0, 0, 0, 1] and r.d == [1] and r.c == pytest.approx(3 / 9) and r.h[1:10] == [1] * 9
    assert r.b == 3.0 and r.e == 3.0
    mirrored = spark.createDataFrame([(i,) for i in range(-2, 5)], "i int").select(pixels.reflected(F.col("i"), F.lit(3))).collect()
    assert [x[0] for x in mirrored] == [2, 1, 0, 1, 2, 1, 0]
    xml = F.lit("<A><Q>1</Q></A><B><Q id='x'> -25.5 </Q></B>")
    t = one(spark, a=pixels.tag_number(xml, "Q"), b=pixels.tag_number(xml, "Q", after="<B>"), c=pixels.tag_number(xml, "Z"), v=pixels.viridis(F.lit(0.0)), w=pixels.viridis(F.lit(1.0)))
    assert (t.a, t.b, t.c) == (1.0, -25.5, None) and t.v == [68, 1, 84] and t.w == [253, 231, 37]
    o = one(spark, a=pixels.default_offset(F.lit("2022-01-24"), F.lit(None).cast("double")), b=pixels.default_offset(F.lit("2022-01-25"), F.lit(None).cast("double")), c=pixels.calibrate(F.lit(0), F.lit(-1000.0), F.lit(10000.0)))
    assert (o.a, o.b, o.c) == (0.0, -1000.0, 0.0)


def test_texts(spark):
    r = one(
        spark, a=text.safe_id(F.lit("Ras Laffan/1")), b=text.safe_id(F.lit("")), c=text.site_id(F.lit("32.0071,-102.0208")), d=text.shifted_date(F.lit("2024-03-01"), -1),
        e=text.matches_prefix(F.lit("a:b:plume-10"), ["a:b:plume-1"]), f=text.matches_prefix(F.lit("x"), []), g=text.virtual_path(F.lit("s3://b/k")), h=text.https_link(F.lit("s3://b/k"), "https://e"),
        i=text.band_links(F.create_map(F.lit("swir16"), F.lit("u")), "aws", "L2A"),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h, r.i) == ("Ras_Laffan_1", "area", "1d14fzj", "2024-02-29", True, False, "/vsis3/b/k", "https://e/b/k", {"B11": "u"})
