"""Geodesy as column expressions: UTM on WGS 84, boxes, distances, the cell grid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberline.functions.binding import let

# Fixed values of WGS 84 and UTM.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING, FALSE_NORTHING = 500000.0, 10000000.0
EARTH_RADIUS = 6371000.0
#: Step of the cell grid in degrees; cells per degree.
GRID_STEP, GRID_CELLS = 0.001, 1000

_E2 = FLATTENING * (2 - FLATTENING)
_EP2 = _E2 / (1 - _E2)
_N = (1 - math.sqrt(1 - _E2)) / (1 + math.sqrt(1 - _E2))
#: Meridional arc over the semi-major axis: coefficients of phi, sin 2 phi, sin 4 phi, sin 6 phi.
_ARC = (
    1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256,
    -(3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024),
    15 * _E2**2 / 256 + 45 * _E2**3 / 1024,
    -35 * _E2**3 / 3072,
)
#: Footpoint latitude: coefficients of sin 2 mu, sin 4 mu, ...
_FOOT = (3 * _N / 2 - 27 * _N**3 / 32, 21 * _N**2 / 16 - 55 * _N**4 / 32, 151 * _N**3 / 96, 1097 * _N**4 / 512)


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x) if isinstance(x, (int, float, bool)) else F.col(x)


def _central_meridian(zone: Column) -> Column:
    return F.radians((_col(zone) * 6 - 183).cast("double"))


def _poly(x: Column, *terms: tuple[float | Column, int]) -> Column:
    total = F.lit(0.0)
    for c, power in terms:
        total = total + c * F.pow(x, F.lit(float(power)))
    return total


def wgs84_to_utm(lon, lat, zone, north) -> Column:
    """struct(easting, northing) in metres of degrees."""
    lon, lat, zone, north = map(_col, (lon, lat, zone, north))
    phi, off = F.radians(lat), F.radians(lon) - _central_meridian(zone)
    start = F.struct(phi.alias("phi"), F.sin(phi).alias("sin"), F.cos(phi).alias("cos"), F.tan(phi).alias("tan"), (F.cos(phi) * off).alias("a"), north.alias("north"))

    def project(v: Column) -> Column:
        radius = SEMI_MAJOR / F.sqrt(1 - _E2 * v["sin"] * v["sin"])
        t, c, a, p = v["tan"] * v["tan"], _EP2 * v["cos"] * v["cos"], v["a"], v["phi"]
        arc = SEMI_MAJOR * (_ARC[0] * p + _ARC[1] * F.sin(2 * p) + _ARC[2] * F.sin(4 * p) + _ARC[3] * F.sin(6 * p))
        east = _poly(a, (F.lit(1.0), 1), ((1 - t + c) / 6, 3), ((5 - 18 * t + t * t + 72 * c - 58 * _EP2) / 120, 5))
        rise = _poly(a, (F.lit(0.5), 2), ((5 - t + 9 * c + 4 * c * c) / 24, 4), ((61 - 58 * t + t * t + 600 * c - 330 * _EP2) / 720, 6))
        northing = SCALE * (arc + radius * v["tan"] * rise)
        return F.struct(
            (SCALE * radius * east + FALSE_EASTING).alias("easting"), (northing + F.when(v["north"], 0.0).otherwise(FALSE_NORTHING)).alias("northing")
        )

    return let(start, project)


def utm_to_wgs84(easting, northing, zone, north) -> Column:
    """struct(lon, lat) in degrees of metres."""
    easting, northing, zone, north = map(_col, (easting, northing, zone, north))
    y = northing - F.when(north, 0.0).otherwise(FALSE_NORTHING)
    start = F.struct((easting - FALSE_EASTING).alias("x"), (y / (SCALE * SEMI_MAJOR * _ARC[0])).alias("mu"), _central_meridian(zone).alias("centre"))

    def footpoint(v: Column) -> Column:
        phi = v["mu"]
        for i, c in enumerate(_FOOT):
            phi = phi + c * F.sin((2.0 * i + 2) * v["mu"])
        return F.struct(phi.alias("phi"), v["x"].alias("x"), v["centre"].alias("centre"))

    def angles(v: Column) -> Column:
        w = 1 - _E2 * F.sin(v["phi"]) * F.sin(v["phi"])
        across = SEMI_MAJOR / F.sqrt(w)
        t, c = F.tan(v["phi"]) * F.tan(v["phi"]), _EP2 * F.cos(v["phi"]) * F.cos(v["phi"])
        lean = across * F.tan(v["phi"]) / (SEMI_MAJOR * (1 - _E2)) * F.pow(w, F.lit(1.5))
        return F.struct(
            v["phi"].alias("phi"), v["centre"].alias("centre"), F.cos(v["phi"]).alias("cos"), t.alias("t"), c.alias("c"), lean.alias("lean"), (v["x"] / (across * SCALE)).alias("d")
        )

    def unproject(v: Column) -> Column:
        t, c, d = v["t"], v["c"], v["d"]
        fall = _poly(
            d, (F.lit(0.5), 2), ((5 + 3 * t + 10 * c - 4 * c * c - 9 * _EP2) / -24, 4),
            ((61 + 90 * t + 298 * c + 45 * t * t - 252 * _EP2 - 3 * c * c) / 720, 6),
        )
        turn = _poly(d, (F.lit(1.0), 1), ((1 + 2 * t + c) / -6, 3), ((5 - 2 * c + 28 * t - 3 * c * c + 8 * _EP2 + 24 * t * t) / 120, 5))
        return F.struct(F.degrees(v["centre"] + turn / v["cos"]).alias("lon"), F.degrees(v["phi"] - v["lean"] * fall).alias("lat"))

    return let(let(let(start, footpoint), angles), unproject)


def utm_zone(epsg) -> Column:
    return F.pmod(_col(epsg), F.lit(100))


def utm_is_north(epsg) -> Column:
    return _col(epsg) < 32700


def epsg_from_mgrs(grid) -> Column:
    """UTM code of a tile name such as 39RWN or MGRS-39RWN: bands from N on lie north."""
    name = F.regexp_replace(_col(grid), "^MGRS-", "")
    zone = F.coalesce(F.regexp_extract(name, "^([0-9]+)", 1).try_cast("int"), F.lit(0))
    band = F.regexp_extract(name, "^[0-9]*(.)", 1)
    return F.when((band == "") | (band >= "N"), 32600).otherwise(32700) + zone


def degrees_of_metres_lat(metres) -> Column:
    return _col(metres) / 110540.0


def degrees_of_metres_lon(metres, lat) -> Column:
    return _col(metres) / (111320.0 * F.cos(F.radians(_col(lat))))


def pad_bbox(w, s, e, n, km) -> Column:
    """struct(w, s, e, n) grown by ``km`` on every side."""
    w, s, e, n, km = map(_col, (w, s, e, n, km))
    dlat, dlon = km / 111.0, km / (111.0 * F.cos(F.radians((s + n) / 2)))
    return F.struct((w - dlon).alias("w"), (s - dlat).alias("s"), (e + dlon).alias("e"), (n + dlat).alias("n"))


def bbox_area_km2(w, s, e, n) -> Column:
    w, s, e, n = map(_col, (w, s, e, n))
    return (n - s) * 111.0 * (e - w) * 111.0 * F.cos(F.radians((s + n) / 2))


def distance_m(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular distance in metres."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    dy = F.radians(lat2 - lat1)
    dx = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return EARTH_RADIUS * F.sqrt(dx * dx + dy * dy)


def cell_index(degrees) -> Column:
    """The grid index nearest to a coordinate; joins use these integers."""
    return F.round(_col(degrees) * GRID_CELLS).cast("long")


def snap(degrees) -> Column:
    return cell_index(degrees) / GRID_CELLS


def cell_key(lon, lat) -> Column:
    return F.format_string("%.3f,%.3f", snap(lon), snap(lat))


def bilinear(grid: Column, width: int, height: int, x: Column, y: Column) -> Column:
    """Value of a row-major array at fractional pixel centres (x, y), clamped to the grid."""
    at = lambda col, row: F.element_at(grid, (F.greatest(F.lit(0), F.least(F.lit(height - 1), row)) * width + F.greatest(F.lit(0), F.least(F.lit(width - 1), col)) + 1).cast("int"))
    x0, y0 = F.floor(x).cast("int"), F.floor(y).cast("int")
    wx, wy = x - x0, y - y0
    return (at(x0, y0) * (1 - wx) + at(x0 + 1, y0) * wx) * (1 - wy) + (at(x0, y0 + 1) * (1 - wx) + at(x0 + 1, y0 + 1) * wx) * wy


def footprint(w, s, e, n) -> Column:
    """A box as the JSON of a polygon."""
    w, s, e, n = map(_col, (w, s, e, n))
    ring = F.array(F.array(w, s), F.array(e, s), F.array(e, n), F.array(w, n), F.array(w, s))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def corner_bbox(x0, y0, x1, y1, epsg) -> Column:
    """struct(w, s, e, n): the box of the four corners of a UTM window."""
    corners = [utm_to_wgs84(x, y, utm_zone(epsg), utm_is_north(epsg)) for x in (x0, x1) for y in (y0, y1)]
    lons, lats = [c["lon"] for c in corners], [c["lat"] for c in corners]
    return F.struct(F.least(*lons).alias("w"), F.least(*lats).alias("s"), F.greatest(*lons).alias("e"), F.greatest(*lats).alias("n"))


def chip_bounds(lon, lat, epsg, half: float = 1020.0, step: float = 60.0) -> Column:
    """struct(x0, y0, x1, y1): a square of about 2 * half metres around a site, snapped outwards to ``step`` metres."""
    at = wgs84_to_utm(lon, lat, utm_zone(epsg), utm_is_north(epsg))
    down = lambda v: F.floor((v - half) / step) * step
    up = lambda v: F.ceil((v + half) / step) * step
    return F.struct(down(at["easting"]).alias("x0"), down(at["northing"]).alias("y0"), up(at["easting"]).alias("x1"), up(at["northing"]).alias("y1"))


def fits_window(w, s, e, n, x0, y0, x1, y1, epsg) -> Column:
    """Whether all four corners of a box in degrees lie in a UTM window."""
    inside = F.lit(True)
    for lon in (w, e):
        for lat in (s, n):
            p = wgs84_to_utm(lon, lat, utm_zone(epsg), utm_is_north(epsg))
            inside = inside & p["easting"].between(_col(x0), _col(x1)) & p["northing"].between(_col(y0), _col(y1))
    return inside
