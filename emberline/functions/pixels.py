"""Radiometry and raster arrays as column expressions. Rasters are row-major arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberline.functions.binding import let

#: Scene classes that count as cloud or cloud shadow; the number of classes; the class without data.
CLOUDY, CLASSES, NO_DATA = (3, 8, 9, 10), 12, 0
#: From this date on, digital numbers carry an offset.
OFFSET_SINCE, OFFSET, QUANTIFICATION = "2022-01-25", -1000.0, 10000.0


def calibrate(dn: Column, offset: Column, quantification: Column) -> Column:
    """Reflectance of a digital number; 0 stays 0."""
    return F.when(dn == 0, 0.0).otherwise((dn + offset) / quantification)


def default_offset(date: Column, stated: Column) -> Column:
    """The stated offset, else the one of the date's processing baseline."""
    return F.coalesce(stated, F.when(date >= OFFSET_SINCE, OFFSET).otherwise(0.0))


def default_quantification(stated: Column) -> Column:
    return F.coalesce(F.when(stated > 0, stated), F.lit(QUANTIFICATION))


def tag_number(xml: Column, tag: str, after: str = "") -> Column:
    """The first number in an element ``tag``, behind the text ``after`` if given; null if there is none."""
    text = F.when(F.instr(xml, after) > 0, F.substring(xml, F.instr(xml, after), F.length(xml))) if after else xml
    return F.regexp_extract(text, rf"<{tag}(?:\s[^>]*)?>\s*([-+0-9.eE]+)\s*</{tag}>", 1).try_cast("double")


def is_hot(b12: Column, b12_min: float, offset: Column, quantification: Column) -> Column:
    """Whether any pixel can reach the detector's floor: a native test in front of the kernel, which never drops a detection."""
    floor = F.lit(b12_min) * quantification - offset
    return F.exists(b12, lambda v: v >= floor)


def cloud_fraction(scl: Column) -> Column:
    """Share of cloudy pixels; 0 without pixels or without classes."""
    n = F.size(F.filter(scl, lambda v: v.isin(*CLOUDY)))
    return F.when(scl.isNull() | (F.size(scl) == 0), 0.0).otherwise(F.try_divide(n, F.size(scl)))


def window(raster: Column, width: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The part of a raster from (x0, y0) up to (x1, y1), which isn't part of it."""
    rows = F.sequence(y0, y1 - 1)
    return F.when((x1 > x0) & (y1 > y0), F.flatten(F.transform(rows, lambda y: F.slice(raster, y * width + x0 + 1, x1 - x0)))).otherwise(F.slice(raster, 1, 0))


def padded_window(raster: Column, width: Column, height: Column, x0: Column, y0: Column, size: int) -> Column:
    """A size x size window; what lies outside of the raster is 0."""
    places = F.sequence(F.lit(0), F.lit(size * size - 1))

    def at(i: Column) -> Column:
        x, y = x0 + i % size, y0 + F.floor(i / size).cast("int")
        inside = (x >= 0) & (y >= 0) & (x < width) & (y < height)
        return F.when(inside, F.get(raster, (y * width + x).cast("int"))).otherwise(0)

    return F.transform(places, at)


def decimated(raster: Column, width: int, height: int, factor: int) -> Column:
    """Every factor-th pixel of every factor-th row: pixel (factor * x, factor * y)."""
    w, h = width // factor, height // factor
    return F.transform(F.sequence(F.lit(0), F.lit(w * h - 1)), lambda i: F.get(raster, (F.floor(i / w) * factor * width + i % w * factor).cast("int")))


def histogram(classes: Column) -> Column:
    """How often each scene class occurs."""
    return let(classes, lambda c: F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda k: F.size(c) - F.size(F.array_remove(c, k))))


def histogram_cloud_fraction(hist: Column) -> Column:
    """Cloudy pixels over pixels with data; 0 without any."""
    valid = F.aggregate(F.slice(hist, 2, CLASSES - 1), F.lit(0), lambda a, x: a + x)
    cloudy = sum((F.element_at(hist, k + 1) for k in CLOUDY[1:]), F.element_at(hist, CLOUDY[0] + 1))
    return F.coalesce(F.try_divide(cloudy, valid), F.lit(0.0)).cast("double")


def reflected(i: Column, n: Column) -> Column:
    """Index i mirrored at the ends of 0..n-1, without repeating the ends."""
    turn = 2 * (n - 1)
    at = F.when(n <= 1, F.lit(0)).otherwise(F.pmod(i, F.greatest(turn, F.lit(1))))
    return F.when(at < n, at).otherwise(turn - at)


def viridis(t: Column) -> Column:
    """array(r, g, b) of a value in 0..1, between the colour map's anchors."""
    # Anchors of the viridis colour map at equal steps.
    anchors = [(68, 1, 84), (59, 82, 139), (33, 145, 140), (94, 201, 98), (253, 231, 37)]
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)) * (len(anchors) - 1)
    k = F.least(F.floor(x), F.lit(len(anchors) - 2)).cast("int")
    table = F.array(*(F.array(*map(F.lit, a)) for a in anchors))
    low, high = F.element_at(table, k + 1), F.element_at(table, k + 2)
    return F.zip_with(low, high, lambda a, b: F.round(a + (b - a) * (x - k)).cast("int"))
