"""Names, fingerprints, dates and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_id(name: Column) -> Column:
    """``name`` with every character but letters, digits, - and _ replaced by _; ``area`` if nothing is there."""
    return F.coalesce(F.nullif(F.regexp_replace(name, "[^A-Za-z0-9_-]", "_"), F.lit("")), F.lit("area"))


def fingerprint(json: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of a canonical JSON text."""
    return F.substring(F.sha2(json, 256), 1, 16)


def area_key(name: Column, json: Column) -> Column:
    return F.concat(safe_id(name), F.lit("-"), F.substring(F.sha2(json, 256), 1, 8))


def site_id(text: Column) -> Column:
    """A 32-bit polynomial hash (factor 31) of ASCII text, in base 36."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("long"))
    h = F.aggregate(F.filter(codes, lambda c: c > 0), F.lit(0).cast("long"), lambda a, c: (a * 31 + c) % 4294967296)
    return F.lower(F.conv(h.cast("string"), 10, 36))


def shifted_date(date: Column, days: int) -> Column:
    return F.date_format(F.date_add(F.to_date(date), days), "yyyy-MM-dd")


def civil_date(days: Column) -> Column:
    """The date so many days after 1970-01-01."""
    return F.date_format(F.date_from_unix_date(days.cast("int")), "yyyy-MM-dd")


def https_link(link: Column, endpoint: str) -> Column:
    """s3://bucket/key as a link below ``endpoint``; other links stay."""
    return F.regexp_replace(link, "^s3://", f"{endpoint.rstrip('/')}/")


def virtual_path(link: Column) -> Column:
    """The path under which a raster library reads a link: object stores and the web have prefixes of their own."""
    return (
        F.when(link.startswith("s3://"), F.concat(F.lit("/vsis3/"), F.substring(link, 6, 1 << 20)))
        .when(link.rlike("^https?://"), F.concat(F.lit("/vsicurl/"), link))
        .otherwise(link)
    )


def hourly_file(time: Column, prefix: str = "wind", suffix: str = ".nc4") -> Column:
    """The name of the hourly file that holds a time: the middle of its hour."""
    return F.concat(F.lit(f"{prefix}."), F.date_format(time, "yyyyMMdd"), F.lit("_"), F.date_format(time, "HH"), F.lit(f"30{suffix}"))


def matches_prefix(text: Column, prefixes: list[str]) -> Column:
    """Whether LIKE finds any of the prefixes: % and _ in them are wildcards, and no prefix means false."""
    out = F.lit(False)
    for p in prefixes:
        out = out | text.like(p + "%")
    return out


#: Assets of a scene by catalogue and level: what each band is called there.
BANDS = ("B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B10", "B11", "B12")
PROFILES = {
    ("aws", "L1C"): {b: b.lower() for b in BANDS},
    ("aws", "L2A"): {"B02": "blue", "B03": "green", "B04": "red", "B08": "nir", "B8A": "nir08", "B11": "swir16", "B12": "swir22", "SCL": "scl"},
    ("cdse", "L1C"): {b: b for b in BANDS},
    ("cdse", "L2A"): {**{b: f"{b}_20m" for b in ("B02", "B03", "B04", "B8A", "B11", "B12")}, "SCL": "SCL_20m"},
}


def band_links(assets: Column, source: str, level: str) -> Column:
    """map(band, link): the assets that a catalogue's profile names, without those a scene lacks."""
    names = PROFILES[source, level]
    pairs = F.array(*(F.struct(F.lit(band).alias("key"), F.try_element_at(assets, F.lit(name)).alias("value")) for band, name in names.items()))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
