"""A Spark data source over the pages of catalogue searches, and the sink that records such pages."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

#: Items of a page; attempts to read one and the seconds between them, doubling up to the last.
PAGE, ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 100, 7, 1.0, 16.0
#: Degrees that a box without width or height is widened by on both sides; catalogues refuse it otherwise.
WIDENED = 1e-6
SCHEMA = (
    "search string, seq long, id string, date string, datetime string, cloud double, grid_code string, mgrs_tile string, epsg int,"
    " w double, s double, e double, n double, sun_elevation double, sun_azimuth double, assets map<string,string>"
)
_ARROW = pa.schema(
    [("search", pa.string()), ("seq", pa.int64()), *((c, pa.string()) for c in ("id", "date", "datetime")), ("cloud", pa.float64()), ("grid_code", pa.string()), ("mgrs_tile", pa.string()), ("epsg", pa.int32())]
    + [(c, pa.float64()) for c in ("w", "s", "e", "n", "sun_elevation", "sun_azimuth")]
    + [("assets", pa.map_(pa.string(), pa.string()))]
)


def requests(areas: DataFrame, start: Column, end: Column, level: str = "l2a") -> DataFrame:
    """``areas`` (w, s, e, n and others) with body: the JSON of a search over their box and dates. A box without extent is widened a little."""
    wide = lambda low, high: (F.when(F.col(low) >= F.col(high), F.col(low) - WIDENED).otherwise(F.col(low)), F.when(F.col(low) >= F.col(high), F.col(high) + WIDENED).otherwise(F.col(high)))
    (w, e), (s, n) = wide("w", "e"), wide("s", "n")
    when = F.concat(start, F.lit("T00:00:00Z/"), end, F.lit("T23:59:59Z"))
    return areas.withColumn("body", F.to_json(F.struct(F.array(F.lit(f"sentinel-2-{level}")).alias("collections"), F.array(w, s, e, n).alias("bbox"), when.alias("datetime"), F.lit(PAGE).alias("limit"))))


def _file(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if ":/" in path else f"file://{path}")


def read_json(path: str, attempts: int = ATTEMPTS, wait: float = FIRST_WAIT) -> dict | list:
    """The JSON at ``path``; what can't be read or parsed is tried again after growing waits. A path that isn't there fails at once."""
    for n in range(attempts):
        try:
            store, name = _file(path)
            with store.open_input_stream(name) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            raise
        except (OSError, ValueError) as error:
            if n + 1 == attempts:
                raise OSError(f"{path}: {error} after {attempts} attempts") from error
            time.sleep(min(wait * 2**n, LONGEST_WAIT))
    raise AssertionError


@dataclass
class Search(InputPartition):
    """A search: its number, its name, its first page and the dates that it covers (null: any)."""

    number: int
    name: str
    href: str
    start: str | None
    end: str | None


class CataloguePages(DataSource):
    """``spark.read.format("catalogue_pages").load(folder)``: items of all searches that ``index.json`` in the folder lists.

    The index is a list of {"name", "href", "start", "end"}; a page holds "features" and "links", of which the one with
    rel "next" names the page that follows, relative to the folder. Each search is a partition, and its task follows the links
    page by page, holding one at a time. seq orders items as they are listed. Conditions on date are pushed down: searches
    outside of them aren't read at all. Options: attempts and wait (seconds), for pages that fail.
    """

    @classmethod
    def name(cls) -> str:
        return "catalogue_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.attempts, self.wait = int(options.get("attempts", ATTEMPTS)), float(options.get("wait", FIRST_WAIT))
        self.dates: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in kinds and f.attribute == ("date",) and isinstance(f.value, str):
                self.dates.append((kinds[type(f)], f.value))
            else:
                yield f

    def _wanted(self, low: str | None, high: str | None) -> bool:
        """Whether a date from ``low`` up to ``high`` can meet all conditions."""
        for kind, value in self.dates:
            if kind in ("=", ">", ">=") and high is not None and (high < value or (kind == ">" and high == value)):
                return False
            if kind in ("=", "<", "<=") and low is not None and (low > value or (kind == "<" and low == value)):
                return False
        return True

    def partitions(self) -> list[Search]:
        index = read_json(f"{self.folder}/index.json", self.attempts, self.wait)
        return [Search(n, s["name"], s["href"], s.get("start"), s.get("end")) for n, s in enumerate(index) if self._wanted(s.get("start"), s.get("end"))] or [Search(-1, "", "", None, None)]

    def read(self, partition: Search) -> Iterator[pa.RecordBatch]:
        href, seq = partition.href, max(partition.number, 0) << 40
        while href:
            page = read_json(f"{self.folder}/{href}", self.attempts, self.wait)
            rows = []
            for item in page.get("features") or []:
                p = item.get("properties") or {}
                at = p.get("datetime") or ""
                if self._wanted(at[:10], at[:10]):
                    box = [float(x) for x in item.get("bbox") or []][:4]
                    box += [0.0] * (4 - len(box))
                    links = {k: v["href"] for k, v in (item.get("assets") or {}).items() if isinstance(v, dict) and isinstance(v.get("href"), str)}
                    rows.append((partition.name, seq, item.get("id"), at[:10], at, p.get("eo:cloud_cover"), p.get("grid:code"), p.get("s2:mgrs_tile"), p.get("proj:epsg"), *box, p.get("view:sun_elevation"), p.get("view:sun_azimuth"), list(links.items())))
                seq += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
            href = next((link.get("href") for link in page.get("links") or [] if link.get("rel") == "next"), None)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CataloguePages)


def record_pages(items: DataFrame, folder: str, page: int = PAGE) -> DataFrame:
    """Writes ``items`` (search, seq, id, datetime and any of cloud, grid_code, mgrs_tile, w, s, e, n) as pages below ``folder``; returns (name, href, start, end), a row per search.

    A search's items are written in order of seq by one task that holds one page; the index is written last, by the driver, a
    line per search. Pages have the same names and contents if a task runs again.
    """
    known = [c for c in ("cloud", "grid_code", "mgrs_tile", "w", "s", "e", "n") if c in items.columns]
    names = {"cloud": "eo:cloud_cover", "grid_code": "grid:code", "mgrs_tile": "s2:mgrs_tile"}
    folder = folder.rstrip("/")

    def write(name: str, number: int, rows: list[dict], last: bool) -> None:
        store, at = _file(f"{folder}/{name}-{number}.json")
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        features = [
            {"id": r["id"], "bbox": [r[c] for c in "wsen"] if all(c in r for c in "wsen") else None, "properties": {"datetime": r["datetime"], **{names[c]: r[c] for c in known if c in names}}}
            for r in rows
        ]
        links = [] if last else [{"rel": "next", "href": f"{name}-{number + 1}.json"}]
        with store.open_output_stream(at) as f:
            f.write(json.dumps({"type": "FeatureCollection", "features": features, "links": links}).encode())

    def run(batches):
        name, number, held, low, high, done = None, 0, [], None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["search"] != name:
                    if name is not None:
                        write(name, number, held, True)
                        done.append((name, f"{name}-0.json", low, high))
                    name, number, held, low, high = row["search"], 0, [], None, None
                if len(held) == page:
                    write(name, number, held, False)
                    number, held = number + 1, []
                held.append(row)
                date = row["datetime"][:10]
                low, high = min(low or date, date), max(high or date, date)
        if name is not None:
            write(name, number, held, True)
            done.append((name, f"{name}-0.json", low, high))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in range(4)], names=["name", "href", "start", "end"])

    ordered = items.select("search", "seq", F.col("id").cast("string").alias("id"), "datetime", *known).repartition("search").sortWithinPartitions("search", "seq")
    index = ordered.mapInArrow(run, "name string, href string, start string, end string").toPandas().sort_values("name")
    store, at = _file(f"{folder}/index.json")
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(at) as f:
        f.write(json.dumps(index.to_dict("records")).encode())
    return items.sparkSession.createDataFrame(index.to_dict("records"), "name string, href string, start string, end string")
