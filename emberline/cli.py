"""Command line: detect, cluster, archive, views and models over tables in storage.

    python -m emberline.cli views --records s3a://…/observations --out s3a://…
    python -m emberline.cli cluster --detections …/views/detections --out sites.parquet [--clouds …/ops/clouds]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions import geo
from emberline.operators import catalogue, cluster, coverage, detect, plume
from emberline.schema import ClusterOptions, Thresholds
from emberline.session import session
from emberline.sources import records


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="emberline")
    sub = p.add_subparsers(dest="command", required=True)
    d = sub.add_parser("detect", help="blocks to detections (mode flares), scenes to plumes (mode plumes); both Parquet")
    d.add_argument("--mode", choices=("flares", "plumes"), default="flares")
    d.add_argument("--level", choices=("L1C", "L2A"), default="L1C")
    d.add_argument("--region", action="store_true", help="whole tiles instead of areas")
    d.add_argument("--blocks", help="Parquet of blocks (flares)")
    d.add_argument("--scenes", help="Parquet of scenes with probabilities (plumes)")
    d.add_argument("--table", help="JSON of transmittances (plumes)")
    d.add_argument("--areas", help="GeoJSON of areas: only detections in their boxes stay")
    d.add_argument("--pad-km", type=float, default=0.0)
    window(d)
    d.add_argument("--out", required=True)
    for name, value in Thresholds().as_json_map().items():
        d.add_argument(f"--{name.replace('_', '-')}", type=float, default=value)
    c = sub.add_parser("cluster", help="detections to scored sites")
    c.add_argument("--detections", required=True)
    c.add_argument("--clouds")
    c.add_argument("--out", required=True)
    window(c)
    c.add_argument("--merge-distance", type=float, default=135.0)
    c.add_argument("--min-dates", type=int, default=2)
    c.add_argument("--min-avg-b12", type=float, default=0.5)
    c.add_argument("--score-threshold", type=float, default=0.0)
    v = sub.add_parser("views", help="records to columnar views")
    v.add_argument("--records", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--curated", nargs="*", default=[])
    a = sub.add_parser("archive", help="copies records, without error and part files")
    a.add_argument("--source", required=True)
    a.add_argument("--target", required=True)
    m = sub.add_parser("models", help="checks a network's weights: prints path and SHA-256 of each file, fails if one differs from --sha256")
    m.add_argument("--files", required=True)
    m.add_argument("--sha256")
    return p


def window(p: argparse.ArgumentParser) -> None:
    """Options that limit what is read: dates and box (ends included), tiles."""
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--bbox", type=float, nargs=4, metavar=("W", "S", "E", "N"))
    p.add_argument("--tiles", nargs="*")


def check(o: argparse.Namespace) -> None:
    """Combinations that can't work are refused before anything is read."""
    if o.command != "detect":
        return
    if o.region and o.mode != "flares":
        raise SystemExit("--region works with --mode flares only")
    if o.mode == "plumes" and o.level != "L1C":
        raise SystemExit("--mode plumes needs --level L1C")
    if o.region and o.areas:
        raise SystemExit("--region takes whole tiles, --areas doesn't go with it")
    missing = [n for n in (("blocks",) if o.mode == "flares" else ("scenes", "table")) if not getattr(o, n)]
    if missing:
        raise SystemExit(f"--mode {o.mode} needs --{' and --'.join(missing)}")
    if o.start and o.end and o.start > o.end:
        raise SystemExit("--start lies after --end")
    if o.bbox and (o.bbox[0] > o.bbox[2] or o.bbox[1] > o.bbox[3]):
        raise SystemExit("--bbox is west, south, east, north")


def detected(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """What ``detect`` writes. Dates and tiles limit the blocks before the detector runs."""
    if o.mode == "plumes":
        return plume.detect_plumes(spark.read.parquet(o.scenes), plume.load_table(o.table))
    limits = Thresholds(**{k: getattr(o, k) for k in Thresholds().as_json_map()})
    blocks = spark.read.parquet(o.blocks).where(catalogue.in_window(o.start, o.end)).where(catalogue.in_tiles(o.tiles))
    found = detect.detect_blocks(blocks, limits).drop("br", "bc").where(catalogue.in_window(None, None, tuple(o.bbox) if o.bbox else None))
    if not o.areas:
        return found
    boxes = catalogue.areas(catalogue.read_features(spark, o.areas), o.pad_km).select("w", "s", "e", "n")
    at = found.withColumns({"_w": F.col("lon"), "_s": F.col("lat"), "_e": F.col("lon"), "_n": F.col("lat")})
    return catalogue.meeting_boxes(boxes, at).select(*found.columns).distinct()


def main(args: list[str] | None = None) -> None:
    o = parser().parse_args(args)
    check(o)
    spark = session()
    if o.command == "detect":
        detected(spark, o).write.mode("overwrite").parquet(o.out)
    elif o.command == "models":
        sums = spark.read.format("binaryFile").load(o.files).select("path", F.sha2("content", 256).alias("sha256"))
        for r in sums.toLocalIterator():
            print(r.sha256, r.path)
            if o.sha256 and r.sha256 != o.sha256.lower():
                raise SystemExit(f"{r.path} isn't the file that was expected")
    elif o.command == "views":
        root, out = o.records.rstrip("/"), o.out.rstrip("/")
        for pattern, write in (
            ("flares-*.geojson", lambda r: records.write_detections(records.detections_view(r), f"{out}/views/detections")),
            ("clouds-*.geojson", lambda r: records.clouds_view(r).write.mode("overwrite").parquet(f"{out}/ops/clouds")),
            ("plumes-*.geojson", lambda r: records.retrievals_view(r, o.curated).write.mode("overwrite").parquet(f"{out}/views/retrievals")),
        ):
            if records.any_file(spark, f"{root}/*/*/{pattern}"):
                write(records.read_records(spark, root, pattern))
    elif o.command == "archive":
        print(records.publish(spark, o.source, o.target))
    else:
        found = records.read_detections(spark, o.detections).where(catalogue.in_window(o.start, o.end, tuple(o.bbox) if o.bbox else None))
        found = found.where(catalogue.in_tiles(o.tiles)).withColumnRenamed("max_b11", "peak_b11").withColumn("det_id", F.xxhash64("date", "scene", "lon", "lat", "max_b12"))
        sites = cluster.cluster(found, ClusterOptions(o.merge_distance, o.min_dates, o.min_avg_b12, None, o.score_threshold))
        if o.clouds:
            mask = spark.read.parquet(o.clouds).select(geo.cell_index("glon").alias("i"), geo.cell_index("glat").alias("j"), "date", "cloud_frac")
            sites = coverage.rescore(sites, mask)
        records.write_sites(sites.drop("site"), o.out)


if __name__ == "__main__":
    main()
