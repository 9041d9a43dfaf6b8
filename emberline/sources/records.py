"""Analysis records: one immutable GeoJSON document per detector, area, scene and method; and the columnar views of them."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions.text import area_key, fingerprint, matches_prefix, safe_id
from emberline.schema import DETECTION_VIEW, RECORD

SCHEMA_NAME = "emission-sites/analysis/v2"


def read_records(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """The records below ``root`` whose file names match ``pattern``: analysis and features as variants."""
    reader = spark.read.schema(RECORD).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.json(root)


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether any file matches: a view without input isn't written at all."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def parsed(json_text: DataFrame, column: str = "json") -> DataFrame:
    """Records from a column of JSON texts, in the shape of :func:`read_records`."""
    v = F.parse_json(column)
    return json_text.select(
        F.try_variant_get(v, "$.analysis", "variant").alias("analysis"), F.try_variant_get(v, "$.features", "array<variant>").alias("features")
    )


def _get(v: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def detections_view(records: DataFrame) -> DataFrame:
    """One row per flare (schema.DETECTION_VIEW). Records without features give none. Scene fields of older records lie in the features."""
    one = records.select("analysis", F.explode("features").alias("f"))
    a = lambda p, k="string": _get("analysis", p, k)
    f = lambda p, k="string": _get("f", p, k)
    p = lambda n, k="double": f(f"properties.{n}", k)
    values = {
        "lon": f("geometry.coordinates[0]", "double"), "lat": f("geometry.coordinates[1]", "double"),
        "date": F.coalesce(a("scene.date"), p("date", "string")), "mgrs": F.coalesce(a("scene.mgrs"), p("mgrs", "string")),
        "scene": F.coalesce(a("scene.id"), p("scene", "string")), "max_b12": p("max_b12"), "avg_b12": p("avg_b12"),
        "max_b11": F.coalesce(p("peak_b11"), p("max_b11")), "b12_b11_ratio": p("b12_b11_ratio"), "peakedness": p("peakedness"),
        "pixels": p("pixels", "int"), "radiance": F.coalesce(p("radiance"), F.lit(0.0)), "saturated": p("saturated", "smallint"),
        "sun_elevation": F.coalesce(a("scene.sun_elevation", "double"), p("sun_elevation")), "sun_azimuth": F.coalesce(a("scene.sun_azimuth", "double"), p("sun_azimuth")),
        "glint_angle": F.coalesce(a("glint_angle", "double"), p("glint_angle")), "glint_score": F.coalesce(a("glint_score", "double"), p("glint_score")),
        "method": a("method.fingerprint"),
    }
    return one.select(*(values[s.name].cast(s.dataType).alias(s.name) for s in DETECTION_VIEW))


def clouds_view(records: DataFrame) -> DataFrame:
    """One row per cell of the cloud mask: glon, glat, date, cloud_frac, method."""
    one = records.select("analysis", F.explode("features").alias("f"))
    return one.select(
        _get("f", "geometry.coordinates[0]", "double").alias("glon"), _get("f", "geometry.coordinates[1]", "double").alias("glat"),
        F.coalesce(_get("analysis", "scene.date"), _get("f", "properties.date")).alias("date"),
        _get("f", "properties.cloud_frac", "double").alias("cloud_frac"), _get("analysis", "method.fingerprint").alias("method"),
    )


def retrievals_view(records: DataFrame, curated: list[str] | None = None) -> DataFrame:
    """One row per plume, and one for each record without any (detected false). ``curated``: prefixes of valid target:date:id.

    The centre falls back from the feature to the target's geometry, its centre and the area's.
    """
    one = records.select("analysis", F.explode_outer("features").alias("f"))
    a = lambda p, k="string": _get("analysis", p, k)
    f = lambda p, k="string": _get("f", p, k)
    at = lambda i: F.coalesce(f(f"properties.center[{i}]", "double"), f(f"geometry.coordinates[{i}]", "double"), a(f"target.geometry.coordinates[{i}]", "double"), a(f"target.center[{i}]", "double"), a(f"area.center[{i}]", "double"))
    found = F.col("f").isNotNull()
    named = F.concat(a("target.id"), F.lit(":"), a("scene.date"), F.lit(":"), f("properties.id"))
    return one.select(
        a("target.id").alias("target_id"), a("target.name").alias("target_name"), at(0).alias("lon"), at(1).alias("lat"),
        a("scene.id").alias("scene"), a("scene.date").alias("date"), a("scene.mgrs").alias("mgrs"), a("scene.satellite").alias("satellite"),
        a("status").alias("status"), a("clear_percent", "double").alias("clear_percent"), a("background_scene").alias("background_scene"),
        a("wind", "array<double>").alias("wind"), a("scene_score", "double").alias("scene_score"), a("method.fingerprint").alias("method"),
        found.alias("detected"), f("properties.id").alias("id"), f("properties.pixels", "int").alias("pixels"),
        f("properties.flux_rate_kg_h", "double").alias("flux_rate_kg_h"), f("properties.flux_rate_std_kg_h", "double").alias("flux_rate_std_kg_h"),
        f("properties.max_probability", "double").alias("max_probability"), F.when(found, matches_prefix(named, curated or [])).alias("valid"),
        F.to_json(f("geometry", "variant")).alias("geometry"), F.to_json(a("scene.footprint", "variant")).alias("footprint"),
        a("assets.probability").alias("probability_asset"), a("assets.preview").alias("preview_asset"),
    )


def write_detections(view: DataFrame, root: str) -> None:
    """One folder per tile below ``root``, sorted, zstd; tiles that ``view`` lacks stay as they are."""
    order = ["date", "scene", "lon", "lat"]
    sorted_ = view.repartition("mgrs").sortWithinPartitions("mgrs", *order)
    sorted_.write.partitionBy("mgrs").mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(root)


def read_detections(spark: SparkSession, root: str) -> DataFrame:
    """The detections archive; columns that older files lack are null, a missing radiance is 0. Filters reach the scan."""
    empty = spark.createDataFrame([], DETECTION_VIEW)
    stored = spark.read.option("mergeSchema", True).parquet(root)
    stored = stored.withColumn("mgrs", F.col("mgrs").cast("string"))
    return empty.unionByName(stored, allowMissingColumns=True).withColumn("radiance", F.coalesce("radiance", F.lit(0.0))).select(*DETECTION_VIEW.names)


def site_features(sites: DataFrame) -> DataFrame:
    """(mgrs, feature): a GeoJSON point per site with all its fields as properties."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    names = [c for c in sites.columns if c not in ("lon", "lat", "site")]
    return sites.select("mgrs", F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*names).alias("properties"))).alias("feature"))


def feature(lon: str, lat: str, properties: list[str]) -> Column:
    """A GeoJSON point as JSON text; properties that are null are left out."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties")))


#: What a record states once for its scene, so that its features needn't.
SCENE_KEYS = ("date", "mgrs", "scene", "sun_elevation", "sun_azimuth", "satellite", "footprint", "method")


def features_by_scene(rows: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(scene, features): the features of each scene's detections, cells of the cloud mask or plumes, without the keys that belong to the scene.

    A scene's features become one record, so they are gathered by scene.
    """
    own = [c for c in rows.columns if c not in (*SCENE_KEYS, lon, lat)]
    made = rows.select("scene", feature(lon, lat, own).alias("f"))
    return made.groupBy("scene").agg(F.array_sort(F.collect_list("f")).alias("features"))


def write_features(features: DataFrame, target: str) -> None:
    """One FeatureCollection below ``target``: a single task writes all features as they come, a line each; none is an empty collection."""

    def lines(batches):
        lead = '{"type":"FeatureCollection","features":['
        for batch in batches:
            texts = batch.column(0).drop_null().to_pylist()
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array([lead + texts[0], *("," + t for t in texts[1:])])], names=["value"])
                lead = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]}" if lead == "," else lead + "]}"])], names=["value"])

    one = features.sparkSession.range(1).select(F.lit(None).cast("string").alias("feature"))  # so that there is a task without features, too
    features.select("feature").unionByName(one).repartition(1).sortWithinPartitions("feature").mapInArrow(lines, "value string").write.mode("overwrite").text(target)


def write_sites(sites: DataFrame, target: str) -> None:
    """Sites as one GeoJSON FeatureCollection (``*.geojson``), one Parquet table (``*.parquet``) or a folder per tile."""
    if target.endswith((".geojson", ".json")):
        write_features(site_features(sites), target)
    elif target.endswith(".parquet"):
        sites.write.mode("overwrite").option("compression", "zstd").parquet(target)
    else:
        write = sites.repartition("mgrs").write.partitionBy("mgrs").mode("overwrite")
        write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(target)


def feature_collection(features: DataFrame) -> DataFrame:
    """One document of all features (of a bounded selection: it becomes one value)."""
    listed = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.array_sort(F.collect_list("feature")), ","), F.lit("]}"))
    return features.agg(listed.alias("json"))


def record_path(detector: Column, area: Column, area_json: Column, scene: Column, method: Column) -> Column:
    return F.concat_ws("/", F.lit("observations"), area_key(area, area_json), safe_id(scene), F.concat(detector, F.lit("-"), method, F.lit(".geojson")))


def method_fingerprint(name: str, parameters: Column) -> Column:
    """Identity of a method: its name and parameters as canonical JSON (keys in order, no spaces)."""
    return fingerprint(F.concat(F.lit('{"name":"' + name + '","parameters":'), F.to_json(parameters), F.lit("}")))


def envelope(detector: str, analysis: DataFrame) -> DataFrame:
    """(path, json) of records: analysis has area, area_json, scene (struct), target (struct), method (fingerprint), status, features array<string>."""
    body = F.struct(
        F.format_string("%s-%s-%s", F.lit(detector), F.col("method"), F.col("scene.id")).alias("id"), F.lit(detector).alias("detector"), "status",
        F.struct(F.col("method").alias("fingerprint")).alias("method"), "scene", "target", F.struct(area_key(F.col("area"), F.col("area_json")).alias("key")).alias("area"),
    )
    text = F.concat(
        F.lit('{"type":"FeatureCollection","schema":"' + SCHEMA_NAME + '","analysis":'), F.to_json(body), F.lit(',"features":['), F.array_join("features", ","), F.lit("]}")
    )
    return analysis.select(record_path(F.lit(detector), F.col("area"), F.col("area_json"), F.col("scene.id"), F.col("method")).alias("path"), text.alias("json"))


def commit_records(records: DataFrame, root: str) -> None:
    """Writes each (path, json) as a file of its own below ``root``, under another name first, then renamed.

    An empty list of features is a result like any other. Files are written by the executors through pyarrow's file
    systems (``file``, ``hdfs``, ``s3``, ``gs``; ``s3a`` and ``s3n`` are names of ``s3``), so rerun tasks overwrite what
    a lost one left.
    """

    def write(rows):
        where, base = _store(root)
        for r in rows:
            path = f"{base}/{r['path']}"
            where.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with where.open_output_stream(f"{path}.part") as out:
                out.write(r["json"].encode() + b"\n")
            where.move(f"{path}.part", path)

    records.select("path", "json").foreachPartition(write)


def complete(records: DataFrame) -> DataFrame:
    """(detector, area, scene, method) of the records that are whole: what a rerun may leave out."""
    a = lambda p: _get("analysis", p)
    out = records.select(a("detector").alias("detector"), a("area.key").alias("area"), a("scene.id").alias("scene"), a("method.fingerprint").alias("method"), F.col("features").isNotNull().alias("whole"))
    return out.where("whole").drop("whole").dropna().distinct()


def errors_after(before: DataFrame, failed: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Open errors (area, scene, detector, message): new ones replace old ones, successes clear them."""
    key = ["area", "scene", "detector"]
    return failed.unionByName(before.join(failed.select(*key), key, "left_anti")).join(succeeded.select(*key), key, "left_anti")


#: Where a published tree keeps the list of its files; readers skip the folder for its name.
MANIFEST = "_manifest"
NOT_PUBLISHED = (".err", ".part", ".crc")


def _store(root: str):
    """(file system, path) of a URI, for the executors."""
    from pyarrow import fs

    where, base = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", root))
    return where, base.rstrip("/")


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of the files below ``root``, paths relative to it, but for a manifest; no file is opened.

    Tasks list folders: the root, then its folders, then theirs with all below.
    """
    kinds = "path string, length long, modified timestamp, folder boolean"

    def below(entries: DataFrame, deep: bool) -> DataFrame:
        def run(batches):
            from pyarrow import fs

            store, base = _store(root)
            for batch in batches:
                folders = [p for p, f in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()) if f]
                yield batch.filter(pc.invert(batch.column(3)))
                for folder in folders:
                    found = store.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"), recursive=deep))
                    found = [f for f in found if f.type == fs.FileType.File or not deep and f.base_name != MANIFEST]
                    columns = ([f.path[len(base) + 1 :] for f in found], [f.size for f in found], [f.mtime_ns // 1000 if f.mtime_ns else None for f in found], [f.type != fs.FileType.File for f in found])
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, batch.schema.types)], schema=batch.schema)

        return entries.mapInArrow(run, kinds)

    found = below(spark.createDataFrame([("", None, None, True)], kinds), False)
    for deep in (False, True):
        found = below(found.repartition("path"), deep)
    return found.drop("folder")


def published(spark: SparkSession, target: str) -> DataFrame:
    """The manifest of a published tree: path, length, modified (at the source), run."""
    kinds = "path string, length long, modified timestamp, run string"
    at = f"{target.rstrip('/')}/{MANIFEST}"
    return spark.read.schema(kinds).parquet(at) if any_file(spark, f"{at}/*.parquet") else spark.createDataFrame([], kinds)


def publish(spark: SparkSession, source: str, target: str) -> int:
    """Copies a tree but for error and part files; returns how many files it copied.

    Executors copy, each file under another name first, then renamed. A run's files enter the manifest when all are
    there; a later run leaves out what the manifest has with the same length and time and the target still holds, so a
    run that broke off is repeated safely. Files that the source no longer has stay in the target.
    """
    source, target, run = source.rstrip("/"), target.rstrip("/"), uuid.uuid4().hex
    files = listed_files(spark, source).where(~F.col("path").rlike(r"\.(?:" + "|".join(e[1:] for e in NOT_PUBLISHED) + ")$"))
    before = published(spark, target)
    if any_file(spark, f"{target}/{MANIFEST}/*.parquet"):
        there = before.join(listed_files(spark, target).select("path", "length"), ["path", "length"], "left_semi")
        files = files.join(there.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")

    def copy(batches):
        (a, root), (b, into) = _store(source), _store(target)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                to = f"{into}/{path}"
                b.create_dir(to.rsplit("/", 1)[0], recursive=True)
                part = f"{to}.{uuid.uuid4().hex}.part"
                with a.open_input_stream(f"{root}/{path}") as read, b.open_output_stream(part) as write:
                    while block := read.read(1 << 23):
                        write.write(block)
                b.move(part, to)
            yield batch

    copied = files.select("path", "length", "modified").mapInArrow(copy, "path string, length long, modified timestamp")
    copied.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{target}/{MANIFEST}")
    return published(spark, target).where(F.col("run") == run).count()
