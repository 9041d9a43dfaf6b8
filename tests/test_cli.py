"""The command line from records to sites, and entry points without the llm folders."""

import importlib.util
import json
import pathlib
import shutil
import subprocess
import sys

import pytest

from emberline import cli


def test_records_to_sites(spark, tmp_path):
    for day in range(1, 5):
        folder = tmp_path / "observations" / "a" / f"s{day}"
        folder.mkdir(parents=True)
        scene = {"id": f"s{day}", "date": f"2024-05-0{day}", "mgrs": "39RWN", "sun_elevation": 60.0}
        feature = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [51.0, 25.0]}, "properties": {"max_b12": 0.9, "peak_b11": 0.4, "pixels": 3, "radiance": 1.0}}
        cloud = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [51.0, 25.0]}, "properties": {"cloud_frac": 0.0}}
        for kind, f in (("flares", feature), ("clouds", cloud)):
            (folder / f"{kind}-m.geojson").write_text(json.dumps({"type": "FeatureCollection", "analysis": {"scene": scene, "method": {"fingerprint": "m"}}, "features": [f] if day < 4 or kind == "clouds" else []}))
    root = f"file://{tmp_path}"
    cli.main(["views", "--records", f"{root}/observations", "--out", root])
    cli.main(["cluster", "--detections", f"{root}/views/detections", "--clouds", f"{root}/ops/clouds", "--out", f"{root}/sites.parquet", "--end", "2024-05-31"])
    r = spark.read.parquet(f"{root}/sites.parquet").first()
    assert r.date_count == 3 and r.n_observed == 4 and r.persistence == 0.75 and r.mgrs == "39RWN"
    cli.main(["cluster", "--detections", f"{root}/views/detections", "--out", f"{root}/sites.geojson"])
    made = json.loads("".join(p.read_text() for p in (tmp_path / "sites.geojson").glob("part-*")))
    assert made["type"] == "FeatureCollection" and [f["properties"]["date_count"] for f in made["features"]] == [3]
    cli.main(["cluster", "--detections", f"{root}/views/detections", "--tiles", "40RAA", "--out", f"{root}/none.geojson"])
    assert json.loads("".join(p.read_text() for p in (tmp_path / "none.geojson").glob("part-*")))["features"] == []


def test_refused_options():
    for args in (["--mode", "plumes", "--region", "--scenes", "s", "--table", "t"], ["--mode", "plumes", "--level", "L2A", "--scenes", "s", "--table", "t"], ["--mode", "plumes", "--scenes", "s"], [], ["--blocks", "b", "--start", "2024-02-01", "--end", "2024-01-01"]):
        with pytest.raises(SystemExit):
            cli.main(["detect", *args, "--out", "o"])


def test_detect_in_areas(spark, tmp_path):
    from emberline.plans import proxies

    blocks = proxies.blocks(spark, "/root/testdata/sf0.001")
    blocks.write.parquet(f"file://{tmp_path}/blocks")
    box = lambda x: {"type": "Polygon", "coordinates": [[[x, 25.2], [x + 0.1, 25.2], [x + 0.1, 25.4], [x, 25.4], [x, 25.2]]]}
    for name, x in (("in", 50.95), ("out", 10.0)):
        (tmp_path / f"{name}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": name}, "geometry": box(x)}]}))
    run = lambda out, *more: (cli.main(["detect", "--blocks", f"file://{tmp_path}/blocks", "--out", f"file://{tmp_path}/{out}", *more]), spark.read.parquet(f"file://{tmp_path}/{out}").count())[1]
    n = run("all")
    assert n > 0 and run("inside", "--areas", f"file://{tmp_path}/in.geojson") == n and run("outside", "--areas", f"file://{tmp_path}/out.geojson") == 0
    assert run("tile", "--tiles", "MGRS-39RWN") == n and run("other", "--tiles", "40RAA") == 0 and 0 < run("days", "--start", "2024-01-10") < n


def test_models(spark, tmp_path, capsys):
    import hashlib

    (tmp_path / "w.bin").write_bytes(b"weights")
    right = hashlib.sha256(b"weights").hexdigest()
    cli.main(["models", "--files", f"file://{tmp_path}/w.bin", "--sha256", right])
    assert right in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["models", "--files", f"file://{tmp_path}/w.bin", "--sha256", "0" * 64])


def test_entry_without_llm(tmp_path):
    import __spark_entry__

    root = __spark_entry__.__file__.rsplit("/", 1)[0]
    for name in ("emberline", "__spark_entry__.py"):
        source = f"{root}/{name}"
        target = tmp_path / name
        if source.endswith(".py"):
            target.write_text(open(source).read())
        else:
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    made = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={"PATH": "/usr/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert made.returncode == 0, made.stderr
    assert int(made.stdout.split()[0]) >= 50


def test_nothing_else_imports_llm():
    package = pathlib.Path(importlib.util.find_spec("emberline").origin).parent
    assert not [p for p in package.rglob("*.py") if "llm" not in p.parts and "emberline.llm" in p.read_text()]
