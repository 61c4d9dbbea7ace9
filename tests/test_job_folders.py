"""Scans of very many job folders."""

import json
import pathlib

import pytest

from pairloom.plans import catalog, files
from pairloom.sources import scans, sinks
from tests.oracle import compare


@pytest.fixture(scope="module")
def many(tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    for i in range(700):
        (root / f"f{i}").mkdir()
        (root / f"f{i}" / "sample.json").write_text(json.dumps({"job_id": f"j{i}", "edit": {"op": "object_add"}, "views": [{"view": 0, "before": "before_v0.png", "after": "after_v0.png"}]}))
        for name in ("before_v0.png", "after_v0.png")[: 1 + i % 2]:
            (root / f"f{i}" / name).write_bytes(scans.PNG if i % 3 else b"no image")
    return str(root)


def test_tasks_do_not_grow_with_folders(spark, many):
    views = scans.sample_views(spark, many)
    assert views.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert "Broadcast" not in views._jdf.queryExecution().executedPlan().toString() and views.count() == 350


def test_first_images_in_few_tasks(spark, many):
    firsts = scans.first_images(spark, many)
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert firsts.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism and "Join" not in plan
    assert firsts.count() == sum(1 for i in range(700) if i % 2 and i % 3)


def test_no_folders(spark, tmp_path):
    assert scans.sample_views(spark, str(tmp_path)).count() == 0 and scans.first_images(spark, f"file://{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name", ["folder_scan", "first_image_scan"])
def test_in_waves(spark, sf, monkeypatch, name):
    monkeypatch.setattr(files, "FOLDERS", 50)
    compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])


def test_equal_contents(spark, tmp_path):
    made = [(f"f{i}/{n}", c) for i in range(30) for n, c in (("a", b"same"), ("b", b"same"), ("c", str(i).encode()), ("d", None))] + [("f0/a", b"other")]
    df = spark.createDataFrame(made, "n string, c binary").coalesce(1)
    for _ in range(2):
        assert sinks.write_files(df, "n", "c", f"file://{tmp_path}") == 121
    got = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    assert got == {n: c or b"" for n, c in made}


def test_waves_are_made_of_the_folders_of_earlier_ones(spark, sf, monkeypatch):
    monkeypatch.setattr(files, "FOLDERS", 50)
    waves = []

    def scan(raws):
        job_dirs = [p for raw in ([raws] if isinstance(raws, str) else raws) for p in pathlib.Path(raw.removeprefix("file://")).iterdir() if p.is_dir()]
        waves.append({p.stat().st_ino for p in job_dirs})
        return scans.first_images(spark, raws).select("job_dir")

    files._through_job_folders(spark, sf, scan)
    assert len(waves) > 2 and sum(map(len, waves)) == spark.read.parquet(f"{sf}/sample_files.parquet").where("body is not null").count()
    assert all(len(a & b) > 0.5 * min(len(a), len(b)) for a, b in zip(waves, waves[1:]))


def test_refilled_folders(spark, tmp_path):
    waves = [
        {"f1": {"sample.json": b"first, and longer", "a.png": b"x", "b.png": b"y"}, "f2": {"sample.json": b"2"}, "f3": {"sample.json": b"3", "deep/c.png": b"x"}, "f4": {"a.png": b"x"}},
        {"f5": {"sample.json": b"5", "a.png": b"y", "b.png": b"y"}, "f2": {"sample.json": b"", "a.png": b"x"}},
        {f"f{k}": {"sample.json": str(k).encode(), "a.png": b"x", "b.png": b"xy"[k % 2 :][:1]} for k in range(6, 40)},
        {"f7": {"sample.json": b"7"}},
        {},
    ]
    old = None
    for k, wave in enumerate(waves):
        rows = [(d, f, x or None) for d, made in wave.items() for f, x in made.items()]
        df = spark.createDataFrame(rows, "d string, f string, c binary").repartition(3, "d").sortWithinPartitions("d")
        root = f"file://{tmp_path}/{k}"
        raws = sinks.refill_folders(df, "d", "f", "c", root, old)
        got = {}
        for raw in map(pathlib.Path, (r.removeprefix("file://") for r in raws)):
            for p in raw.iterdir() if raw.exists() else ():
                if p.is_dir():
                    got[p.name] = {str(q.relative_to(p)): q.read_bytes() for q in p.rglob("*") if q.is_file()}
        assert got == wave
        assert sorted(r["job_dir"] for r in scans.job_folders(spark, raws).collect()) == sorted(d for d, made in wave.items() if "sample.json" in made)
        old = root
    sinks.remove_folders(spark, raws)
    assert not any(pathlib.Path(r.removeprefix("file://")).exists() for r in raws)


def test_waves_without_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FOLDERS", 5)
    bodies = spark.range(12).selectExpr("id as file_id", "concat('x/f', id, '/sample.json') as file_path", "cast(null as string) as body")
    bodies.write.parquet(f"{tmp_path}/sample_files.parquet")
    assert catalog.QUERIES["first_image_scan"](spark, str(tmp_path)).count() == 0
