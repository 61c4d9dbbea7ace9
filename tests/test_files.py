"""Sources and sinks over small folders."""

import json
import tarfile

from pyspark.sql import functions as F

from pairloom.plans import files
from pairloom.sources import scans, sinks


def _job(root, name, views, op="object_move", images=True, body=None):
    d = root / name
    d.mkdir(parents=True)
    record = {"job_id": name, "edit": {"op": op} if op else None, "views": [{"view": v, "before": f"before_v{v}.png", "after": f"after_v{v}.png"} for v in views]}
    (d / "sample.json").write_text(json.dumps(record) if body is None else body)
    for v in views:
        (d / f"before_v{v}.png").write_bytes(b"png")
        if images:
            (d / f"after_v{v}.png").write_bytes(b"png")


def test_scan_of_job_folders(spark, tmp_path, rows):
    _job(tmp_path, "job_b", [0])
    _job(tmp_path, "job_0", [0, 1])
    _job(tmp_path, "job_x", [0], images=False)
    _job(tmp_path, "job_bad", [0], body="{bad")
    _job(tmp_path, "job_none", [0], op=None)
    got = scans.sample_views(spark, str(tmp_path))
    assert rows(got.select("key")) == [("job_0_move_v0",), ("job_0_move_v1",), ("job_b_move_v0",), ("job_none_v0",)]
    assert rows(scans.first_views(got).select("job_dir", "view")) == [("job_0", 0), ("job_b", 0), ("job_none", 0)]


def test_lists_and_maps(spark, tmp_path, rows):
    (tmp_path / "uids.txt").write_text(" a \n\nb\n")
    assert rows(scans.uid_list(spark, str(tmp_path / "uids.txt"))) == [("a",), ("b",)] and scans.uid_list(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "m.json").write_text(json.dumps({"u1": "chair", "u2": {"category": "mug", "tags": ["x"], "name": "n", "license": "by"}}))
    assert rows(scans.meta_map(spark, str(tmp_path / "m.json"))) == [("u2", "mug", "n", ["x"], "by")]
    assert ("u1", "chair") in rows(scans.category_map(spark, str(tmp_path / "m.json")))
    (tmp_path / "bad.json").write_text("{")
    assert scans.category_map(spark, str(tmp_path / "bad.json")).count() == 0 and scans.meta_map(spark, str(tmp_path / "none.json")).count() == 0


def test_semantics(spark, tmp_path, rows):
    (tmp_path / "s.csv").write_text("name,main_category,wnsynsetkey\na,,lamp.n.02\nb,chair,x.n.01\nc,,\na,desk,\n")
    assert rows(scans.semantics(spark, str(tmp_path / "s.csv"))) == [("a", "desk"), ("b", "chair"), ("c", "object")]


def test_scene_instances(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"object_instances": [{"template_name": "t", "translation": [1, 2, 3], "non_uniform_scale": 2}, {"template_name": "u", "rotation": [0, 1, 0, 0]}]}))
    got = scans.scene_instances(spark, str(tmp_path / "s.json")).orderBy("pos").collect()
    assert got[0].scale == [2.0] * 3 and got[0].translation == [1.0, 2.0, 3.0] and got[1].scale == [1.0] * 3 and got[1].rotation == [0.0, 1.0, 0.0, 0.0]


def test_pack_and_read_tar(spark, tmp_path, rows):
    df = spark.createDataFrame([(f"k{i:02d}", json.dumps({"i": i})) for i in range(25)] + [("k99", None)], "key string, body string")
    mapping = rows(sinks.pack(df, "key", "body", str(tmp_path / "t"), 10))
    assert mapping[0] == ("k00", "edit-000000.tar") and mapping[-1] == ("k99", "edit-000002.tar") and len(mapping) == 26
    with tarfile.open(tmp_path / "t" / "edit-000001.tar") as t:
        assert t.getnames() == [f"k{i}.json" for i in range(10, 20)]
    (tmp_path / "t" / "edit-999999.tar").write_bytes(b"broken")
    assert scans.tar_members(spark, str(tmp_path / "t")).count() == 26


def test_pair_lines_and_config(spark, tmp_path, rows):
    lines = spark.createDataFrame([('##PAIR## {"a": 1}',), ("##PAIR## {bad",), ("noise",), (None,)], "value string")
    assert rows(scans.pair_lines(lines)) == [('{"a":1}',)]
    (tmp_path / "c.json").write_text('{"a": [1]}')
    assert scans.config(str(tmp_path / "c.json")) == {"a": [1]}


def test_paired_is_as_long_as_the_shorter(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["x", "y"])], "b array<string>, a array<string>")
    assert [tuple(p) for p in df.select(sinks.paired("b", "a")).first()[0]] == [("a", "x"), ("b", "y")]


def test_pages_and_card(spark, sf, tmp_path):
    df = spark.createDataFrame([("<b>", i, 'x"y.png') for i in range(1201)], "t string, n int, i string")
    assert sinks.write_pages(df, ["n"], ["t", "n", "i"], "x", str(tmp_path / "r"), images=["i"]) == 3
    pages = [(tmp_path / "r" / f"page-{k:06d}.html").read_text() for k in range(3)]
    assert [p.count("<tr><td>") for p in pages] == [500, 500, 201] and '<td>&lt;b&gt;</td><td>0</td><td><img src="x&quot;y.png"></td>' in pages[0]
    card = [r.text for r in files.dataset_card(spark, sf).orderBy("line").collect()]
    assert card[0] == "---" and any(x.startswith("| object_add |") for x in card) and any("0.10.0" in x for x in card) and "## Licences" in card


def test_files_and_candidates(spark, tmp_path, rows):
    df = spark.createDataFrame([("a/x.json", "1"), ("b/y.json", None), (None, "z")], "n string, c string")
    for _ in range(2):
        assert sinks.write_files(df, "n", "c", f"file://{tmp_path}") == 2
    assert (tmp_path / "a" / "x.json").read_text() == "1" and (tmp_path / "b" / "y.json").read_text() == "" and len(list(tmp_path.rglob("*.json*"))) == 2
    listing = spark.createDataFrame([("q",), ("r",), ("q",)], "f string")
    t = spark.createDataFrame([(1, ["p", "r", "q"]), (2, ["p"]), (3, [])], "i int, c array<string>")
    assert rows(scans.first_existing(t, F.col("c"), listing, "f", "found").select("i", "found")) == [(1, "r"), (2, None), (3, None)]


def test_progress_and_splits(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "validation").otherwise("train"))
    sinks.append_progress(df, str(tmp_path / "p"))
    sinks.append_progress(df, str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 20
    sinks.save_splits(df, str(tmp_path / "s"), files_per_split=2)
    assert {r[0]: r[1] for r in scans.splits(spark, str(tmp_path / "s")).groupBy("split").count().collect()} == {"validation": 3, "train": 7}
