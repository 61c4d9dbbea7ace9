"""Drifting layouts, nested records and compaction against plain Python on small fixtures."""

import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from pairloom.functions.records import leaf_kinds, leaves, read_record
from pairloom.operators import compaction, drift, nested
from pairloom.plans import general


def test_read_record():
    assert read_record('{"a": 1}') == {"a": 1}
    assert read_record(json.dumps('{"a": 1}')) == {"a": 1}
    for bad in (None, "", "null", "[]", "1", '"x"', '{"a": 1', "{'a': 1}"):
        assert read_record(bad) is None


def test_leaves_absent_and_arrays():
    r = {"a": None, "b": [], "c": {}, "d": [{"e": 1}, None, {"e": [1]}], "f": [1, 2], "g": {"h": True}}
    assert list(leaves(r)) == [("d[].e", 1), ("d[].e", [1]), ("f", [1, 2]), ("g.h", True)]
    assert leaf_kinds(r, {}) == {"d[].e": {"number", "array"}, "f": "array", "g.h": "boolean"}


def _drifted(n=300):
    rng = random.Random(1)
    rows, i = [], 0
    for k in range(n):
        key, x = f"k{k}", rng.random()
        for v in ("1.2.0", "1.10.0"):
            i += 1
            if v == "1.2.0":
                r = {"old": x, "gone": "g", "kept": 5, "cams": [{"p": [x, 1.0]}, None]}
            else:
                r = {"new": x, "come": True, "kept": "5", "cams": [{"q": [x, 1.0], "n": 1}]}
            text = json.dumps(r)
            rows.append((i, key, v, json.dumps(text) if k % 7 == 0 else text, "extra"))
        rows.append((100_000 + k, key, None, '{"other": 1}', "extra"))
        rows.append((200_000 + k, key, "1.2.0", "{broken", "extra"))
    rows.append((999_999, "rare", "1.10.0", '{"seldom": 1}', None))
    return rows


def test_changes(spark, rows):
    df = spark.createDataFrame(_drifted(), "row_id long, key string, version string, meta string, path string")
    layouts, renamed = drift.study(df, "row_id", "key", "version", "meta")
    # the broken rows are newest of version 1.2.0 but unreadable: they vote for nothing
    got = rows(drift.changes(spark, layouts, renamed))
    versions = {r[0] for r in got}
    assert versions == {"1.10.0"} and layouts.versions == ["1.2.0", "1.10.0"]
    assert ("1.10.0", "retyped", "kept", "kept") in got and ("1.10.0", "added", "", "come") in got and ("1.10.0", "removed", "gone", "") in got
    assert not any("seldom" in r for r in got)


def test_renames(spark, rows):
    df = spark.createDataFrame([r for r in _drifted() if r[3] != "{broken"], "row_id long, key string, version string, meta string, path string")
    layouts, renamed = drift.study(df, "row_id", "key", "version", "meta")
    got = rows(drift.changes(spark, layouts, renamed))
    assert got == sorted([("1.10.0", "renamed", "old", "new"), ("1.10.0", "renamed", "cams[].p", "cams[].q"), ("1.10.0", "added", "", "come"), ("1.10.0", "added", "", "cams[].n"), ("1.10.0", "removed", "gone", ""), ("1.10.0", "retyped", "kept", "kept")], key=repr)
    t = drift.consolidate(df, "row_id", "version", "meta", layouts, renamed)
    assert {"new", "kept", "cams__q", "come", "gone", "other"} <= set(t.columns) and dict(t.dtypes)["kept"] == "string"
    assert t.where("version = '1.2.0' and new is null").count() == 0
    assert t.where("other is not null").count() == 301  # the rows of null version and the seldom path


def test_consolidate_loses_no_value(spark):
    usual = json.dumps({"n": 1, "ok": True, "s": "x", "one": {"v": 1}, "many": [{"e": 1}]})
    odd = [
        {"n": "2", "ok": "yes", "s": 5, "one": [{"v": 3}, {"v": 4}], "many": [{"e": 6}, 7]},
        {"n": "two", "ok": 1, "s": 2**60 + 1, "many": {"e": 8}, "version": "mine"},
        {"n": 10**400, "ok": [True], "s": [1]},
        {"n": 2**60 + 1},
    ]
    rows = [(i, f"k{i}", "1.0.0", usual) for i in range(100)] + [(100 + i, f"o{i}", "1.0.0", json.dumps(r)) for i, r in enumerate(odd)]
    df = spark.createDataFrame(rows, "row_id long, key string, version string, meta string")
    layouts, renamed = drift.study(df, "row_id", "key", "version", "meta")
    t = {r.row_id: r for r in drift.consolidate(df, "row_id", "version", "meta", layouts, renamed).collect()}
    got = [(r.n, r.ok, r.s, r.one__v, r.many__e, json.loads(r.other or "{}")) for r in (t[100 + i] for i in range(4))]
    assert got == [
        (2.0, None, "5.0", 3.0, ["6.0"], {"ok": ["yes"], "one[].v": [4], "many": [7]}),
        (None, None, "1.152921504606847e+18", None, ["8.0"], {"n": ["two"], "ok": [1], "s": [2**60 + 1], "version": ["mine"]}),
        (None, None, '["1.0"]', None, None, {"n": [10**400], "ok": [[True]]}),
        (float(2**60), None, None, None, None, {"n": [2**60 + 1]}),
    ]
    assert t[0].other is None


def test_no_rows(spark):
    df = spark.createDataFrame([], "row_id long, key string, version string, meta string")
    layouts, renamed = drift.study(df, "row_id", "key", "version", "meta")
    assert drift.changes(spark, layouts, renamed).count() == 0
    assert drift.consolidate(df, "row_id", "version", "meta", layouts, renamed).count() == 0


def test_picks_are_leaves():
    r = {"a": [{"b": [{"c": 1}, {"c": [2]}, None], "d": "x"}, {"b": [{"c": "3"}]}, 5], "a.e": 1, "f": {"g": [], "h": None, "i": {}}, "a[]": {"d": "y"}, "k": [1, 2]}
    for paths in (["a[].b[].c"], ["a[].d", "k"], ["a.e", "f.g", "f.h", "none"], ["a[].b[].c", "a[].d", "a.e", "k"]):
        want = {}
        for p, x in leaves(r):
            if p in paths:
                want.setdefault(paths.index(p), []).append(drift._text(x))
        assert dict(drift.Picks({p: i for i, p in enumerate(paths)}).of(r)) == {i: "".join(f"{len(x)}:{x}" for x in xs).encode() for i, xs in want.items()}


def test_promotion():
    assert drift.promote(["boolean", "number"]) == "number" and drift.promote(["array", "string"]) == "array"


def test_nested_intervals(spark, rows):
    texts = [
        (1, json.dumps({"scene": {"params": {"objects": [{"carried": [{"c": 1}, None, {"c": 2}]}, None, {"carried": {"c": 3}}]}}, "cameras": {"v": 0}})),
        (2, None), (3, ""), (4, "[1]"), (5, json.dumps({"cameras": [1, {"v": 1}, None]})),
    ]
    df = spark.createDataFrame(texts, "row_id long, meta string")
    n = nested.nodes(df, "row_id", "meta", [general.CAMERAS, general.OBJECTS, general.CARRIED], bodies=True)
    linked = nested.link(n.where(F.col("node_path") == general.CARRIED), n.where(F.col("node_path") == general.OBJECTS), "row_id")
    assert rows(linked.select("row_id", "parent_pos", "pos", "body")) == [(1, 0, 0, '{"c": 1}'), (1, 0, 2, '{"c": 2}'), (1, 2, 0, '{"c": 3}')]
    assert rows(n.where(F.col("node_path") == general.CAMERAS).select("row_id", "pos")) == [(1, 0), (5, 1)]
    for r in n.collect():
        assert r.pre >= 0 and r.post >= 0


def test_nested_deep():
    deep = {"a": 1}
    for _ in range(3000):
        deep = {"a": deep}
    assert nested.label(deep, frozenset({"a"}), False) and len(nested._label_deep(deep, frozenset({"a"}), False)) == 1
    flat = {"a": [{"b": [1, {"c": {}}]}, 2, {"b": {"c": None}}], "d": {"a": {}}}
    every = frozenset({"a", "a.b", "a.b.c", "d", "d.a"})
    assert sorted(nested.label(flat, every, False)) == sorted(nested._label_deep(flat, every, False))


def _files(spark, n, start=0):
    rng = random.Random(n)
    return spark.createDataFrame([(f"f{i}", rng.choice([0, 100, 300, 700, 5000])) for i in range(start, start + n)], "file_id string, n_bytes long")


def test_plan_loses_nothing(spark):
    files = _files(spark, 200)
    planned = compaction.plan(files, 512, 8192, 4)
    again = compaction.plan(files.repartition(5), 512, 8192, 4)
    assert sorted(map(repr, planned.collect())) == sorted(map(repr, again.collect()))
    where = {r.file_id: r.output_id for r in planned.collect()}
    # the journal leads every file to the same output, and tells the bytes of every merge
    at, size = {f: f for f in where}, {r.file_id: r.n_bytes for r in files.collect()}
    for level in range(compaction.levels(512, 8192, 4)):
        step = [r for r in compaction.journal(planned).where(f"level = {level}").collect()]
        to = {r.input_id: r.output_id for r in step}
        assert len(to) == len(step) and set(to) <= set(size)
        for o in set(to.values()):
            size[o] = sum(size[i] for i in to if to[i] == o)
            assert all(r.n_bytes == size[o] for r in step if r.output_id == o)
        at = {f: to.get(o, o) for f, o in at.items()}
    assert at == where
    size = {r.file_id: r.n_bytes for r in files.collect()}
    out: dict = {}
    for f, b in size.items():
        o = where.get(f, f)
        out[o] = out.get(o, 0) + b
    assert sum(out.values()) == sum(size.values()) and len(out) < 40
    assert all(b < 2 * 8192 for b in out.values())


def test_compact_once(spark, rows):
    inputs = spark.createDataFrame([("a", "1", False), ("a", "s1", True), ("b", "1", False), ("b", "s1", True), ("b", "s2", True), ("b", "s2", True), ("c", "2", False), (None, "2", False), ("d", "s1", True)], "key string, file_id string, packed boolean")
    files = spark.createDataFrame([("1", 10), ("2", 20), ("s1", 30), ("s2", None)], "file_id string, n_bytes long")
    planned = compaction.plan(files, 512, 1024, 4)
    c = compaction.compact(inputs, planned)
    assert compaction.compact(inputs, planned.limit(0)).count() == 0
    assert rows(c.select("key", "n_shards", "landed")) == [("a", 1, True), ("b", 2, True), ("c", 0, True), ("d", 1, False)]
    assert c.select("output_id").distinct().count() == 1


def test_many_empty_files(spark):
    files = spark.range(5000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("file_id"), F.lit(None).cast("long").alias("n_bytes"))
    planned = compaction.plan(files, 512, 8192, 4)
    inputs = compaction.journal(planned).groupBy("merge_id").count().agg(F.max("count"), F.sum("count")).first()
    assert inputs[0] <= compaction.MOST_INPUTS + 1 and planned.select("output_id").distinct().count() < 50


def test_a_run_that_dies_before_its_journal(spark, tmp_path, monkeypatch):
    def records(lo, hi):
        return spark.createDataFrame([(f"f{i}", f"k{i}") for i in range(lo, hi)], "file_id string, key string")

    root = f"file://{tmp_path}"
    c = compaction.Compactor(spark, root, 512, 8192, 4)
    c.run(_files(spark, 60), records(0, 60))
    shutil.rmtree(tmp_path / "journal")  # the data is there, the journal is lost; then new files come
    assert c.journal() is None
    c.run(_files(spark, 60).unionByName(_files(spark, 20, 60)), records(0, 80))
    keys = [r.key for r in c.data().collect()]
    assert sorted(keys) == sorted(f"k{i}" for i in range(80))
    assert len(list((tmp_path / "data").glob("run=*"))) == 1
    # a journal cut off half-way is none
    c.run(_files(spark, 10, 80), records(80, 90))
    newest = max((tmp_path / "journal").glob("run=*"), key=lambda p: p.stat().st_mtime)
    (newest / "_SUCCESS").unlink()
    c.run(_files(spark, 12, 80), records(80, 92))
    assert sorted(r.key for r in c.data().collect()) == sorted(f"k{i}" for i in range(92))


def test_faults_come_from_the_merges(spark, sf, rows):
    planned = general._planned(spark, sf)
    assert rows(general.faults(general._compacted(spark, sf, planned))) == rows(general.p5_found(spark, sf)) != []
    assert general.faults(general._compacted(spark, sf, planned.limit(0))).count() == 0


def test_compactor_is_idempotent(spark, tmp_path):
    def records(lo, hi):
        return spark.createDataFrame([(f"f{i}", f"k{i % 150}") for i in range(lo, hi)], "file_id string, key string")

    c = compaction.Compactor(spark, f"file://{tmp_path}", 512, 8192, 4)
    assert c.run(_files(spark, 200), records(0, 200)) > 0
    first = sorted(r.key for r in c.data().collect())
    assert len(first) == len(set(first)) <= 150
    assert c.run(_files(spark, 200), records(0, 200)) == 0
    c.run(_files(spark, 100, 200), records(200, 300))
    keys = [r.key for r in c.data().collect()]
    assert len(keys) == len(set(keys)) and set(first) <= set(keys)


def test_compactor_keeps_content(spark, tmp_path):
    files = [(f"f{i}", 100) for i in range(40)] + [("big", 9000), ("empty", None)]
    content = [(f, None, None if f == "empty" else f"body of {f}") for f, _ in files] + [(f"f{i}", f"k{i % 30}", None) for i in range(40)]
    c = compaction.Compactor(spark, f"file://{tmp_path}", 512, 8192, 4)
    schema = "file_id string, key string, body string"
    assert c.run(spark.createDataFrame(files, "file_id string, n_bytes long"), spark.createDataFrame(content, schema)) > 0
    # later files come alone and merge with what is left; the lone one stays
    more = [("late1", 50), ("late2", 8500)]
    c.run(spark.createDataFrame(more, "file_id string, n_bytes long"), spark.createDataFrame([(f, None, f"body of {f}") for f, _ in more] + [("late1", "k1", None)], schema))
    got = c.data().collect()
    assert sorted((r.file_id, r.body or "") for r in got if r.key is None) == sorted((f, "" if f == "empty" else f"body of {f}") for f, _ in files + more)
    assert sorted(r.key for r in got if r.key) == sorted(f"k{i}" for i in range(30))
    assert {r.output_id for r in got if r.file_id in ("big", "late2")} == {"big", "late2"}
    stored = spark.read.parquet(f"file://{tmp_path}/data").select("run", "output_id", F.col("_metadata.file_path").alias("p")).distinct().collect()
    assert len(stored) == len({r.p for r in stored}) == len({(r.run, r.output_id) for r in stored})


def test_written_holds_every_body(spark, sf, tmp_path):
    files = spark.read.parquet(f"{sf}/sample_files.parquet").select(F.concat(F.lit("file:"), F.col("file_id").cast("string")).alias("file_id"), "body").distinct()
    c = general.store(spark, sf, f"file://{tmp_path}")
    kept = c.data().where("key is null").select("file_id", "body")
    assert kept.exceptAll(files).count() == files.exceptAll(kept).count() == 0
    out = general.p5_written(spark, sf).agg(F.sum("n_files"), F.sum("n_bytes")).first()
    assert tuple(out) == tuple(files.agg(F.count("*"), F.sum(F.octet_length("body"))).first())


def test_file_keys(spark, rows):
    v = '"views": [{"view": 0}, {"view": "1"}]'
    bodies = [f'{{"job_id": "j", "edit": {{"op": "object_add"}}, {v}}}', f'{{"job_id": "j", "edit": {{"op": null}}, {v}}}', f'{{"job_id": "q", {v}}}', "{bad", None, "", "[]", '"{}"', '{"job_id": "z", "views": {"view": 2}}']
    files = spark.createDataFrame(list(enumerate(bodies)), "file_id long, body string")
    assert [r[1] for r in rows(general.file_keys(files).select(F.lit(0), "key"))] == ["j_add_v0", "j_add_v1", "j_v0", "j_v1", "q_v0", "q_v1", "z_v2"]


def _deep(n):
    return '{"a":' * n + "1" + "}" * n


def test_any_depth_and_any_layers_of_strings(spark, rows):
    from pairloom.functions.records import object_variant, parse_deep, write

    text = '{"a": "x\\"y", "b": [1, null, {"c": []}]}'
    layers = []
    for k in range(12):
        layers.append((k, text))
        text = json.dumps(text)
    assert all(read_record(t) == json.loads(layers[0][1]) for _, t in layers)
    df = spark.createDataFrame([*layers, (99, '"{broken"'), (98, "[1]"), (97, None)], "k int, t string")
    got = dict(rows(df.select("k", F.to_json(object_variant("t")))))
    assert all(json.loads(got[k]) == json.loads(layers[0][1]) for k in range(12)) and got[99] is got[98] is got[97] is None

    record = read_record(_deep(5000))
    assert write(record).replace(" ", "") == _deep(5000)
    assert [v for _, v in leaves(record)] == [1] and set(leaf_kinds(record, {}).values()) == {"number"}
    for bad in ("{", '{"a":}', "[1,]", '{"a":1,}', "{,}", '{"a" 1}', "[1 2]", "{}x", "", "{]"):
        with pytest.raises(ValueError):
            parse_deep(bad)


def test_deep_records_keep_their_bodies(spark, rows):
    deep = '{"cameras": [{"view": 3, "right": [1, 2], "x": ' + _deep(5000) + '}], "scene": {"params": {"objects": [{"obj_id": "o", "carried": {"obj_id": "c", "y": ' + _deep(5000) + "}}]}}}"
    df = spark.createDataFrame([(1, deep)], "row_id long, meta string")
    n = nested.nodes(df, "row_id", "meta", [general.CAMERAS, general.OBJECTS, general.CARRIED], bodies=True)
    got = {r["node_path"]: r["b"] for r in n.select("node_path", F.from_json("body", "view int, obj_id string", general.DEEP).alias("b")).collect()}
    assert got[general.CAMERAS]["view"] == 3 and got[general.OBJECTS]["obj_id"] == "o" and got[general.CARRIED]["obj_id"] == "c"
    linked = nested.link(n.where(F.col("node_path") == general.CARRIED), n.where(F.col("node_path") == general.OBJECTS), "row_id")
    assert rows(linked.select("row_id", "parent_pos", "pos")) == [(1, 0, 0)]
