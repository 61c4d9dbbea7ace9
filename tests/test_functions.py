"""Worked expectations of the scalar functions and operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import captions, images, spelling, text
from pairloom.functions import geometry as g
from pairloom.operators import gates, rank, sampling, spatial, upsert
from pairloom.streaming import tasks


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lits(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(f("x")).collect()]


def test_spellings(spark):
    assert lits(spark, spelling.scene_id, "hs_1a", " HS-1A", "scenes/HS-1A.json", "hs-1a.scene_instance.json", "scenes/hs-1a", None, " ") == ["hs-1a"] * 5 + [None, None]
    assert lits(spark, spelling.asset_uid, "AB\t", "objaverse/ab.glb", "objaverse:ab", "a-b", "AB.GLB") == ["ab"] * 5
    assert lits(spark, spelling.asset_uid, "HSSD:AB.GLB", " hssd:ab") == ["hssd:ab"] * 2
    assert lits(spark, spelling.edit_op, "ADD", "object_add", " OBJECT_ADD ", None) == ["object_add"] * 3 + [None]
    assert lits(spark, spelling.source_name, "dataset:hssd", "HSSD ", " hssd") == ["hssd"] * 3
    assert lits(spark, spelling.version, "V0.10.0", "pipeline-0.10.0", "x", None) == ["0.10.0"] * 2 + [None] * 2
    paths = ("b1/e.tar", "./b1/e.tar", "/mnt/out/b1//E.TAR", "b1\\e.tar ", "B1/E.TAR")
    assert lits(spark, spelling.shard, *paths) == ["b1/e.tar"] * 5
    assert lits(spark, spelling.shard, "", "  ", None) == [None] * 3


def test_nouns(spark):
    assert lits(spark, text.display_noun, "coffee_table", "hot-dog", "date_(fruit)", "(only)", "", None) == ["coffee table", "hot dog", "date", "object", "object", "object"]
    rows = [("dalmatian", "101 Dalmatians Puppy", []), ("sweatband", "Прожектор", ["3d", "model", "spotlights"]), ("chair", "Render Model", ["pbr", "free"]), ("", None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "c string, n string, t array<string>").select(text.best_noun("c", "n", "t")).collect()]
    assert got == ["dalmatian", "spotlights", "chair", "object"]
    assert lits(spark, text.norm_category, "date_(fruit)", "Wine-Glass", "a__b_") == ["date", "wine_glass", "a_b"]
    assert lits(spark, text.is_wall_integrated, "kitchen_sink", "mug", None) == [True, False, False]


def test_phrases(spark):
    rows = [("Move the chair on the left to the wall", "chair"), ("Delete the nearest table.", "table"), ("Add a c++ (x)", "c++"), (None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "b string, n string").select(text.reference_phrase("b", "n")).collect()]
    assert got == ["the chair on the left", "the nearest table", "the c++", "the object"]
    assert lits(spark, text.location_tail, "Add a mug on top of the couch", "Add a mug.", None) == ["on top of the couch", None, None]
    assert lits(spark, text.is_disambiguated, "the one on the left", "leftmost", None) == [True, False, False]
    # letters beyond ASCII are letters to a word boundary
    assert one(spark, F.lit("把left边").rlike(r"\bleft\b")) == (False,)


def test_factors(spark):
    f = lambda x: one(spark, text.scale_bucket(F.lit(x)), text.is_round_factor(F.lit(x)), text.shrink_times(F.lit(x)), text.number_text(F.lit(x)))
    assert f(1.5) == ("moderately", True, None, "1.5") and f(0.5) == ("much", True, 2.0, "0.5") and f(0.67) == ("moderately", False, 1.49, "0.67") and f(2.0)[3] == "2"


FACTS = {"op": "object_move", "direction": ["left"], "scale_dir": None, "turn": None, "to": None}


def faults(spark, caption, **facts):
    f = FACTS | facts
    df = spark.createDataFrame([(caption, f["op"], f["direction"], f["scale_dir"], f["turn"], f["to"])], "c string, o string, d array<string>, s string, t string, n string")
    return df.select(text.caption_faults("c", "o", "d", "s", "t", "n")).first()[0]


def test_caption_faults(spark):
    assert faults(spark, "Move it to the right") and faults(spark, "把它往右挪") and not faults(spark, "Move it left")
    assert faults(spark, "make it bigger", op="object_scale", scale_dir="smaller") and faults(spark, "把它放大", op="object_scale", scale_dir="smaller")
    assert faults(spark, "Add a table", op="object_delete") and not faults(spark, "I don't want to see the table.", op="object_delete")
    assert faults(spark, "turn it clockwise", op="object_rotate", turn="counterclockwise") and not faults(spark, "turn it counter-clockwise", op="object_rotate", turn="clockwise")
    assert faults(spark, "get rid of the c++", op="object_replace", to="c++") and faults(spark, " x ") == ["empty caption"] and faults(spark, None) == ["empty caption"]


def test_templates_agree_with_facts(spark):
    base = {"noun": "chair", "reference": "the chair", "location": None, "direction": ["left"], "factor": 1.5, "factor_round": True, "degrees": 90.0, "angle_round": True, "turn_direction": "clockwise", "view_kind": "side_face", "from_noun": "chair", "to_noun": "vase", "base_instruction": "x"}
    rows = [(op, lang, s, *base.values()) for op, lang in captions.TEMPLATES for s in captions.STYLES]
    schema = "op string, lang string, style string, noun string, reference string, location string, direction array<string>, factor double, factor_round boolean, degrees double, angle_round boolean, turn_direction string, view_kind string, from_noun string, to_noun string, base_instruction string"
    df = captions.fill(spark.createDataFrame(rows, schema)).withColumn("sd", F.lit("bigger"))
    got = {(r.op, r.lang, r.style): r for r in df.withColumn("f", text.caption_faults("caption", "op", "direction", "sd", "turn_direction", "to_noun")).collect()}
    assert len(got) == 60 and not [r for r in got.values() if r.f]
    assert got["object_scale", "en", "direct"].caption == "Make the chair 1.5× bigger." and got["object_rotate", "zh", "direct"].caption == "把chair顺时针转90度"
    assert got["object_add", "en", "direct"].caption == "Add a chair." and got["object_move", "en", "intent"].caption == "The chair should be to the left."
    unknown = spark.createDataFrame([("object_paint", "en", "direct", *base.values())], schema)
    assert captions.fill(unknown).first().caption == "x"


def vec(*v):
    return F.array(*[F.lit(float(x)) for x in v])


def test_directions(spark):
    axes = (vec(1, 0, 0), vec(0, 0, 1), vec(0, 1, 0))
    words = lambda *d: one(spark, g.direction_words(vec(*d), *axes))[0]
    assert words(2, 0, 0.1) == ["right"] and words(0, 2, 0) == ["farther"] and words(0, -2, 0) == ["closer"] and words(0, 0, 0) == [] and words(1, 0, 1) == ["up", "right"]
    phrase = lambda *w: one(spark, g.direction_phrase(F.array(*map(F.lit, w)).cast("array<string>")))[0]
    assert phrase("left") == "to the left" and phrase() == "slightly" and phrase("left", "up") == "to the up left" and phrase("left", "closer") == "left, closer to the camera"
    ok = lambda w, x, y: one(spark, g.direction_consistent(F.array(*map(F.lit, w)).cast("array<string>"), F.lit(x), F.lit(y)))[0]
    assert ok(["left", "up"], -30, -20) and not ok(["right"], -30, 0) and ok(["closer"], 1, 1) and ok([], 0, 0)


def test_rotations(spark):
    q = one(spark, g.axis_angle_quat(vec(0, 0, 5), F.lit(90.0)))[0]
    assert q == pytest.approx([math.sqrt(0.5), 0, 0, math.sqrt(0.5)])
    m = one(spark, g.quat_matrix(vec(math.sqrt(0.5), 0, 0, math.sqrt(0.5))))[0]
    assert np.allclose(m, [[0, -1, 0], [1, 0, 0], [0, 0, 1]])
    assert one(spark, g.follow_turn(vec(0.3, 0, 1), vec(0, 0, 0), F.lit(90.0)))[0] == pytest.approx([0, 0.3, 1])
    assert one(spark, g.follow_scale(vec(0.4, 0.2, 1.15), vec(0, 0, 0), F.lit(0.5), F.lit(0.3)))[0] == pytest.approx([0.2, 0.1, 0.85])
    assert one(spark, g.view_change(F.lit("Z"), F.lit(-200.0)), g.turn_direction(F.lit(30.0), F.lit(0.5))) == ("opposite_side", None)


def test_images(spark):
    flat = np.full((64, 64, 3), 120, np.uint8)
    two = flat.copy()
    two[24:40, 4:14] = two[24:40, 50:60] = 250
    drift = two.copy()
    drift[:, 25:40] = np.clip(drift[:, 25:40].astype(int) + 6, 0, 255)
    stack = lambda img: img[None].astype(np.float32)
    flat, two, drift = stack(flat), stack(two), stack(drift)
    assert images.background(flat, two)[0] == 0.0 and images.background(flat, drift)[0] > 0.2 and images.background(flat, flat)[0] == 0.0
    assert images.sharpness(flat)[0] == 0 and images.sharpness(two)[0] > 0 and images.sharpness(two[:, :2])[0] == 0
    m = np.zeros((1, 9, 7), bool)
    m[0, 4, 3] = m[0, 0, 0] = True
    brute = np.array([[any(m[0, a, b] for a in range(max(0, y - 2), min(9, y + 3)) for b in range(max(0, x - 2), min(7, x + 3))) for x in range(7)] for y in range(9)])
    assert (images.widened(m, 2)[0] == brute).all() and (images.widened(m, 0) == m).all()
    assert [r[0] for r in spark.createDataFrame([([0.5] * 16,), ([300.0, -1.0, 7.9, 9.0],)], "i array<double>").select(images.to_bytes(F.col("i"), 4)).collect()] == [[127] * 12, [255, 0, 7]]
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 255, (12, 8, 8, 1)).astype(np.float32) for _ in range(2))
    a[3] = b[3]
    flat = lambda x: x.ravel().tolist()
    df = spark.createDataFrame([(i, flat(a[i]), flat(b[i])) for i in range(12)] + [(20, flat(a[0]), [1.0]), (21, None, flat(b[0])), (22, [None] * 64, flat(b[0]))], "i int, x array<float>, y array<float>")
    got = {r.i: tuple(r)[1:] for r in images.score_pairs(df.repartition(3), "i", "x", "y", 8, 8).collect()}
    for i in range(12):
        d = abs(a[i] - b[i])[..., 0]
        lap = [[b[i, y - 1, x, 0] + b[i, y + 1, x, 0] + b[i, y, x - 1, 0] + b[i, y, x + 1, 0] - 4 * b[i, y, x, 0] for x in range(1, 7)] for y in range(1, 7)]
        assert got[i][0] == pytest.approx((d > 12).mean(), abs=1e-4) and got[i][1] == pytest.approx(np.var(lap), rel=1e-5) and got[i][3] == pytest.approx(min(a[i].mean(), b[i].mean()), abs=0.06)
    assert got[3][0] == got[3][2] == 0 and got[20] == (1.0, None, 255.0, None) and got[21] == got[22] == (None,) * 4


def test_quality_and_flags(spark):
    df = spark.createDataFrame([(0.9, 1.0, 5.0, 4.0), (0.1, 50.0, 100.0, 0.1), (None, None, None, None)], "change_ratio double, sharpness double, brightness double, background_diff double")
    assert [r[0] for r in df.select(gates.quality_reasons()).collect()] == ["change_too_large;too_blurry;too_dark;background_unstable", "", ""]
    none = F.lit(None)
    flags = lambda **k: [f[0] for f in one(spark, gates.screen_flags(*[k.get(n, none) for n in ("op", "change", "move", "placement", "factor", "dropped", "background", "brightness")]))[0]]
    assert flags(change=F.lit(0.001)) == ["imperceptible"] and flags(op=F.lit("object_move"), move=F.lit(4.9)) == ["far_move"] and flags(op=F.lit("object_move"), move=F.lit(2.5)) == ["long_move"]
    assert flags(op=F.lit("object_scale"), factor=F.lit(3.0)) == ["extreme_scale"] and flags(dropped=F.lit(3)) == ["dropped_objects"] and flags(op=F.lit("object_scale"), factor=F.lit(1.3), change=F.lit(0.08)) == []


def test_pool_falls_back(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 5), (2, "c", 5), (3, "d", None)], "g int, id string, v int")
    assert rows(gates.first_nonempty_pool(df, ["g"], [F.col("v") < 3, F.col("v") < 9]).select("id")) == [("a",), ("c",), ("d",)]


BOX = "scene int, obj int, lo_x int, lo_y int, lo_z int, hi_x int, hi_y int, hi_z int"


def test_spatial_against_brute_force(spark, rows):
    rng = np.random.default_rng(3)
    made = []
    for i in range(120):
        x, y, z, sx, sy, sz = (int(v) for v in rng.integers([0, 0, 0, 50, 50, 50], [900, 900, 3, 600, 600, 60]))
        made.append((int(i % 2), i, x, y, z * 50, x + sx, y + sy, z * 50 + sz))
    made.append((0, 500, None, 0, 0, 1, 1, 1))
    df = spark.createDataFrame(made, BOX)
    whole = [m for m in made if m[2] is not None]
    cut = lambda a, b, k: min(a[k + 3], b[k + 3]) - max(a[k], b[k])
    want = [(a[0], a[1], b[1]) for a in whole for b in whole if a[0] == b[0] and a[1] < b[1] and min(cut(a, b, k) for k in (2, 3, 4)) > 0]
    for cell in (37, 300, 5000):
        assert rows(spatial.contacts(df, cell)) == sorted(want, key=repr)
    mid = lambda a, b: all(2 * b[k] <= a[k] + a[k + 3] <= 2 * b[k + 3] for k in (2, 3))
    rest = [(a[0], a[1], b[1]) for a in whole for b in whole if a[0] == b[0] and a[1] != b[1] and abs(b[4] - a[7]) <= 20 and mid(b, a) and 2 * max(cut(a, b, 2), 0) * max(cut(a, b, 3), 0) >= (b[5] - b[2]) * (b[6] - b[3])]
    assert rows(spatial.resting_on(df, 300, 20)) == sorted(rest, key=repr)


def test_peers(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 5.0), (1, "b", 2.0, 4.0), (1, "c", 2.0, 6.0), (2, "d", 0.0, 0.0), (None, "e", 0.0, 0.0), (None, "f", 0.0, 0.0)], "s int, o string, x double, d double")
    got = {r.o: r.phrase for r in spatial.describe_peers(df, ["s"], "x", "d").collect()}
    assert got == {"a": "on the left", "b": "nearest", "c": "farthest", "d": "", "e": None, "f": None}


def test_ordinals(spark):
    df = spark.createDataFrame([(f"{i * 7919 % 1000:04d}", "x") for i in range(1000)], "k string, __pl_z string")
    got = rank.ordinal(df.repartition(7), ["k"]).collect()
    assert sorted((r.ordinal, r.k) for r in got) == [(i, f"{i:04d}") for i in range(1000)]
    d = rank.distributed_rank(df.withColumn("h", F.md5("k")).withColumn("g", F.col("k").cast("int") % 3), ["g"], "h", digits=1)
    by: dict = {}
    for r in d.collect():
        by.setdefault(r.g, []).append((r.h, r["rank"]))
    assert all([n for _, n in sorted(v)] == list(range(len(v))) for v in by.values())


def test_current_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), (None, 4, "z")], "key string, row_id long, v string")
    assert rows(rank.current_rows(df, "key", "row_id", ["v"])) == sorted([("a", 3, None), ("b", 2, "y"), (None, 4, "z")], key=repr)


def test_round_robin(spark):
    df = spark.createDataFrame([(c, f"{c}{i}") for c in "abc" for i in range(4)], "cat string, uid string")
    got = sampling.round_robin(df, "cat", "uid", 6).collect()
    assert len(got) == 6 and len({r.cat for r in got}) == 3
    out = spark.createDataFrame([("a0",), ("b0",)], "uid string")
    ab = df.where("cat < 'c' and substring(uid, 2, 1) < '2'")
    assert {r.uid for r in sampling.round_robin(ab, "cat", "uid", 4, excluded=out).collect()} == {"a1", "b1"}
    again = sampling.round_robin(df.repartition(5), "cat", "uid", 6).collect()
    assert [r.uid for r in got] == [r.uid for r in again]


def test_quotas_and_deficits(spark):
    assert sampling.quotas(10, [("a", 1), ("b", 1), ("c", 1), ("d", 0)]) == {"a": 4, "b": 3, "c": 3, "d": 0} and sampling.quotas(3, []) == {}
    df = spark.range(101).withColumnRenamed("id", "row_id")
    assert {r[0]: r[1] for r in sampling.balanced(df, "row_id", [("zh", 0.8), ("en", 0.2)], "l").groupBy("l").count().collect()} == {"zh": 81, "en": 20}
    draws = sampling.Deficits(list(captions.STYLE_WEIGHTS.items()), [0])
    for _ in range(500):
        draws.draw()
    assert len(draws.made) == 5 and draws.made.min() > 30
    assert sampling.Deficits([("a", 0.0)], [0]).draw() is None
    assert sampling.cycle([("zh", 0.8), ("en", 0.2)]).count("en") == 1 and sampling.cycle([]) == []
    styles = spark.range(1000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, "object_scale").alias("op"))
    got = sampling.balanced(styles, "row_id", list(captions.STYLE_WEIGHTS.items()), "s", kind="op", blocked=captions.BLOCKED)
    assert {(r.op, r.s): r["count"] for r in got.groupBy("op", "s").count().collect() if r.s in ("goal", "direct")} == {("object_scale", "direct"): 132, (None, "direct"): 114, (None, "goal"): 68}


def test_deficits_extra_and_blocked(spark, sf):
    from pairloom.plans import catalog

    # a lone option below its share is not drawn every time once each has a small extra
    df = spark.range(400).select(F.lit("j").alias("job_id"), F.col("id").alias("row_id"))
    drawn = [r.op for r in sampling.deficit_sampling(df, "job_id", "row_id", [("a", 1.0), ("b", 1.0)], "op", 5, extra=0.05).orderBy("row_id").collect()]
    assert any(drawn[k] == drawn[k + 1] for k in range(0, 400, 2)) and abs(drawn.count("a") - 200) < 10
    each = sampling.deficit_sampling(spark.range(200).select(F.col("id").alias("job_id"), F.col("id").alias("row_id")), "job_id", "row_id", [("a", 1.0), ("b", 1.0)], "op", 5)
    assert 60 < each.where("op = 'a'").count() < 140  # jobs of one row don't all draw alike
    ops = {r.row_id: r.op for r in spark.read.parquet(f"{sf}/samples.parquet").select("row_id", spelling.edit_op("edit_op").alias("op")).collect()}
    got = catalog.QUERIES["caption_deficit_exact"](spark, sf).collect()
    assert len(got) == len(ops) and not any(r.style == "goal" and ops[r.row_id] in captions.BLOCKED for r in got)
    whole = sum(captions.STYLE_WEIGHTS.values())
    assert all(abs(sum(r.style == k for r in got) / len(got) - w / whole) < 0.1 for k, w in captions.STYLE_WEIGHTS.items())
    assert catalog.QUERIES["caption_all"](spark, sf).where("op in ('object_scale', 'object_rotate') and style = 'goal'").count() == 0
    none = sampling.deficit_sampling(df.withColumn("op", F.lit("x")), None, "row_id", [("a", 1.0)], "s", kind="op", blocked={"x": ["a"]}, otherwise="direct")
    assert [tuple(r) for r in none.groupBy("s").count().collect()] == [("direct", 400)]


def test_first_valid(spark, rows):
    df = spark.createDataFrame([("x", i + 1, v) for i, v in enumerate([1, 2, 3, 7, 8])] + [("y", 1, 0), ("y", 2, 0)], "k string, a int, v int")
    assert rows(sampling.first_valid(df, ["k"], "a", F.col("v") >= 7)) == [("x", True, 4), ("y", False, 2)]
    got = sampling.ideal_or_first(df, ["k"], "a", F.col("v") == 8, F.col("v") > 1)
    assert rows(got) == [("x", 5, 8)]


def test_upserts_are_idempotent(spark, rows):
    old = spark.createDataFrame([("a", 1, "s"), ("b", 2, "t")], "key string, v int, shard string")
    new = spark.createDataFrame([("b", None), ("c", 3)], "key string, v int")
    once = upsert.merge(old, new, "key", ["v"], ["shard"])
    assert rows(once) == sorted([("a", 1, "s"), ("b", None, "t"), ("c", 3, None)], key=repr)
    assert rows(upsert.merge(once, new, "key", ["v"], ["shard"])) == rows(once)
    assets = spark.createDataFrame([("u1", 9), ("u2", 9)], "uid string, used_count int")
    usage = spark.createDataFrame([("u2",), ("u3",), ("u3",), (None,)], "asset_uid string")
    counted = upsert.recount(assets, usage)
    assert rows(counted) == [("u1", 9), ("u2", 1), ("u3", 2)] and rows(upsert.recount(counted, usage)) == rows(counted)
    sets = upsert.replace_sets(spark.createDataFrame([("u1", "k1"), ("u2", "k2")], "a string, k string"), spark.createDataFrame([("u9", "k1"), ("u9", "k1")], "a string, k string"), "k")
    assert rows(sets) == [("u2", "k2"), ("u9", "k1")]
    assert upsert.add_columns(old, {"v": "int", "w": "string"}).columns == ["key", "v", "shard", "w"]
    none = spark.createDataFrame([], "uid string, used_count int")
    assert rows(upsert.with_fallback(none, assets)) == rows(assets)


def test_registry_and_fold():
    r = tasks.Registry()
    r.register("a")(lambda p: 1)
    r.register("a")(lambda p: 2)
    assert r.build("a", {}) == 2 and r.available() == ["a"]
    with pytest.raises(RuntimeError):
        r.get("b")
    u = tasks.Registry(unique=True)
    u.register("a")(len)
    with pytest.raises(ValueError):
        u.register("a")(len)
    with pytest.raises(KeyError):
        u.get("b")
    assert tasks.fold({"x": 1}, [(lambda p: {"y": p["x"] + p["k"]}, {"k": 2}), (lambda p: None, {}), (lambda p: {"z": p["y"]}, {})]) == {"x": 1, "y": 3, "z": 3}
    assert tasks.resources({"default": {"cpus": 4}}, "edit") == {"cpus": 4, "gpus": 0} and tasks.resources({}, "x") == {"cpus": 1, "gpus": 0}


def test_sources_are_injected():
    given = {"params": {"object_add": {"spawn": True}, "object_move": {"subject_source": {"scene": 1}}, "object_scale": {}}}
    got = tasks.with_object_sources(given, [{"name": "a"}])["params"]
    assert got["object_add"]["provider"] == got["object_replace"]["provider"] == got["object_move"]["spawn_params"]["provider"] == "composite"
    assert "spawn_params" not in got["object_scale"] and "object_replace" not in given["params"] and tasks.with_object_sources(given, None) == given


def test_providers(spark):
    assert captions.provider() is captions.template_provider
    with pytest.raises(ValueError):
        captions.provider("other")
    with pytest.raises(NotImplementedError):
        captions.provider("model")(None)


def test_pipelines_agree(spark, rows):
    def plus(p):
        return p | {"v": p["v"] + 1}

    def fail(p):
        if p["v"] % 2:
            raise ValueError("odd")
        return p

    t = spark.createDataFrame([(i, f'{{"v": {i}}}') for i in range(20)] + [(99, "{bad")], "i int, payload string")
    a, b = (tasks.pipeline(t, [plus, fail], m, keep=["i"]) for m in ("staged", "streaming"))
    assert rows(a) == rows(b) and a.where("ok").count() == 10
    with pytest.raises(ValueError):
        tasks.pipeline(t, [], "other")


def test_edit_operators(spark):
    from pairloom.operators import edits

    with pytest.raises(ValueError):
        edits.OPERATORS["object_scale"].prepare(size=2)
    with pytest.raises(ValueError):
        edits.OPERATORS["object_scale"].prepare(scale_range=(2, 1))
    scale = edits.OPERATORS["object_scale"].prepare(scale_choices=(0.5, 0.9, 1.2, 1.5, 3.0))
    df = spark.createDataFrame([(0, "chair", "chair", "nearest"), (1, "chair", "chair", None)], "i long, noun string, category string, phrase string")
    df = df.withColumns({"to_noun": F.lit(None).cast("string"), "support_noun": F.lit(None).cast("string"), "words": F.array(F.lit("left"))})
    got = scale.apply(df, F.col("i")).orderBy("i").collect()
    assert got[0].instruction == "make the nearest chair smaller" and '"factor":0.5' in got[0].meta and (got[1].discard, got[1].instruction, got[1].meta) == ("ambiguous", None, None)
    turned = edits.OPERATORS["object_rotate"].apply(spark.range(500).select(F.col("id").alias("i"), F.lit("mug").alias("noun"), F.lit("mug").alias("category"), F.lit("").alias("phrase"), F.lit("").alias("to_noun"), F.lit("").alias("support_noun"), F.array().cast("array<string>").alias("words")), F.col("i") * 97)
    degrees = [abs(r[0]) for r in turned.select(F.get_json_object("meta", "$.degrees").cast("double")).collect()]
    assert 15 <= min(degrees) and max(degrees) <= 180 and max(degrees) > 150


def test_amortised_jobs(spark):
    rows = [("a", i, "s" if i < 20 else f"t{i}", i % 3 > 0) for i in range(60)] + [("b", i, None, False) for i in range(9)]
    got = sampling.amortised(spark.createDataFrame(rows, "job string, row_id int, subject string, ok boolean"), "job", "row_id", "subject", "ok", [("x", 1.0), ("y", 1.0)], pairs=8, tries=4).collect()
    assert {r.job for r in got} == {"a"} and len({(r.op, r.subject) for r in got}) == len(got) <= 8 and max(r.slot for r in got) < 8 and max(r.attempt for r in got) < 4


def test_task_surfaces(spark, rows):
    assert tasks.present({"a": 1, "b": None, "c": 0}) == {"a": 1, "c": 0}
    t = spark.createDataFrame([(i, f'{{"v": {i}}}') for i in range(6)], "i int, payload string")

    def odd(p):
        if p["v"] % 2:
            raise ValueError("odd")
        return p

    told = []
    assert tasks.on_failure(tasks.run(t, odd, keep=["i"]), lambda r: told.append(r.i)) == 3 and sorted(told) == [1, 3, 5]
    assert rows(tasks.stage_counts(t, [("odd", odd), ("same", lambda p: p)])) == [("odd", 6, 3), ("same", 3, 3)]
