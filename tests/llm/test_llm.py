"""The operators for language-model data against brute force, exact round trips and planted cases."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairloom.llm import capping, leaks, mixing, queries, splits, tokens, truncation
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    compare(spark, sf, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() >= 0


# ---- mixing
TARGETS = "source_name string, target_share double, max_repeats int"


def _mix(spark, sizes, targets, digits=1, levels=2):
    rows = [(i, s, w, "clash") for i, (s, w) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id long, src string, w long, h string")
    got, plan = mixing.mix(df, "id", F.col("src"), F.col("w"), spark.createDataFrame(targets, TARGETS), digits=digits, levels=levels)
    return got.collect(), plan, got


def test_mix_holds_shares_and_caps(spark):
    rng = random.Random(2)
    sizes = [(s, rng.randint(1, 9)) for s, n in (("a", 400), ("b", 90), ("c", 30)) for _ in range(n)] + [(None, 3), ("x", 3), ("a", 0), ("a", None)]
    targets = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 5)]
    got, plan, rows = _mix(spark, sizes, targets)
    used = {b.source: 0 for b in plan}
    for r in got:
        used[r.source_name] += r.size * r.uses
        assert 1 <= r.uses <= {"a": 1, "b": 2, "c": 5}[r.source_name]
    for b in plan:
        assert b.budget - 9 < used[b.source] <= b.budget
    total = sum(used.values())
    assert all(abs(used[b.source] / total - b.share) < 0.02 for b in plan)
    report = {r.source_name: r for r in mixing.report(rows, plan).collect()}
    assert report["a"].used == used["a"] and report["c"].most_uses <= 5
    assert mixing.epochs(rows).count() == sum(r.uses for r in got)


def test_mix_cut_is_exact_at_any_depth(spark):
    sizes = [("a", 1)] * 500 + [("b", 1)] * 40
    want = None
    for digits, levels in ((1, 0), (1, 1), (1, 3), (3, 2)):
        got, plan, _ = _mix(spark, sizes, [("a", 0.8, 1), ("b", 0.2, 2)], digits, levels)
        now = sorted((r.source_name, r.id, r.uses) for r in got)
        assert want in (None, now)
        want = now
    assert sum(u for s, _, u in want if s == "b") == 80 and sum(u for s, _, u in want if s == "a") == 320


def test_mix_without_rows_or_targets(spark):
    assert _mix(spark, [("a", 1)], [])[0] == [] and _mix(spark, [], [("a", 1.0, 1)])[0] == []
    got, plan, _ = _mix(spark, [("a", 1)] * 10, [("a", 0.5, 1), ("none", 0.5, 3)])
    assert len(got) == 10 and {b.source: b.budget for b in plan} == {"a": 10, "none": 0}


# ---- capping
def test_capping_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice([None, float("nan"), 1.0, 2.0, 2.0, 3.0])) for i in range(400)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "id long, who string, q double, _rank int, h int").repartition(5)
    want = set()
    for w in ("hot", "b", "c"):
        order = sorted((r for r in rows if r[1] == w), key=lambda r: (-(r[2] if r[2] is not None and r[2] == r[2] else float("-inf")), r[0]))
        want |= {r[0] for r in order[12:]}
    assert {r.id for r in capping.dropped(df, "who", "q", "id", 12).collect()} == want
    assert {r.id for r in capping.kept(df, "who", "q", "id", 12).collect()} == {r[0] for r in rows if r[1]} - want
    assert capping.dropped(df.limit(0), "who", "q", "id", 12).count() == 0
    assert capping.dropped(df, "who", "q", "id", 10_000).count() == 0
    assert "WindowGroupLimit" in capping.kept(df, "who", "q", "id", 12)._jdf.queryExecution().executedPlan().toString()


def test_large_caps_without_a_hot_task(spark):
    # one contributor holds half of the rows, most of them alike
    q = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(float("nan"))).otherwise((F.col("id") % 50).cast("double"))
    who = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, "warm").when(F.col("id") % 8 == 3, F.concat(F.lit("x"), (F.col("id") % 700).cast("string")))
    df = spark.range(60_000).withColumn("q", q).withColumn("who", who).repartition(7)
    rows = [(r.id, r.who, r.q) for r in df.collect()]
    for cap in (5000, 1001, 15_000, 29_999, 30_000):
        want = set()
        for w in {r[1] for r in rows if r[1]}:
            order = sorted((r for r in rows if r[1] == w), key=lambda r: (-(r[2] if r[2] is not None and r[2] == r[2] else float("-inf")), r[0]))
            want |= {r[0] for r in order[:cap]}
        assert {r.id for r in capping.kept(df, "who", "q", "id", cap).collect()} == want
        assert {r.id for r in capping.dropped(df, "who", "q", "id", cap).collect()} == {r[0] for r in rows if r[1]} - want
    last = capping.last_kept(df, "who", "q", "id", 5000)
    assert "Window [sum" in last._jdf.queryExecution().executedPlan().toString() and {r.who for r in last.collect()} == {"hot", "warm"}
    ranged = df.where("who = 'hot'").repartitionByRange(8, "who", F.struct("q", "id"))
    sizes = ranged.groupBy(F.spark_partition_id()).count().select(F.max("count")).first()[0]
    assert sizes < 30_000 / 2
    left = capping.kept_to_share(df, "who", "q", "id", 0.25)
    n = {r.who: r["count"] for r in left.groupBy("who").count().collect()}
    assert max(n.values()) <= 0.25 * (sum(n.values()) + df.where("who is null").count()) and n["hot"] == n["warm"] > 1000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12), st.floats(0.02, 0.9), st.integers(0, 30))
def test_water_level(sizes, share, loose):
    histogram = sorted({n: sizes.count(n) for n in sizes}.items())
    total = lambda c: loose + sum(min(n, c) for n in sizes)
    fits = [c for c in range(0, max(sizes) + 1) if c <= share * total(c) + 1e-9]
    got = capping.water_level(histogram, share, loose)
    if max(sizes) <= share * total(max(sizes)):
        assert got is None
    else:
        assert got == max(fits)


# ---- splits
def _components(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("limits", [{}, {"forest_nodes": 5}, {"one_task_links": 3, "forest_nodes": 7}, {"one_task_links": 0}])
def test_components_against_brute_force(spark, limits):
    rng = random.Random(6)
    pairs = [(f"n{rng.randint(0, 90):02d}", f"n{rng.randint(0, 90):02d}") for _ in range(60)] + [("hub", f"h{i:02d}") for i in range(40)] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(30)] + [("own", "own"), (None, "x"), ("y", None)]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(6)
    got = {r.node: r.root for r in splits.components(df, **limits).collect()}
    assert got == _components([p for p in pairs if None not in p])


def test_components_of_nothing(spark):
    assert splits.components(spark.createDataFrame([], "a string, b string")).count() == 0


def _slow_greedy(sizes, targets):
    total, lack = sum(sizes), {}
    for n, t in targets:
        lack[n] = total * t
    out = dict.fromkeys(lack, 0)
    for s in sorted(sizes, reverse=True):
        best = max(lack, key=lambda n: (lack[n], -[t for t, _ in targets].index(n)))
        lack[best] -= s
        out[best] += s
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=400))
def test_greedy(sizes):
    targets = [("train", 0.8), ("test", 0.1), ("validation", 0.1)]
    got = splits.greedy(sorted({n: sizes.count(n) for n in sizes}.items()), targets)
    assert all(sum(v.values()) == sizes.count(s) for s, v in got.items())
    mine = {n: sum(s * v[n] for s, v in got.items()) for n, _ in targets}
    slow = _slow_greedy(sizes, targets)
    assert all(abs(mine[n] - slow[n]) <= max(sizes) for n in mine)


def test_assign_keeps_groups_together(spark):
    sizes = [(f"g{i}", s) for i, s in enumerate([500, 300, 90, 40] + [3] * 60 + [1] * 500)]
    at = splits.assign(spark.createDataFrame(sizes, "group string, size long"), spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")).collect()
    assert len(at) == len(sizes) == len({r.group for r in at})
    total = sum(s for _, s in sizes)
    for name, t in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(r.size for r in at if r.split_name == name) / total - t) < 0.01


def test_scene_pairs_against_brute_force(spark, sf):
    rows = queries._links(spark, sf).collect()
    c = _components([(r.job, r.scene) for r in rows if r.job and r.scene])
    scenes = sorted(k[2:] for k in c if k.startswith("s:"))
    want = {(a, b) for a in scenes for b in scenes if a < b and c[f"s:{a}"] == c[f"s:{b}"]}
    assert {tuple(r) for r in queries.p6_found(spark, sf).collect()} == want
    split = {r.row_id: r.split_name for r in queries.p6_splits(spark, sf).collect()}
    assert len(split) == len(rows)
    by: dict = {}
    for r in rows:
        for k in (r.job, r.scene):
            if k:
                by.setdefault(k, set()).add(split[r.row_id])
    assert all(len(s) == 1 for s in by.values())


# ---- tokens
@pytest.fixture(scope="module")
def ranks():
    return tokens.read_ranks(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=200), st.text("ab c\n'st的是​1<|>", max_size=300)))
def test_ids_equal_the_library_s(ranks, library, text):
    ids = tokens.encoder(ranks)(text)
    assert ids == library.encode_ordinary(text) and library.decode(ids) == text


def test_long_and_special_texts(ranks, library):
    encode = tokens.encoder(ranks)
    for text in ("a" * 20_000, "的" * 5_000, "ab" * 9_000 + "<|endoftext|>", " " * 3_000, "́" * 500, "🙂" * 800):
        assert encode(text) == library.encode_ordinary(text)
    assert encode(None) == encode("") == []


def test_encode_and_decode(spark):
    rows = [(1, "a b"), (2, None), (3, ""), (4, "汉字 <|endoftext|>")]
    ids = tokens.encode(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    assert dict(ids.dtypes) == {"id": "bigint", "ids": "array<int>"}
    back = {r.id: r.text for r in tokens.decode(ids, "id", "ids").collect()}
    assert back == {1: "a b", 2: "", 3: "", 4: "汉字 <|endoftext|>"}


# ---- leaks
WORDS = ["the", "a", "red", "chair", "stands", "near", "window", "of", "kitchen", "and", "moves", "slowly", "left", "tile", "counts"] + [f"w{i}" for i in range(40)]


def _items(rng, n=30):
    return [(i, " ".join(rng.choice(WORDS) for _ in range(25)), str(i)) for i in range(n)]


def _brute(index_items, text, lang, run):
    units = leaks.words if lang == "en" else leaks.chars
    u = units(text)
    have = {tuple(u[k : k + run]) for k in range(len(u) - run + 1)}
    return {i for i, t, _ in index_items if any(tuple(units(t)[k : k + run]) in have for k in range(len(units(t)) - run + 1))}


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(8)
    items = _items(rng, 200)
    index = leaks.build(items, "en")
    weights = [dict() for _ in index.ids]
    for t, (docs, ws, _, _) in index.postings.items():
        for at, w in zip(docs, ws):
            weights[at][t] = w
    for _ in range(200):
        q = {rng.choice(list(index.postings)) for _ in range(rng.randint(1, 20))}
        for threshold in (1.0, 4.0, 9.0):
            want = {at: sum(w for t, w in ws.items() if t in q) for at, ws in enumerate(weights)}
            got = dict(leaks.search(index, q, threshold))
            assert {a for a, s in want.items() if s >= threshold + 1e-9} <= set(got)
            assert all(s == pytest.approx(want[a]) and s >= threshold - 1e-9 for a, s in got.items())


def test_leaks_against_brute_force():
    rng = random.Random(9)
    items = _items(rng)
    index = leaks.build(items, "en")
    for _ in range(300):
        parts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(items)[1].split()
            k, n = rng.randint(0, 24), rng.randint(5, 25)
            parts += [" ".join(t[k : k + n]), " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 5)))]
        text = " ".join(parts)
        assert {index.ids[a] for a in leaks.matches(index, leaks.words(text))} == _brute(items, text, "en", leaks.WORDS)


def _longest(a, b):
    best, before = 0, {}
    for x in a:
        before = {k: before.get(k - 1, 0) + 1 for k, y in enumerate(b) if x == y}
        best = max([best, *before.values()])
    return best


def test_longest_run_over_the_whole_text():
    rng = random.Random(10)
    items = _items(rng)
    index = leaks.build(items, "en")
    text = {i: t for i, t, _ in items}
    for _ in range(100):
        t = rng.choice(items)[1].split()
        u = leaks.words(" ".join([rng.choice(WORDS) for _ in range(rng.randint(0, 30))] + t[rng.randint(0, 5) :] + [rng.choice(WORDS)] + t[:12]))
        for at, (_, longest) in leaks.matches(index, u).items():
            assert longest == _longest(leaks.words(text[index.ids[at]]), u)
    for _ in range(200):
        a, b = ([rng.choice("ab") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert leaks.longest_run(a, b) == _longest(a, b)
    assert leaks.longest_run(["very", "long", "text"] * 20_000, ["long", "text", "very"] * 20_000) == 59_999
    zh = "".join(chr(0x4E00 + k) for k in range(77))
    assert [n for _, n in leaks.matches(leaks.build([(1, zh, "")], "zh"), "前" * 30 + zh + "后").values()] == [77]


def test_answers_beside_ideographs(spark):
    zh = "保留测试第56613题：阁楼中只有一个金属的抱枕，要求模型把它送到近处"
    items = spark.createDataFrame([(1, "zh", zh, "3"), (2, "zh", zh + "吧", "木椅")], "item_id long, lang string, text string, answer string")
    df = spark.createDataFrame([(1, f"{zh}答案是3个"), (2, f"{zh}答案是33个"), (3, f"{zh}是木椅子")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find(df, "doc_id", "text", items).where("answer_seen").collect()}
    assert got == {(1, 1), (3, 2)}


def test_disguises(spark):
    en = "Task 40015 asks for a stool turned 15 degrees beside the steel armchair near the big window today"
    zh = "保留测试第56613题：阁楼中只有一个金属的抱枕，要求模型把它送到近处"
    items = spark.createDataFrame([(1, "en", en, "stool"), (2, "zh", zh, "3"), (3, "en", "too short", ""), (4, "en", None, None), (5, "zh", "短", "")], "item_id long, lang string, text string, answer string")
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in en)
    texts = [
        en.upper(), f"<p>{en.replace(' for', '<br/>for')}</p>", en.replace(" ", "   "), wide, en.replace("steel", "**st​eel**"), en.replace(",", ""),
        f"x {' '.join(en.split()[3:13])} y", f"x {' '.join(en.split()[3:12])} y", zh.replace("，", " ,"), f"前{zh[2:24]}后", f"前{zh[2:16]}后", None, "", "long " * 50_000 + en,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find(df, "doc_id", "text", items).select("doc_id", "item_id").collect()}
    assert got == {(i, 1) for i in (0, 1, 2, 3, 4, 5, 6, 13)} | {(8, 2), (9, 2)}
    assert leaks.find(df, "doc_id", "text", items.limit(0)).count() == 0 and leaks.find(df.limit(0), "doc_id", "text", items).count() == 0


def test_markup_of_any_length(spark):
    en = "Task 40015 asks for a stool turned 15 degrees beside the steel armchair near the big window today"
    items = spark.createDataFrame([(1, "en", en, "stool")], "item_id long, lang string, text string, answer string")
    junk = "data:image/png;base64," + "QUJD and more words " * 600
    between = [f'<img alt="{junk}">', f"<!-- {junk} > < {junk} -->", f"<p class='a > b'>", f"</span title=\"{junk}\">", "<p><!-- short --></p>"]
    texts = [en.replace("for a stool", f"for{x} a stool") for x in between] + [en.replace("stool", f"st<b id='{junk}'>ool</b>"), en.replace("for a", "for <never closed a"), "<a \"" * 30_000 + en, "<!--" * 30_000 + en]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in leaks.find(df, "doc_id", "text", items).collect()}
    assert got == set(range(len(texts)))
    assert leaks.without_markup("a<b>c</b> 1 < 2 <br/>x<p>y <i") == "ac 1 < 2  x y <i" and leaks.without_markup("x<!-- <p> -->y<!--z") == "x y<!--z"


# ---- cut texts
def _corpus(seed=3, n=1500):
    rng = random.Random(seed)
    nouns = ["table", "lantern", "cupboard", "armchair", "mirror", "teapot", "planter", "bookcase"]
    lines = ["The {0} stands beside the {1} in the corner.", "Brightness of the {0} is {n} on average.", "We keep the settings next to every {0} so that it can be rendered again.", "The {0} was replaced with a wooden {1}."]
    chat = ["move the {0} a bit to the left", "please turn the {0} by {n} degrees", "same room as before but without the {0}"]
    docs, cut = [], set()
    for i in range(n):
        source = "notes" if i % 3 else "chat"
        pick = lines if source == "notes" else chat
        text = (" " if source == "notes" else "\n").join(rng.choice(pick).format(rng.choice(nouns), rng.choice(nouns), n=rng.randint(1, 999)) for _ in range(rng.randint(2, 5)))
        if source == "notes" and i % 10 == 1:
            text += rng.choice(["\n- reviewer 7", "\nTags: old, red, small"])
        n_chars = len(text)
        if i % 20 == 7:
            k = rng.randint(15, len(text) - 3)
            while text[:k].rstrip()[-1] in ".\n" or text[k - 1 : k + 1].isspace() or (source == "chat" and text[k] == "\n") or text[k] in ".":
                k -= 1
            text = text[:k] + rng.choice(["", "", "…", " [cut]", "�"])
            cut.add(i)
        docs.append((i, text, source, n_chars if i % 2 else None, "extra"))
    return docs + [(n, None, "notes", 1, ""), (n + 1, "", "chat", 0, ""), (n + 2, "  \n", None, 3, "")], cut


def test_cut_texts_are_found(spark):
    docs, cut = _corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long, token string")
    judged = truncation.judge(df, "doc_id", "text", "source", "n_chars")
    got = {r.id for r in judged.where("cut").collect()}
    assert len(got & cut) >= 0.95 * len(cut) and len(got - cut) <= 0.02 * len(docs)
    rates = {r.source: r for r in truncation.rates(df, judged, "source", "text").collect()}
    assert rates["notes"].n_cut + rates["chat"].n_cut == len(got) and None not in rates


def test_marks_and_tokens():
    assert truncation.strip_mark("a b … [cut] ") == ("a b", "[cut]") and truncation.strip_mark("done [checked]") == ("done [checked]", "")
    assert truncation.tokens("Don't job_1234567 1.5 把 x2\n.") == ["don't", "job_9999999", "#.#", "把", "x9", "\n", "."]


def test_no_texts_no_cuts(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")
    assert truncation.judge(df, "doc_id", "text", "source", "n_chars").count() == 0
    few = spark.createDataFrame([(1, "x", None, None), (2, None, "a", None)], "doc_id long, text string, source string, n_chars long")
    assert truncation.judge(few, "doc_id", "text", "source", "n_chars").where("cut").count() == 0


def test_limits(spark):
    rng = random.Random(5)
    rows = [(("x" * 200 if i % 5 == 0 else "x" * rng.randint(20, 199)), "a") for i in range(400)] + [("y" * rng.randint(1, 400), "b") for _ in range(300)]
    got = {(r.source, r.measure): r.length for r in truncation.limits(spark.createDataFrame(rows, "t string, s string"), "s", "t").collect()}
    assert got == {("a", "chars"): 200, ("a", "bytes"): 200}


def test_nothing_else_imports_this_package():
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[2] / "pairloom"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"pairloom\.llm|from pairloom import llm", p.read_text()), p
