"""Queries over boxes, poses and cameras of scene objects.

The boxes are derived from the table ``part`` in whole millimetres, so that every comparison is exact in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import geometry as g
from pairloom.functions import instructions, text
from pairloom.operators import edits, spatial
from pairloom.operators.sampling import first_valid, ideal_or_first
from pairloom.plans.registry import query
from pairloom.session import table

#: Millimetres: grid of the joins, and the tolerances of the spatial predicates.
CELL, GAP, SKIN = 1000, 80, 20

_DUCK_BOXES = """(SELECT scene, obj, cx * 2 - sx AS lo_x, cx * 2 + sx AS hi_x, cy * 2 - sy AS lo_y, cy * 2 + sy AS hi_y, lo_z, lo_z + h AS hi_z, category, p_size FROM (
SELECT p_partkey // 50 AS scene, p_partkey AS obj, (p_partkey * p_partkey * 7 + p_partkey * 31) % 1500 - 750 AS cx, (p_partkey * p_partkey * 13 + p_partkey * 17) % 1500 - 750 AS cy, (p_partkey * 31) % 4 * 250 AS lo_z,
200 + (p_partkey * 17) % 900 AS sx, 200 + (p_partkey * 13) % 900 AS sy, 250 * (1 + (p_partkey * 7) % 3) AS h, split_part(p_name, ' ', 2) AS category, p_size FROM part))"""


def boxes(spark: SparkSession, d: str, shift: int = 0) -> DataFrame:
    """scene, obj, the corners, category and p_size; ``shift`` moves every fifth object along x."""
    k = F.col("p_partkey")
    raw = table(spark, d, "part").select(
        F.floor(k / 50).alias("scene"), k.alias("obj"), ((k * k * 7 + k * 31) % 1500 - 750).alias("cx"), ((k * k * 13 + k * 17) % 1500 - 750).alias("cy"), ((k * 31) % 4 * 250).alias("lo_z"),
        (200 + (k * 17) % 900).alias("sx"), (200 + (k * 13) % 900).alias("sy"), (250 * (1 + (k * 7) % 3)).alias("h"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("category"), "p_size",
    )
    move = F.when(F.col("obj") % 5 == 0, F.lit(shift)).otherwise(F.lit(0))
    x, y = F.col("cx") * 2 + move, F.col("cy") * 2
    return raw.select("scene", "obj", (x - F.col("sx")).alias("lo_x"), (x + F.col("sx")).alias("hi_x"), (y - F.col("sy")).alias("lo_y"), (y + F.col("sy")).alias("hi_y"), "lo_z", (F.col("lo_z") + F.col("h")).alias("hi_z"), "category", "p_size")


_CENTRE = "{i}.lo_x + {i}.hi_x >= 2 * {o}.lo_x AND {i}.lo_x + {i}.hi_x <= 2 * {o}.hi_x AND {i}.lo_y + {i}.hi_y >= 2 * {o}.lo_y AND {i}.lo_y + {i}.hi_y <= 2 * {o}.hi_y"
_SHARED = "greatest(least(a.hi_x, b.hi_x) - greatest(a.lo_x, b.lo_x), 0) * greatest(least(a.hi_y, b.hi_y) - greatest(a.lo_y, b.lo_y), 0)"
_RESTING_SQL = f"""(SELECT a.scene, a.obj AS carrier, b.obj AS carried FROM {_DUCK_BOXES} a JOIN {_DUCK_BOXES} b ON a.scene = b.scene AND a.obj <> b.obj
WHERE abs(b.lo_z - a.hi_z) <= {GAP} AND {_CENTRE.format(i='b', o='a')} AND 2 * {_SHARED} >= (b.hi_x - b.lo_x) * (b.hi_y - b.lo_y))"""


@query(_RESTING_SQL[1:-1])
def resting_on(spark: SparkSession, d: str) -> DataFrame:
    """Which objects rest on which."""
    return spatial.resting_on(boxes(spark, d), CELL, GAP)


@query(f"""SELECT a.scene, a.obj, CAST(coalesce(max(b.hi_z - a.lo_z), 0) AS BIGINT) AS depth FROM {_DUCK_BOXES} a LEFT JOIN {_DUCK_BOXES} b ON a.scene = b.scene AND a.obj <> b.obj
AND {_CENTRE.format(i='a', o='b')} AND b.lo_z < a.lo_z AND a.lo_z < b.hi_z - {SKIN} GROUP BY a.scene, a.obj""")
def support_penetration(spark: SparkSession, d: str) -> DataFrame:
    """How deep each object stands inside another."""
    return spatial.penetration(boxes(spark, d), CELL, SKIN)


_CONTACT_SQL = "SELECT a.scene, a.obj AS a, b.obj AS b FROM {t} a JOIN {t} b ON a.scene = b.scene AND a.obj < b.obj AND " + " AND ".join(f"least(a.hi_{x}, b.hi_{x}) > greatest(a.lo_{x}, b.lo_{x})" for x in "xyz")
_MOVED = f"(SELECT scene, obj, lo_x + CASE WHEN obj % 5 = 0 THEN 700 ELSE 0 END AS lo_x, hi_x + CASE WHEN obj % 5 = 0 THEN 700 ELSE 0 END AS hi_x, lo_y, hi_y, lo_z, hi_z FROM {_DUCK_BOXES})"


@query(f"{_CONTACT_SQL.format(t=_MOVED)} EXCEPT {_CONTACT_SQL.format(t=_DUCK_BOXES)}")
def aabb_contacts_new(spark: SparkSession, d: str) -> DataFrame:
    """Boxes that touch after a move and did not before."""
    return spatial.new_contacts(boxes(spark, d, 700), boxes(spark, d), CELL)


@query(f"""SELECT a.scene, a.obj, b.obj AS support, b.lo_z > 150 AS elevated FROM {_DUCK_BOXES} a JOIN {_DUCK_BOXES} b ON a.scene = b.scene AND a.obj <> b.obj WHERE b.hi_z > 80 AND b.hi_z <= 1400
AND 5 * (b.hi_x - b.lo_x) >= 7 * (a.hi_x - a.lo_x) + 500 AND 5 * (b.hi_y - b.lo_y) >= 7 * (a.hi_y - a.lo_y) + 500
AND (a.lo_x + a.hi_x - b.lo_x - b.hi_x) * (a.lo_x + a.hi_x - b.lo_x - b.hi_x) + (a.lo_y + a.hi_y - b.lo_y - b.hi_y) * (a.lo_y + a.hi_y - b.lo_y - b.hi_y) <= 4 * 3500 * 3500""")
def support_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Objects wide and low enough to take another, within reach."""
    return spatial.supports(boxes(spark, d), CELL, ground=0, low=80, high=1400, margin=50, reach=3500, raised=150)


@query(f"SELECT scene, obj, greatest(0, 300 - lo_z) AS depth, lo_x >= -2100 AND hi_x <= 2100 AND lo_y >= -2100 AND hi_y <= 2100 AS in_bounds FROM {_DUCK_BOXES}")
def floor_and_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Depth below a floor, and whether a box lies in the room less a margin."""
    inside = (F.col("lo_x") >= -2100) & (F.col("hi_x") <= 2100) & (F.col("lo_y") >= -2100) & (F.col("hi_y") <= 2100)
    return boxes(spark, d).select("scene", "obj", g.floor_depth(F.lit(300), F.col("lo_z")).alias("depth"), inside.alias("in_bounds"))


@query(f"SELECT scene, min(lo_x) AS x0, max(hi_x) AS x1, min(lo_y) AS y0, max(hi_y) AS y1, min(lo_z) AS z0, max(hi_z) AS z1 FROM {_DUCK_BOXES} GROUP BY scene")
def room_geometry(spark: SparkSession, d: str) -> DataFrame:
    """The extent of each room."""
    return boxes(spark, d).groupBy("scene").agg(F.min("lo_x").alias("x0"), F.max("hi_x").alias("x1"), F.min("lo_y").alias("y0"), F.max("hi_y").alias("y1"), F.min("lo_z").alias("z0"), F.max("hi_z").alias("z1"))


@query(f"""SELECT b.scene, b.obj, greatest(b.hi_x - b.lo_x, b.hi_y - b.lo_y, b.hi_z - b.lo_z) >= 600 AS big_enough, 10 * greatest(b.hi_x - b.lo_x, b.hi_y - b.lo_y) > 3 * r.short AS oversized
FROM {_DUCK_BOXES} b JOIN (SELECT scene, least(max(hi_x) - min(lo_x), max(hi_y) - min(lo_y)) AS short FROM {_DUCK_BOXES} GROUP BY scene) r USING (scene)""")
def size_gates(spark: SparkSession, d: str) -> DataFrame:
    """Objects long enough to be seen, and too long for their room."""
    b = boxes(spark, d)
    room = b.groupBy("scene").agg(F.least(F.max("hi_x") - F.min("lo_x"), F.max("hi_y") - F.min("lo_y")).alias("short"))
    sx, sy, sz = (F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in "xyz")
    return b.join(room, "scene").select("scene", "obj", (F.greatest(sx, sy, sz) >= 600).alias("big_enough"), (10 * F.greatest(sx, sy) > 3 * F.col("short")).alias("oversized"))


@query(f"""WITH o AS (SELECT scene, obj, category, lo_x + hi_x AS x, abs(lo_x + hi_x) + abs(lo_y + hi_y) AS dist FROM {_DUCK_BOXES}),
e AS (SELECT *, count(*) OVER w AS n, min(x) OVER w AS x0, max(x) OVER w AS x1, min(dist) OVER w AS d0, max(dist) OVER w AS d1 FROM o WINDOW w AS (PARTITION BY scene, category)),
f AS (SELECT *, count(*) FILTER (WHERE x = x0) OVER w AS nx0, count(*) FILTER (WHERE x = x1) OVER w AS nx1, count(*) FILTER (WHERE dist = d0) OVER w AS nd0, count(*) FILTER (WHERE dist = d1) OVER w AS nd1 FROM e WINDOW w AS (PARTITION BY scene, category))
SELECT scene, obj, CASE WHEN n = 1 THEN '' WHEN x = x0 AND nx0 = 1 THEN 'on the left' WHEN x = x1 AND nx1 = 1 THEN 'on the right' WHEN dist = d0 AND nd0 = 1 THEN 'nearest' WHEN dist = d1 AND nd1 = 1 THEN 'farthest' END AS phrase FROM f""")
def reference_disambiguation(spark: SparkSession, d: str) -> DataFrame:
    """How an object can be told from its like in the scene."""
    o = boxes(spark, d).select("scene", "obj", "category", (F.col("lo_x") + F.col("hi_x")).alias("x"), (F.abs(F.col("lo_x") + F.col("hi_x")) + F.abs(F.col("lo_y") + F.col("hi_y"))).alias("dist"))
    return spatial.describe_peers(o, ["scene", "category"], "x", "dist").select("scene", "obj", "phrase")


@query(f"""SELECT r.scene, r.carrier, r.carried, b.lo_x + 1000 AS moved_x, b.lo_z - a.lo_z AS dropped_z, ((a.lo_x + a.hi_x) + (b.lo_x + b.hi_x)) AS halved_x4,
(a.lo_x + a.hi_x) - ((b.lo_y + b.hi_y) - (a.lo_y + a.hi_y)) AS turned_x2 FROM {_RESTING_SQL} r JOIN {_DUCK_BOXES} a ON a.obj = r.carrier JOIN {_DUCK_BOXES} b ON b.obj = r.carried""")
def carried_follow(spark: SparkSession, d: str) -> DataFrame:
    """What is carried follows a move by 1 m, drops when its carrier goes, shrinks to half and turns by 90 degrees with it."""
    b = boxes(spark, d)
    pose = lambda side: b.select(F.col("obj").alias(side), F.array((F.col("lo_x") + F.col("hi_x")).cast("double"), (F.col("lo_y") + F.col("hi_y")).cast("double"), F.col("lo_z").cast("double")).alias(f"{side}_at"), F.col("lo_x").alias(f"{side}_x"), F.col("lo_z").alias(f"{side}_z")).hint("merge")
    r = spatial.resting_on(b, CELL, GAP).join(pose("carrier"), "carrier").join(pose("carried"), "carried")
    at, centre = F.col("carried_at"), F.col("carrier_at")
    whole = lambda x: F.round(x).cast("long")
    start = F.array(F.col("carried_x").cast("double"), F.lit(0.0), F.lit(0.0))
    return r.select(
        "scene", "carrier", "carried", whole(g.follow_move(start, F.array(F.lit(1000.0), F.lit(0.0), F.lit(0.0)))[0]).alias("moved_x"), whole(g.follow_drop(at, F.col("carrier_z"))[2]).alias("dropped_z"),
        whole(2 * g.follow_scale(at, centre, F.lit(0.5), F.lit(0.0))[0]).alias("halved_x4"), whole(g.follow_turn(at, centre, F.lit(90.0))[0]).alias("turned_x2"),
    )


@query(f"SELECT obj, sqrt(CAST(lo_x * lo_x + lo_y * lo_y + lo_z * lo_z AS DOUBLE)) AS length FROM {_DUCK_BOXES}")
def move_magnitude(spark: SparkSession, d: str) -> DataFrame:
    """The length of a move."""
    v = F.array(*[F.col(f"lo_{a}").cast("double") for a in "xyz"])
    return boxes(spark, d).select("obj", g.norm(v).alias("length"))


_WORDS_SQL = f"""(SELECT obj, lo_x AS dx, lo_y AS dy, lo_z AS dz, [x.w for x in list_filter(list_reverse_sort([{{'r': abs(lo_x), 'w': CASE WHEN lo_x > 0 THEN 'right' ELSE 'left' END}},
{{'r': abs(lo_z), 'w': CASE WHEN lo_z > 0 THEN 'up' ELSE 'down' END}}, {{'r': abs(lo_y), 'w': CASE WHEN lo_y > 0 THEN 'farther' ELSE 'closer' END}}]),
lambda x: x.r / sqrt(CAST(lo_x * lo_x + lo_y * lo_y + lo_z * lo_z AS DOUBLE)) >= 0.15)][1:2] AS words FROM {_DUCK_BOXES} WHERE lo_x <> 0 OR lo_y <> 0 OR lo_z <> 0)"""


def _words(spark: SparkSession, d: str) -> DataFrame:
    axis = lambda *v: F.array(*map(F.lit, v))
    delta = F.array(*[F.col(f"lo_{a}").cast("double") for a in "xyz"])
    b = boxes(spark, d).where("lo_x <> 0 or lo_y <> 0 or lo_z <> 0")
    return b.select("obj", "lo_x", "lo_y", g.direction_words(delta, axis(1.0, 0.0, 0.0), axis(0.0, 0.0, 1.0), axis(0.0, 1.0, 0.0)).alias("words"))


@query(f"SELECT obj, array_to_string(words, ',') AS words FROM {_WORDS_SQL}")
def classify_translation(spark: SparkSession, d: str) -> DataFrame:
    """The words for a move as a camera along y sees it."""
    return _words(spark, d).select("obj", F.concat_ws(",", "words").alias("words"))


@query(f"""SELECT obj, CASE WHEN len(words) = 0 THEN 'slightly' WHEN len(list_filter(words, lambda w: w IN ('left', 'right', 'up', 'down'))) = len(words) THEN 'to the ' || array_to_string(list_reverse(words), ' ')
ELSE array_to_string([CASE w WHEN 'closer' THEN 'closer to the camera' WHEN 'farther' THEN 'away from the camera' ELSE w END for w in words], ', ') END AS phrase FROM {_WORDS_SQL}""")
def semantic_phrase(spark: SparkSession, d: str) -> DataFrame:
    """Those words as a phrase."""
    return _words(spark, d).select("obj", g.direction_phrase(F.col("words")).alias("phrase"))


@query(f"""SELECT obj, len(list_filter(words, lambda w: (w = 'left' AND NOT dx - 700 < 0) OR (w = 'right' AND NOT dx - 700 > 0) OR (w = 'up' AND NOT dy < 0) OR (w = 'down' AND NOT dy > 0))) = 0 AS consistent FROM {_WORDS_SQL}""")
def direction_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Whether a pixel move agrees with the words."""
    return _words(spark, d).select("obj", g.direction_consistent(F.col("words"), F.col("lo_x") - 700, F.col("lo_y")).alias("consistent"))


@query("""SELECT p_partkey, cos(radians(CAST(p_size * 7 AS DOUBLE)) / 2) AS w, sin(radians(CAST(p_size * 7 AS DOUBLE)) / 2) AS z FROM part""")
def axis_angle_quat(spark: SparkSession, d: str) -> DataFrame:
    """The quaternion of a turn about an axis of any length."""
    q = g.axis_angle_quat(F.array(F.lit(0.0), F.lit(0.0), F.lit(5.0)), (F.col("p_size") * 7).cast("double"))
    return table(spark, d, "part").select("p_partkey", q[0].alias("w"), q[3].alias("z"))


@query("""SELECT p_partkey, CAST(round(1000000 * (1 - 2 * z * z / n)) AS BIGINT) AS m00, CAST(round(1000000 * (-2 * w * z / n)) AS BIGINT) AS m01, 1 AS right_x FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS w, CAST(p_size % 7 AS DOUBLE) AS z, CAST(p_size * p_size + (p_size % 7) * (p_size % 7) AS DOUBLE) AS n FROM part)""")
def quat_matrix_and_basis(spark: SparkSession, d: str) -> DataFrame:
    """A quaternion's matrix, and the camera basis of an identity pose."""
    m = g.quat_matrix(F.array(F.col("p_size").cast("double"), F.lit(0.0), F.lit(0.0), (F.col("p_size") % 7).cast("double")))
    eye = F.array(*[F.array(*[F.lit(1.0 if i == j else 0.0) for j in range(4)]) for i in range(4)])
    micro = lambda x: F.round(1_000_000 * x).cast("long")
    return table(spark, d, "part").select("p_partkey", micro(m[0][0]).alias("m00"), micro(m[0][1]).alias("m01"), g.camera_basis(eye)["right"][0].cast("int").alias("right_x"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN 'tipped' WHEN d >= 135 THEN 'opposite_side' WHEN d >= 45 THEN 'side_face' ELSE 'partial_turn' END AS kind,
CASE WHEN abs(p_partkey % 21 - 10) >= 7 THEN CASE WHEN (p_size * 23 - 500) * (p_partkey % 21 - 10) > 0 THEN 'clockwise' ELSE 'counterclockwise' END END AS turn
FROM (SELECT *, CASE WHEN abs(p_size * 23 - 500) % 360 > 180 THEN 360 - abs(p_size * 23 - 500) % 360 ELSE abs(p_size * 23 - 500) % 360 END AS d FROM part)""")
def rotate_view_change(spark: SparkSession, d: str) -> DataFrame:
    """What a turn shows, and which way it goes as seen."""
    deg = (F.col("p_size") * 23 - 500).cast("double")
    axis = F.when(F.col("p_partkey") % 3 == 0, "Z").otherwise("X")
    return table(spark, d, "part").select("p_partkey", g.view_change(axis, deg).alias("kind"), g.turn_direction(deg, (F.col("p_partkey") % 21 - 10) / 10.0).alias("turn"))


_CLIP = "greatest(least({hi}, {n}) - greatest({lo}, 0), 0)"
_AREA = f"{_CLIP.format(lo='{0}.lo_x', hi='{0}.hi_x', n=800)} * {_CLIP.format(lo='{0}.lo_y', hi='{0}.hi_y', n=600)}"
_BOTH = f"{_CLIP.format(lo='greatest(a.lo_x, b.lo_x)', hi='least(a.hi_x, b.hi_x)', n=800)} * {_CLIP.format(lo='greatest(a.lo_y, b.lo_y)', hi='least(a.hi_y, b.hi_y)', n=600)}"


@query(f"""SELECT a.obj, CAST({_AREA.format('a')} AS DOUBLE) / 480000 AS area_ratio, CAST({_AREA.format('a')} + {_AREA.format('b')} - 2 * ({_BOTH}) AS DOUBLE) / 480000 AS change_ratio
FROM {_DUCK_BOXES} a JOIN {_MOVED} b USING (obj)""")
def projected_ratios(spark: SparkSession, d: str) -> DataFrame:
    """The share of the image that a box covers, and the share that changes when it moves."""
    now, then = boxes(spark, d), boxes(spark, d, 700).select("obj", *[F.col(c).alias(f"to_{c}") for c in ("lo_x", "lo_y", "hi_x", "hi_y")])
    box = lambda p: tuple(F.col(f"{p}{c}") for c in ("lo_x", "lo_y", "hi_x", "hi_y"))
    w, h = F.lit(800), F.lit(600)
    return now.join(then, "obj").select("obj", g.area_ratio(*box(""), w, h).alias("area_ratio"), g.projected_change(box(""), box("to_"), w, h).alias("change_ratio"))


@query("""SELECT k AS p_partkey, coalesce(bool_or(a * k % 11 >= 7), false) AS ok, coalesce(min(CASE WHEN a * k % 11 >= 7 THEN a END), max(a)) AS n_tries FROM (SELECT p_partkey AS k, CAST(unnest(range(1, 6)) AS INT) AS a FROM part) GROUP BY k""")
def find_valid_first_attempt(spark: SparkSession, d: str) -> DataFrame:
    """Rejection sampling as rows: the first of five attempts that passes."""
    tries = table(spark, d, "part").select("p_partkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("a"))
    return first_valid(tries, ["p_partkey"], "a", F.col("a") * F.col("p_partkey") % 11 >= 7)


@query("""SELECT p_partkey, p_partkey + t * 100000 AS seed FROM (SELECT p_partkey, min(t) AS t FROM (SELECT p_partkey, unnest(range(0, 4)) AS t FROM part) WHERE (p_partkey + t * 100000) % 13 < 5 GROUP BY p_partkey)""")
def retry_first_success(spark: SparkSession, d: str) -> DataFrame:
    """Retries with shifted seeds; the first that succeeds."""
    seeds = table(spark, d, "part").select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("t")).withColumn("seed", F.col("p_partkey") + F.col("t") * 100_000)
    return seeds.where("seed % 13 < 5").groupBy("p_partkey").agg(F.min("seed").alias("seed"))


@query("""SELECT s AS p_partkey, pick FROM (SELECT s, pick, row_number() OVER (PARTITION BY s ORDER BY CASE WHEN pick % 2 = s % 2 THEN 0 ELSE 1 END, a) AS r FROM (SELECT p_partkey AS s, a, (p_partkey * 37 + a * 101) % 97 AS pick FROM part, (SELECT CAST(unnest(range(1, 13)) AS INT) AS a)) WHERE a <= 10 AND pick <> s AND pick > 40) WHERE r = 1""")
def replacement_pick(spark: SparkSession, d: str) -> DataFrame:
    """Of ten draws the first ideal one, else the first legal one, never the object itself."""
    k = F.col("p_partkey")
    draws = table(spark, d, "part").select("p_partkey", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("a")).withColumn("pick", (k * 37 + F.col("a") * 101) % 97)
    return ideal_or_first(draws, ["p_partkey"], "a", F.col("pick") % 2 == k % 2, (F.col("pick") != k) & (F.col("pick") > 40)).select("p_partkey", "pick")


@query("""SELECT p_partkey, list_filter(['support_surface', CASE WHEN p_size % 2 = 0 THEN 'object_top' END, CASE WHEN p_size % 3 = 0 THEN 'ceiling' END, CASE WHEN p_size % 3 = 0 AND p_size % 5 < 3 THEN 'wall' END, 'floating'], lambda x: x IS NOT NULL) AS modes,
greatest(800, p_size * 25) AS min_distance, CASE WHEN p_size * 10 - 100 <= 100 THEN (p_size * 10 - 100 + 100) // 2 ELSE 100 END AS safe FROM part""")
def placement_modes(spark: SparkSession, d: str) -> DataFrame:
    """The ways of placing an object, its least move, and a range that never inverts."""
    n = F.col("p_size")
    modes = F.array_compact(F.array(F.lit("support_surface"), F.when(n % 2 == 0, "object_top"), F.when(n % 3 == 0, "ceiling"), F.when((n % 3 == 0) & (n % 5 < 3), "wall"), F.lit("floating")))
    hi = n * 10 - 100
    return table(spark, d, "part").select("p_partkey", modes.alias("modes"), F.greatest(F.lit(800), n * 25).alias("min_distance"), F.when(hi <= 100, F.floor((hi + 100) / 2)).otherwise(F.lit(100)).alias("safe"))


_TOLD_SQL = "CASE WHEN phrase IN ('nearest', 'farthest') THEN phrase || ' ' || noun WHEN phrase <> '' THEN noun || ' ' || phrase ELSE noun END"
_WALL_SQL = f"(list_contains([{', '.join(repr(w) for w in text.WALL_INTEGRATED)}], noun) OR list_has_any(string_split(noun, '_'), [{', '.join(repr(w) for w in text.WALL_INTEGRATED)}]))"


def _patterns(case: str) -> str:
    return "[" + ", ".join(f"'{p}'" for p in instructions.PATTERNS[case]) + f"][obj % {len(instructions.PATTERNS[case])} + 1]"


@query(f"""WITH o AS (SELECT scene, obj, CASE WHEN p_size % 5 = 0 THEN 'tall_bookshelf' WHEN p_size % 7 = 0 THEN 'rug' ELSE category END AS noun, lo_x + hi_x AS x, abs(lo_x + hi_x) + abs(lo_y + hi_y) AS dist FROM {_DUCK_BOXES} WHERE obj % 9 <> 0),
e AS (SELECT *, count(*) OVER w AS n, min(x) OVER w AS x0, max(x) OVER w AS x1, min(dist) OVER w AS d0, max(dist) OVER w AS d1 FROM o WINDOW w AS (PARTITION BY scene, noun)),
f AS (SELECT *, count(*) FILTER (WHERE x = x0) OVER w AS nx0, count(*) FILTER (WHERE x = x1) OVER w AS nx1, count(*) FILTER (WHERE dist = d0) OVER w AS nd0, count(*) FILTER (WHERE dist = d1) OVER w AS nd1 FROM e WINDOW w AS (PARTITION BY scene, noun)),
p AS (SELECT scene, obj, noun, CASE WHEN n = 1 THEN '' WHEN x = x0 AND nx0 = 1 THEN 'on the left' WHEN x = x1 AND nx1 = 1 THEN 'on the right' WHEN dist = d0 AND nd0 = 1 THEN 'nearest' WHEN dist = d1 AND nd1 = 1 THEN 'farthest' END AS phrase FROM f),
g AS (SELECT *, ['object_move', 'object_scale', 'object_rotate', 'object_delete', 'object_add', 'object_replace'][obj % 6 + 1] AS op FROM p),
h AS (SELECT *, CASE WHEN op <> 'object_add' AND phrase IS NULL THEN 'ambiguous' WHEN op IN ('object_move', 'object_rotate', 'object_replace') AND {_WALL_SQL} THEN 'wall_integrated' WHEN op = 'object_replace' AND contains(noun, 'rug') THEN 'floor_cover' END AS discard FROM g)
SELECT scene, obj, op, discard, CASE WHEN discard IS NULL THEN replace(replace(replace(replace(replace(CASE op WHEN 'object_move' THEN {_patterns('object_move')} WHEN 'object_scale' THEN CASE WHEN obj % 4 >= 2 THEN {_patterns('object_scale up')} ELSE {_patterns('object_scale down')} END
 WHEN 'object_rotate' THEN {_patterns('object_rotate')} WHEN 'object_delete' THEN {_patterns('object_delete')} WHEN 'object_add' THEN {_patterns('object_add on a support')} ELSE {_patterns('object_replace')} END,
 '{{ref}}', {_TOLD_SQL}), '{{noun}}', noun), '{{to}}', 'vase'), '{{support}}', 'desk'), '{{phrase}}', 'to the left') END AS instruction FROM h""")
def edit_operators(spark: SparkSession, d: str) -> DataFrame:
    """Every edit operator over its share of the visible objects: gates, how the subject is told apart, and the instruction."""
    noun = F.when(F.col("p_size") % 5 == 0, "tall_bookshelf").when(F.col("p_size") % 7 == 0, "rug").otherwise(F.col("category"))
    o = boxes(spark, d).where("obj % 9 <> 0").select("scene", "obj", noun.alias("noun"), (F.col("lo_x") + F.col("hi_x")).alias("x"), (F.abs(F.col("lo_x") + F.col("hi_x")) + F.abs(F.col("lo_y") + F.col("hi_y"))).alias("dist"))
    told = spatial.describe_peers(o, ["scene", "noun"], "x", "dist").select("scene", "obj", "noun", F.col("noun").alias("category"), "phrase", F.lit("vase").alias("to_noun"), F.lit("desk").alias("support_noun"), F.array(F.lit("left")).alias("words"))
    out = None
    for k, operator in enumerate(edits.OPERATORS.values()):
        part = operator.apply(told.where(F.col("obj") % 6 == k), F.col("obj")).select("scene", "obj", "op", "discard", "instruction")
        out = part if out is None else out.unionByName(part)
    return out
