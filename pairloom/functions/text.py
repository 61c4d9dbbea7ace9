"""Names, nouns, instructions and captions as native column expressions.

Null input gives null unless a function names a default; all patterns are Java regular expressions, in which ``\\b``
knows letters beyond ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def display_noun(category: Column | str) -> Column:
    """``date_(fruit)`` -> ``date``, ``coffee_table`` -> ``coffee table``; nothing left -> ``object``."""
    bare = F.regexp_replace(F.coalesce(_c(category), F.lit("")), r"\(.*?\)", "")
    spaced = F.trim(F.regexp_replace(F.translate(bare, "_-", "  "), r"\s+", " "))
    return F.coalesce(F.nullif(spaced, F.lit("")), F.lit("object"))


def tokens(x: Column | str) -> Column:
    """Lower-case runs of ASCII letters."""
    return F.filter(F.split(F.lower(F.coalesce(_c(x), F.lit(""))), r"[^a-zA-Z]+"), lambda t: t != "")


# Words of asset names and tags that are no noun for the object.
NOT_A_NOUN = (
    "3d", "model", "models", "scan", "3dscan", "scaniverse", "photogrammetry", "trnio", "lowpoly", "low", "high", "poly", "gameready", "game", "ready", "pbr",
    "textured", "texture", "blender", "maya", "zbrush", "substance", "render", "cg", "asset", "free", "download", "sketchfab", "mesh", "uv", "rigged", "animated",
    "realistic", "handpainted", "hand", "painted", "art", "decor", "decoration", "design", "vintage", "modern", "antique", "old", "new", "set", "collection", "prop",
    "object", "thing", "food", "animal", "furniture", "the", "and", "with", "for", "by",
)


def noun_tokens(words: Column) -> Column:
    """The words of an array that can name an object: letters only, three at least, none of the stop list."""
    return F.filter(words, lambda t: t.rlike("^[a-z]{3,}$") & ~t.isin(*NOT_A_NOUN))


def best_noun(category: Column | str, name: Column | str, tags: Column | str) -> Column:
    """The category's noun if name or tags echo it, else the first fit word of the tags, else of the name, else the category's noun."""
    noun = display_noun(category)
    tag_words = F.flatten(F.transform(F.coalesce(_c(tags), F.array().cast("array<string>")), tokens))
    name_words = tokens(name)
    heard = F.concat(name_words, tag_words)
    near = lambda a, b: (F.length(a) >= 4) & (F.length(b) >= 4) & (F.contains(a, b) | F.contains(b, a))
    echoed = F.exists(tokens(noun), lambda a: F.exists(heard, lambda b: (a == b) | near(a, b)))
    return F.when(echoed & (noun != "object"), noun).otherwise(F.coalesce(F.get(noun_tokens(tag_words), F.lit(0)), F.get(noun_tokens(name_words), F.lit(0)), noun))


def norm_category(x: Column | str) -> Column:
    """Lower case without ``_(…)``, hyphens as underscores, single underscores, none at the ends."""
    low = F.regexp_replace(F.trim(F.lower(_c(x))), r"_?\([^)]*\)", "")
    return F.regexp_replace(F.regexp_replace(F.translate(low, "-", "_"), "_+", "_"), "^_|_$", "")


# Categories that are part of a wall or the building.
WALL_INTEGRATED = (
    "cabinet", "cupboard", "wardrobe", "closet", "armoire", "mirror", "picture", "painting", "poster", "shelf", "shelves", "bookshelf", "bookcase", "headboard",
    "bed", "sink", "vanity", "toilet", "bathtub", "shower", "window", "door", "curtain", "drape", "blind", "blinds", "radiator", "fireplace", "stair", "stairs",
    "staircase", "counter", "countertop", "dishwasher", "washer", "dryer", "oven", "stove", "refrigerator", "fridge", "sconce", "chandelier",
)

# Parts of names that mark the structure of a room.
STRUCTURE = ("wall", "floor", "ceiling", "baseboard", "pocket", "front", "back", "slab", "hole", "door", "window", "column", "beam", "ceil", "cornice")

# Parts of names of flat floor coverings.
FLOOR_COVER = ("carpet", "rug", " mat", "mat ", "runner", "carpeting")


def is_wall_integrated(category: Column | str) -> Column:
    n = norm_category(category)
    return F.coalesce(n.isin(*WALL_INTEGRATED) | F.arrays_overlap(F.split(n, "_"), F.array(*map(F.lit, WALL_INTEGRATED))), F.lit(False))


def is_floor_cover(noun: Column | str) -> Column:
    low = F.lower(_c(noun))
    return F.coalesce(F.exists(F.array(*map(F.lit, FLOOR_COVER)), lambda k: F.contains(low, k)), F.lit(False))


def is_furniture(name: Column | str) -> Column:
    return ~F.coalesce(F.lower(_c(name)).rlike("|".join(STRUCTURE)), F.lit(False))


def source_of_uid(uid: Column | str) -> Column:
    """``hssd:1`` -> ``hssd``, ``prim_CUBE`` -> ``primitive``, else ``objaverse``."""
    u = _c(uid)
    return F.when(F.contains(u, F.lit(":")), F.substring_index(u, ":", 1)).when(F.startswith(u, F.lit("prim_")), "primitive").when(u.isNotNull(), "objaverse")


def _quoted(x: Column) -> Column:
    return F.regexp_replace(x, r"([^\w\s])", r"\\$1")


# The phrase that names an object (before and after its noun), a place at the end, and phrases that tell alike objects apart.
REFERENCE = (r"(?i)(the\s+[^,.;]*?\b", r"\b(?:\s+on\s+the\s+(?:left|right))?)")
LOCATION = r"(?i)\b((?:on top of|onto|into|in the|on the|next to|near|to the)\s+[^,.;]+)$"
TOLD_APART = r"\b(on the left|on the right|nearest|farthest)\b"


def reference_phrase(base: Column | str, noun: Column | str) -> Column:
    """The phrase by which an instruction names its object (``the chair on the left``), else ``the <noun>``."""
    n = F.nullif(_c(noun), F.lit(""))
    pattern = F.concat(F.lit(REFERENCE[0]), _quoted(n), F.lit(REFERENCE[1]))
    found = F.nullif(F.trim(F.call_function("regexp_extract", _c(base), pattern, F.lit(1))), F.lit(""))
    return F.coalesce(found, F.concat(F.lit("the "), F.coalesce(n, F.lit("object"))))


def location_tail(base: Column | str) -> Column:
    """The place at the end of an instruction (``next to the sofa``); only without a closing stop."""
    return F.nullif(F.trim(F.regexp_extract(F.trim(_c(base)), LOCATION, 1)), F.lit(""))


# Factors that may be told as a number.
ROUND_FACTORS = (0.25, 0.5, 0.75, 1.25, 1.5, 2.0, 3.0)


def scale_bucket(factor: Column | str) -> Column:
    f = _c(factor)
    r = F.when(f >= 1, f).when(f > 0, 1 / f).otherwise(F.lit(1.0))
    return F.when(f.isNotNull(), F.when(r >= 1.9, "much").when(r >= 1.4, "moderately").otherwise("slightly"))


def is_round_factor(factor: Column | str) -> Column:
    f = _c(factor)
    return F.exists(F.array(*map(F.lit, ROUND_FACTORS)), lambda x: F.abs(f - x) < 0.02)


def shrink_times(factor: Column | str) -> Column:
    f = _c(factor)
    return F.when((f > 0) & (f < 1), F.bround(1 / f, 2))


def number_text(x: Column | str) -> Column:
    """A number of six significant digits without trailing zeros, with an exponent below -4 and from 6 on: 1.5, 2, 1e+06."""
    x = _c(x).cast("double")
    bare = lambda n: F.when(F.contains(n, F.lit(".")), F.regexp_replace(n, r"\.?0+$", "")).otherwise(n)
    said = F.format_string("%.5e", x)
    power = F.substring_index(said, "e", -1).cast("int")
    out = F.concat(bare(F.substring_index(said, "e", 1)), F.lit("e"), F.substring_index(said, "e", -1))
    for p in range(-4, 6):
        out = F.when(power == p, bare(F.format_string(f"%.{5 - p}f", x))).otherwise(out)
    return F.when(x.isNotNull(), F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lower(x.cast("string"))).otherwise(out))


def html_escape(x: Column | str) -> Column:
    return F.replace(F.replace(F.replace(_c(x), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def is_disambiguated(instruction: Column | str) -> Column:
    return F.coalesce(_c(instruction).rlike(TOLD_APART), F.lit(False))


# What a caption of each operation must not say.
FORBIDDEN = {
    "object_delete": r"\b(add|insert|place a|put a)\b|添加|加一个|加个|放一个|放个|新增",
    "object_add": r"\b(remove|delete|erase|get rid of)\b|删掉|移除|去掉|弄走",
    "object_move": r"\b(delete|rotate|resize)\b|删掉|旋转|缩放",
    "object_rotate": r"\b(delete|remove|resize)\b|删掉|移除|缩放",
    "object_replace": r"\b(delete|remove)\b|删掉|移除",
}
# Words for directions and sizes, each with its opposite's key and the reasons given.
DIRECTIONS = {
    "left": (r"\bleft\b|左", "right", "move: 应向左却说右"),
    "right": (r"\bright\b|右", "left", "move: 应向右却说左"),
    "up": (r"\b(up|higher|raise|above)\b|往上|向上|上方|抬高", "down", "move: 应向上却说下"),
    "down": (r"\b(down|lower|below)\b|往下|向下|下方|放低", "up", "move: 应向下却说上"),
    "closer": (r"\b(closer|nearer|toward|forward)\b|靠近|往前|向前|近处", "farther", "move: 应更近却说远"),
    "farther": (r"\b(farther|further|away|behind)\b|远处|后退|往后|向后", "closer", "move: 应更远却说近"),
}
BIGGER = r"\b(bigger|larger|enlarge|grow|scale up)\b|放大|变大|调大"
SMALLER = r"\b(smaller|shrink|scale down|tinier)\b|缩小|变小|调小"
# The verbs of removal before the new object's noun.
REMOVED = r"(remove|delete|get rid of|删掉|移除).*"
CLOCKWISE, COUNTER = r"\bclockwise\b|顺时针", r"\bcounter[- ]?clockwise\b|逆时针"


def contradicts(text: Column, wanted: str, opposite: str) -> Column:
    return text.rlike(opposite) & ~text.rlike(wanted)


def caption_faults(caption: Column | str, op: Column | str, direction: Column | str, scale_dir: Column | str, turn: Column | str, to_noun: Column | str) -> Column:
    """The reasons why a caption contradicts the facts of its edit, in a fixed order; an empty array if none does."""
    text = F.lower(F.trim(F.coalesce(_c(caption), F.lit(""))))
    op, words = _c(op), F.coalesce(_c(direction), F.array().cast("array<string>"))
    said = lambda cond, reason: F.when(F.coalesce(cond, F.lit(False)), F.lit(reason))
    found = [said((op == k) & text.rlike(p), f"{k}: caption 用了对立动词") for k, p in FORBIDDEN.items()]
    found += [said((op == "object_move") & F.array_contains(words, w) & contradicts(text, p, DIRECTIONS[o][0]), why) for w, (p, o, why) in DIRECTIONS.items()]
    scale, turned = (op == "object_scale"), (op == "object_rotate")
    found += [
        said(scale & (_c(scale_dir) == "bigger") & contradicts(text, BIGGER, SMALLER), "scale: 应放大却说缩小"),
        said(scale & (_c(scale_dir) == "smaller") & contradicts(text, SMALLER, BIGGER), "scale: 应缩小却说放大"),
        said(turned & (_c(turn) == "clockwise") & contradicts(text, CLOCKWISE, COUNTER), "rotate: 应顺时针却说逆时针"),
        said(turned & (_c(turn) == "counterclockwise") & contradicts(text, COUNTER, CLOCKWISE), "rotate: 应逆时针却说顺时针"),
    ]
    to = F.lower(F.nullif(_c(to_noun), F.lit("")))
    found.append(said((op == "object_replace") & F.call_function("rlike", text, F.concat(F.lit(REMOVED), _quoted(to))), "replace: 把新物体说成被删掉"))
    return F.when(F.length(text) < 2, F.array(F.lit("empty caption"))).otherwise(F.array_compact(F.array(*found)))


# The longest side of common categories, in metres.
CATEGORY_SIZES = {
    "chair": 1.0, "table": 1.2, "desk": 1.2, "sofa": 2.0, "bed": 2.0, "couch": 2.0, "wardrobe": 1.8, "cabinet": 1.0, "dresser": 1.2, "bookshelf": 1.6, "shelf": 0.8, "stool": 0.5, "bench": 1.2, "nightstand": 0.5, "coffee_table": 1.0,
    "lamp": 0.5, "table_lamp": 0.4, "laptop": 0.35, "keyboard": 0.45, "television_set": 0.9, "remote_control": 0.18, "telephone": 0.16, "camera": 0.14, "clock": 0.22,
    "vase": 0.28, "pottery": 0.24, "bottle": 0.25, "cup": 0.1, "mug": 0.1, "bowl": 0.2, "plate": 0.25, "tray": 0.38, "casserole": 0.3, "pitcher": 0.25, "jar": 0.18, "can": 0.12, "spice_rack": 0.3, "basket": 0.35, "hamper": 0.5,
    "book": 0.25, "Bible": 0.25, "notebook": 0.26, "magazine": 0.3, "eraser": 0.08, "pen": 0.15, "pencil": 0.18, "ruler": 0.3, "scissors": 0.18,
    "apple": 0.08, "banana": 0.2, "sandwich": 0.16, "date": 0.06, "truffle": 0.05, "turnip": 0.1, "orange": 0.08, "lemon": 0.07, "egg": 0.06, "bread": 0.2, "cake": 0.22,
    "candle": 0.18, "picture_frame": 0.3, "painting": 0.6, "picture": 0.5, "figurine": 0.18, "potted_plant": 0.4, "tobacco_pipe": 0.15, "ball": 0.22, "Band_Aid": 0.07, "toy": 0.2,
}

# Nouns of the primitive shapes.
PRIMITIVES = {"CUBE": "cube", "SPHERE": "ball", "CYLINDER": "can", "CONE": "cone", "MONKEY": "head"}


def category_size(category: Column | str, default: float, sizes: dict[str, float] | None = None) -> Column:
    """The size of a category in the map given, without a map or an entry the default."""
    if not sizes:
        return F.lit(float(default))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])[_c(category)], F.lit(float(default)))


def primitive_noun(uid: Column | str) -> Column:
    """``prim_CYLINDER`` -> ``can``, another primitive -> ``object``; null for what is no primitive."""
    kind = F.create_map(*[F.lit(x) for kv in PRIMITIVES.items() for x in kv])[F.substring(_c(uid), 6, 1000)]
    return F.when(F.startswith(_c(uid), F.lit("prim_")), F.coalesce(kind, F.lit("object")))


def object_noun(noun: Column | str, category: Column | str) -> Column:
    """How an object is called: its noun, else its category, else ``object``."""
    return F.coalesce(F.nullif(_c(noun), F.lit("")), F.nullif(_c(category), F.lit("")), F.lit("object"))


def support_noun(noun: Column | str, category: Column | str) -> Column:
    """How what carries an object is called: its category, else its noun, in words; the bare word ``object`` is no name."""
    named = lambda x: F.when(~x.isin("", "object"), F.replace(x, F.lit("_"), F.lit(" ")))
    return F.coalesce(named(_c(category)), named(_c(noun)))
