"""Template captions: a dimension table of patterns by operation, language and style, joined and filled in.

A pattern's words in braces stand for columns of the facts. A style that an operation lacks falls back to ``direct``;
of a style with two patterns a draw chooses, without a draw it is the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import text

STYLES = ("direct", "spatial", "intent", "goal", "casual")
# Target weights of styles and languages, and the styles that an operation does not take.
STYLE_WEIGHTS = {"direct": 1.0, "spatial": 1.0, "intent": 1.0, "goal": 0.6, "casual": 0.8}
LANGUAGE_WEIGHTS = {"zh": 0.8, "en": 0.2}
BLOCKED = {"object_scale": ("goal",), "object_rotate": ("goal",)}


def allowed(op: Column | str) -> Column:
    """The styles that an operation takes, in order."""
    out = F.array(*map(F.lit, STYLES))
    for name, blocked in BLOCKED.items():
        out = F.when((F.col(op) if isinstance(op, str) else op) == name, F.array(*[F.lit(s) for s in STYLES if s not in blocked])).otherwise(out)
    return out


# The patterns, in the order of the styles; two patterns of a style are parted by a bar.
TEMPLATES = {
    ("object_delete", "zh"): ("删掉{ref}", "把{ref}从画面里移除", "我不想看到{ref}|把{ref}弄走", "把这里收拾干净", "把{ref}删了吧"),
    ("object_delete", "en"): ("Remove {ref}.", "Take {ref} out of the scene.", "I don't want to see {ref}.|Get rid of {ref}.", "Clear the clutter here.", "just get rid of {ref}"),
    ("object_add", "zh"): ("加一个{noun}", "在场景里放一个{noun}", "我想要一个{noun}", "这里可以摆个{noun}", "放个{noun}吧"),
    ("object_add", "en"): ("Add a {noun} {loc}.", "Place a {noun} {loc}.", "I'd like a {noun} {loc}.", "This spot could use a {noun}.", "put a {noun} {loc}"),
    ("object_move", "zh"): ("把{ref}往{dir}挪", "把{ref}移到{dir}", "{ref}该往{dir}点", "重新摆一下{ref}", "{ref}挪{dir}去"),
    ("object_move", "en"): ("Move {ref} {tail}.", "Move {ref} {tail}.", "{Ref} should be {tail}.", "Rearrange so {ref} sits {tail}.", "shift {ref} {tail}"),
    ("object_scale", "zh"): ("把{ref}{scale}", "把{ref}{scale}", "我想把{ref}{scale}", None, "{ref}{scale}"),
    ("object_scale", "en"): ("Make {ref} {scale}.", "Resize {ref} {scale}.", "I want {ref} {scale}.", None, "make {ref} {scale}"),
    ("object_rotate", "zh"): ("把{ref}{turn}", "把{ref}{turn}", "我想从另一个角度看{ref}|把{ref}{turn}", None, "{ref}{turn}"),
    ("object_rotate", "en"): ("Turn {ref} {turn}.", "Rotate {ref} {turn}.", "I want to see {ref} from another angle.|Turn {ref} {turn}.", None, "spin {ref} {turn}"),
    ("object_replace", "zh"): ("把{from}换成{to}", "用{to}替换掉{from}", "我不太喜欢{from}，换成{to}吧", "把{from}变成{to}", "{from}换成{to}"),
    ("object_replace", "en"): ("Replace the {from} with a {to}.", "Swap the {from} for a {to}.", "I'd rather have a {to} instead of the {from}.", "Change the {from} into a {to}.", "make the {from} a {to}"),
}
# Words for directions, size steps and turned views.
DIRECTION_ZH = {"left": "左边", "right": "右边", "up": "上面", "down": "下面", "closer": "近处", "farther": "远处"}
BUCKET = {"zh": {"slightly": "稍微", "moderately": "明显", "much": "大幅"}, "en": {"slightly": "a bit", "moderately": "noticeably", "much": "much"}}
VIEW = {
    "zh": {"opposite_side": "转过来背面对着我", "side_face": "转到侧面给我看", "partial_turn": "转一点", "tipped": "翻到侧面"},
    "en": {"opposite_side": "so its back faces me", "side_face": "so I see it from the side", "partial_turn": "a little", "tipped": "onto its side"},
}
# How sizes and turns are said, in Chinese and in English; n: a number, step and view: words from above, side: a sense of turning.
PHRASES = {
    "times bigger": ("放大{n}倍", "{n}× bigger"),
    "half": ("缩小到一半", "half its size"),
    "times smaller": ("缩小到原来的{n}倍", "{n}× its original size"),
    "bigger": ("{step}放大", "{step} bigger"),
    "smaller": ("{step}缩小", "{step} smaller"),
    "degrees": ("{side}转{n}度", "{n}° {side}"),
    "view": ("{view}", "{view}"),
    "other view": ("转一下", "around"),
}
SIDES_ZH = {"clockwise": "顺时针", "counterclockwise": "逆时针"}


def dimension(spark: SparkSession) -> DataFrame:
    """op, lang, style, patterns: at most 60 rows."""
    rows = [(op, lang, style, (p or patterns[0]).split("|")) for (op, lang), patterns in TEMPLATES.items() for style, p in zip(STYLES, patterns)]
    return spark.createDataFrame(rows, "op string, lang string, style string, patterns array<string>")


def _lookup(words: dict[str, str], x: Column) -> Column:
    return F.create_map(*[F.lit(w) for kv in words.items() for w in kv])[x]


def _in(lang: Column, words: dict[str, dict[str, str]], x: Column) -> Column:
    return F.when(lang == "zh", _lookup(words["zh"], x)).otherwise(_lookup(words["en"], x))


def phrase(case: Column, lang: Column, **words: Column) -> Column:
    """The phrase of a case in a language, with its words put in."""
    out = _in(lang, {"zh": {k: v[0] for k, v in PHRASES.items()}, "en": {k: v[1] for k, v in PHRASES.items()}}, case)
    for name, value in words.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def scale_words(factor: Column, round_: Column, lang: Column) -> Column:
    """How a change of size is said: by its number if that is a round one, else by its step."""
    told = round_ & factor.isNotNull()
    case = F.when(factor > 1, F.when(told, "times bigger").otherwise("bigger")).when(told, F.when(F.abs(factor - 0.5) < 0.02, "half").otherwise("times smaller")).otherwise("smaller")
    return phrase(case, lang, n=text.number_text(factor), step=_in(lang, BUCKET, F.coalesce(text.scale_bucket(factor), F.lit("moderately"))))


def turn_words(degrees: Column, round_: Column, turn: Column, view: Column, lang: Column) -> Column:
    """How a turn is said: by its angle if that is a round one with a sense, else by what comes into view."""
    seen = _in(lang, VIEW, F.coalesce(view, F.lit("partial_turn")))
    case = F.when(round_ & turn.isNotNull() & degrees.isNotNull(), "degrees").when(seen.isNotNull(), "view").otherwise("other view")
    side = F.when(lang == "zh", F.coalesce(_lookup(SIDES_ZH, turn), F.lit(SIDES_ZH["counterclockwise"]))).otherwise(turn)
    return phrase(case, lang, n=text.number_text(F.bround(F.abs(degrees))), side=side, view=seen)


def fill(facts: DataFrame, draw: Column | None = None) -> DataFrame:
    """``facts`` with ``caption``; ``draw``: a whole number that chooses between the patterns of a style.

    Needs op, style, lang, noun, reference, location, direction (array), factor, factor_round, degrees, angle_round,
    turn_direction, view_kind, from_noun, to_noun and base_instruction; an unknown op keeps the base instruction.
    """
    lang, zh = F.col("lang"), F.col("lang") == "zh"
    pick = lambda x, cn, en: F.coalesce(F.nullif(x, F.lit("")), F.when(zh, cn).otherwise(en))
    ref = F.when(zh, F.coalesce(F.nullif("noun", F.lit("")), F.lit("物体"))).otherwise(F.col("reference"))
    first = F.get(F.col("direction"), F.lit(0))
    location = F.coalesce(F.col("location"), F.lit(""))
    words = {
        "{ref}": ref,
        "{Ref}": F.concat(F.upper(F.substring(ref, 1, 1)), F.substring(ref, 2, 100_000)),
        "{noun}": pick(F.col("noun"), "物体", "object"),
        "{loc}": location,
        "{dir}": F.coalesce(_lookup(DIRECTION_ZH, first), F.lit("旁边")),
        "{tail}": F.coalesce(F.nullif(location, F.lit("")), F.concat(F.lit("to the "), F.coalesce(first, F.lit("over")))),
        "{scale}": scale_words(F.col("factor"), F.coalesce("factor_round", F.lit(False)), lang),
        "{turn}": turn_words(F.col("degrees"), F.coalesce("angle_round", F.lit(False)), F.col("turn_direction"), F.col("view_kind"), lang),
        "{from}": pick(F.coalesce(F.nullif("from_noun", F.lit("")), F.col("noun")), "它", "it"),
        "{to}": pick(F.col("to_noun"), "别的东西", "something else"),
    }
    out = F.get(F.col("patterns"), F.pmod(draw if draw is not None else F.lit(0), F.size("patterns")).cast("int"))
    for name, value in words.items():
        out = F.replace(out, F.lit(name), F.coalesce(value, F.lit("")))
    if_no_pattern = F.coalesce(F.nullif("base_instruction", F.lit("")), F.concat(F.lit("edit "), ref))
    joined = facts.join(F.broadcast(dimension(facts.sparkSession)), ["op", "lang", "style"], "left")  # 60 rows
    return joined.withColumn("caption", F.coalesce(F.replace(F.trim(F.replace(out, F.lit(" ."), F.lit("."))), F.lit("  "), F.lit(" ")), if_no_pattern)).drop("patterns")


def template_provider(facts: DataFrame, draw: Column | None = None) -> DataFrame:
    return fill(facts, draw)


def model_provider(facts: DataFrame) -> DataFrame:
    raise NotImplementedError("a model's captions are made outside; join them to the facts by key")


PROVIDERS = {"stub": template_provider, "model": model_provider}


def provider(name: str = "stub"):
    """A function facts -> facts with ``caption``; an unknown name is a ValueError."""
    if name not in PROVIDERS:
        raise ValueError(f"unknown caption provider {name}; there are: {', '.join(PROVIDERS)}")
    return PROVIDERS[name]


# The words of the request for a caption: what the model is told, and hints by language, style and operation.
TOLD = (
    "You write a single natural image-editing instruction. You are given a BEFORE and AFTER image plus objective facts about the one edit between them. Output ONE sentence only, "
    "no explanation. Never contradict the facts (subject, operation, direction, bigger/smaller, rotation degrees & clockwise/counterclockwise, scale factor)."
)
ASKED = (
    "Refer to the subject unambiguously. If a numeric magnitude is given AND flagged round (factor_round / angle_round), you may quote it (e.g. 1.5×, 90°); otherwise stay qualitative. "
    "Output only the instruction sentence."
)
LANGUAGE_HINTS = {"zh": "用中文", "en": "in English"}
STYLE_HINTS = {
    "direct": "a short imperative command",
    "spatial": "grounded in where things are (use landmarks / support surfaces)",
    "intent": 'phrased as a wish or preference ("I don\'t want...", "I\'d like...")',
    "goal": 'phrased as a desired outcome ("clear the table", "make it tidy")',
    "casual": "loose, conversational, like texting a friend",
}
OPERATION_HINTS = {
    "object_delete": "The subject is removed. Do NOT ask to add anything.",
    "object_add": "A new object is added. Ground it on its support surface.",
    "object_move": "The subject moves. Keep the direction consistent with the facts.",
    "object_scale": "The subject is resized. Keep bigger/smaller consistent with the facts.",
    "object_rotate": "The subject is rotated. You MAY name which face shows (front/back/side) from the images, but keep it consistent with view_change.",
    "object_replace": "The subject is replaced by a different object.",
}


def messages(facts: Column, op: Column, style: Column, lang: Column, before: Column, after: Column) -> Column:
    """The request for a caption as JSON: what the model is told, the facts (JSON) with their hints, and the images that there are."""
    hint = lambda words, x, none: F.coalesce(_lookup(words, x), F.lit(none))
    text_ = F.concat(
        F.lit("Edit facts: "), facts, F.lit("\nLanguage: write "), hint(LANGUAGE_HINTS, lang, LANGUAGE_HINTS["en"]), F.lit(".\nStyle: write "), hint(STYLE_HINTS, style, "a natural instruction"),
        F.lit(".\nOperation note: "), hint(OPERATION_HINTS, op, ""), F.lit("\n" + ASKED),
    )
    part = lambda kind, said, path, label: F.struct(F.lit(kind).alias("type"), said.cast("string").alias("text"), path.cast("string").alias("path"), label.cast("string").alias("label"))
    none = F.lit(None)
    image = lambda path, label: F.when(path.isNotNull(), part("image", none, path, F.lit(label)))
    parts = F.array_compact(F.array(part("text", text_, none, none), image(before, "before"), image(after, "after")))
    return F.concat(F.lit("["), F.to_json(F.struct(F.lit("system").alias("role"), F.lit(TOLD).alias("content"))), F.lit(","), F.to_json(F.struct(F.lit("user").alias("role"), parts.alias("content"))), F.lit("]"))
