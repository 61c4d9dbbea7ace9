"""Queries over instructions, facts and captions, images, sampling and job expansion."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import captions, geometry, images, instructions, spelling, text
from pairloom.functions.records import object_variant, readable
from pairloom.operators import sampling
from pairloom.operators.rank import md5_uniform
from pairloom.plans.registry import ORACLES, query, record_sql
from pairloom.session import table
from pairloom.streaming import tasks

_META = record_sql("meta")
_REC = f"(SELECT row_id, instruction, {_META} AS j FROM samples)"


def records(spark: SparkSession, d: str) -> DataFrame:
    """row_id, instruction and the record as a variant, of readable metas that are objects."""
    return readable(table(spark, d, "samples"), "meta", "row_id", "instruction")


def facts(spark: SparkSession, d: str) -> DataFrame:
    """What a caption may tell about an edit, one nullable column per fact."""
    get = lambda p, k="string": F.try_variant_get("v", p, k)
    factor, degrees = get("$.edit.factor", "double"), F.coalesce(get("$.edit.degrees", "double"), get("$.edit.angle_deg", "double"))
    op = get("$.edit.op")
    words = F.coalesce(get("$.edit.semantic_direction", "array<string>"), F.split(get("$.edit.semantic_direction"), r"[,\s]+"))
    is_ = lambda name: op == f"object_{name}"
    r = records(spark, d)
    noun = F.coalesce(F.nullif(get("$.edit.noun"), F.lit("")), F.when(is_("replace"), get("$.edit.from.category")))
    return r.select(
        "row_id", op.alias("op"), noun.alias("noun"), F.coalesce("instruction", F.lit("")).alias("base_instruction"), text.reference_phrase("instruction", noun).alias("reference"), text.location_tail("instruction").alias("location"),
        F.when(is_("move"), words).alias("direction"), F.when(is_("scale"), factor).alias("factor"), F.when(is_("scale"), F.when(factor > 1, "bigger").when(factor.isNotNull(), "smaller")).alias("scale_dir"),
        F.when(is_("scale"), text.scale_bucket(factor)).alias("scale_bucket"), F.when(is_("scale"), F.coalesce(get("$.edit.factor_is_round", "boolean"), text.is_round_factor(factor))).alias("factor_round"),
        F.when(is_("rotate"), degrees).alias("degrees"), F.when(is_("rotate"), F.coalesce(get("$.edit.angle_is_round", "boolean"), F.lit(False))).alias("angle_round"), F.when(is_("rotate"), get("$.edit.turn_direction")).alias("turn_direction"),
        F.when(is_("rotate"), get("$.edit.view_change.kind")).alias("view_kind"), F.when(is_("replace"), get("$.edit.from.category")).alias("from_noun"), F.when(is_("replace"), get("$.edit.to.category")).alias("to_noun"),
    )


_BUCKET_SQL = "CASE WHEN r >= 1.9 THEN 'much' WHEN r >= 1.4 THEN 'moderately' ELSE 'slightly' END"


_REF_SQL = r"""coalesce(nullif(trim(regexp_extract(instruction, '(?i)(the\s+[^,.;]*?\b' || regexp_replace(n, '([^\w\s])', '\\\1', 'g') || '\b(?:\s+on\s+the\s+(?:left|right))?)', 1)), ''), 'the ' || coalesce(n, 'object'))"""


@query(f"SELECT row_id, {_REF_SQL} AS reference FROM (SELECT row_id, instruction, nullif(subject_category, '') AS n FROM samples)")
def ref_phrase(spark: SparkSession, d: str) -> DataFrame:
    """How each instruction refers to its subject."""
    return table(spark, d, "samples").select("row_id", text.reference_phrase("instruction", "subject_category").alias("reference"))


_LOC_SQL = r"nullif(trim(regexp_extract(trim(instruction), '(?i)\b((?:on top of|onto|into|in the|on the|next to|near|to the)\s+[^,.;]+)$', 1)), '')"
_WORDS_SQL = r"coalesce(TRY_CAST(json_extract(j, '$.edit.semantic_direction') AS VARCHAR[]), string_split_regex(json_extract_string(j, '$.edit.semantic_direction'), '[,\s]+'))"


@query(f"""SELECT row_id, op, n AS noun, coalesce(instruction, '') AS base_instruction, {_REF_SQL} AS reference, {_LOC_SQL} AS location, CASE WHEN op = 'object_move' THEN {_WORDS_SQL} END AS direction, CASE WHEN op = 'object_scale' THEN f END AS factor,
CASE WHEN op = 'object_scale' THEN CASE WHEN f > 1 THEN 'bigger' WHEN f IS NOT NULL THEN 'smaller' END END AS scale_dir, CASE WHEN op = 'object_scale' AND f IS NOT NULL THEN {_BUCKET_SQL} END AS scale_bucket,
CASE WHEN op = 'object_scale' THEN coalesce(TRY_CAST(json_extract_string(j, '$.edit.factor_is_round') AS BOOLEAN), CASE WHEN f IS NOT NULL THEN len(list_filter([0.25, 0.5, 0.75, 1.25, 1.5, 2.0, 3.0], lambda x: abs(f - CAST(x AS DOUBLE)) < 0.02)) > 0 END) END AS factor_round,
CASE WHEN op = 'object_rotate' THEN coalesce(TRY_CAST(json_extract_string(j, '$.edit.degrees') AS DOUBLE), TRY_CAST(json_extract_string(j, '$.edit.angle_deg') AS DOUBLE)) END AS degrees,
CASE WHEN op = 'object_rotate' THEN coalesce(TRY_CAST(json_extract_string(j, '$.edit.angle_is_round') AS BOOLEAN), false) END AS angle_round, CASE WHEN op = 'object_rotate' THEN json_extract_string(j, '$.edit.turn_direction') END AS turn_direction,
CASE WHEN op = 'object_rotate' THEN json_extract_string(j, '$.edit.view_change.kind') END AS view_kind, CASE WHEN op = 'object_replace' THEN json_extract_string(j, '$.edit.from.category') END AS from_noun,
CASE WHEN op = 'object_replace' THEN json_extract_string(j, '$.edit.to.category') END AS to_noun
FROM (SELECT *, CASE WHEN f >= 1 THEN f WHEN f > 0 THEN 1 / f ELSE 1 END AS r, coalesce(nullif(json_extract_string(j, '$.edit.noun'), ''), CASE WHEN op = 'object_replace' THEN json_extract_string(j, '$.edit.from.category') END) AS n
 FROM (SELECT *, json_extract_string(j, '$.edit.op') AS op, TRY_CAST(json_extract_string(j, '$.edit.factor') AS DOUBLE) AS f FROM {_REC} WHERE json_type(j) = 'OBJECT'))""")
def facts_extract(spark: SparkSession, d: str) -> DataFrame:
    """All facts, per operation."""
    return facts(spark, d)


@query(r"""SELECT row_id, nullif(trim(regexp_extract(trim(rtrim(instruction, '.')), '(?i)\b((?:on top of|onto|into|in the|on the|next to|near|to the)\s+[^,.;]+)$', 1)), '') AS location FROM samples""")
def location_tail(spark: SparkSession, d: str) -> DataFrame:
    """The place at the end of each instruction, its stop taken off."""
    return table(spark, d, "samples").select("row_id", text.location_tail(F.regexp_replace("instruction", r"\.+$", "")).alias("location"))


@query(f"""SELECT p_partkey, {_BUCKET_SQL} AS bucket, len(list_filter([0.25, 0.5, 0.75, 1.25, 1.5, 2.0, 3.0], lambda x: abs(f - CAST(x AS DOUBLE)) < 0.02)) > 0 AS is_round, printf('%g', f) AS said
FROM (SELECT p_partkey, p_size * 3 / 40.0::DOUBLE AS f, CASE WHEN p_size * 3 >= 40 THEN p_size * 3 / 40.0::DOUBLE ELSE 1 / (p_size * 3 / 40.0::DOUBLE) END AS r FROM part)""")
def scale_bucket(spark: SparkSession, d: str) -> DataFrame:
    """How a factor is told: its step, whether as a number, and the number."""
    f = F.col("p_size") * 3 / F.lit(40.0)
    return table(spark, d, "part").select("p_partkey", text.scale_bucket(f).alias("bucket"), text.is_round_factor(f).alias("is_round"), text.number_text(f).alias("said"))


@query("SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM documents")
def html_escaped(spark: SparkSession, d: str) -> DataFrame:
    """Texts escaped for a page."""
    return table(spark, d, "documents").select("doc_id", text.html_escape("text").alias("escaped"))


# captions for checking: every fourth instruction with its direction or size turned round
_CAPTION_SQL = (
    "CASE WHEN row_id % 4 = 0 THEN replace(replace(replace(coalesce(instruction, ''), 'left', 'RIGHT'), 'bigger', 'smaller'), 'Add', 'Remove') WHEN row_id % 8 = 1 THEN concat(coalesce(instruction, ''), ' 逆时针')"
    " WHEN row_id % 8 = 3 THEN replace(replace(coalesce(instruction, ''), 'with', 'and remove'), 'Replace', 'Take') ELSE coalesce(instruction, '') END"
)


def _regex(p: str) -> str:
    return p.replace("'", "''")


_FORBID_SQL = ", ".join(f"CASE WHEN op = '{k}' AND regexp_matches(c, '{_regex(p)}') THEN '{k}: caption 用了对立动词' END" for k, p in text.FORBIDDEN.items())
_DIR_SQL = ", ".join(f"CASE WHEN op = 'object_move' AND list_contains(words, '{w}') AND regexp_matches(c, '{text.DIRECTIONS[o][0]}') AND NOT regexp_matches(c, '{p}') THEN '{why}' END" for w, (p, o, why) in text.DIRECTIONS.items())


_ESCAPED = r"regexp_replace({x}, '([^\w\s])', '\\\1', 'g')"
_TURN_SQL = ", ".join(f"CASE WHEN op = 'object_rotate' AND turn = '{w}' AND regexp_matches(c, '{o}') AND NOT regexp_matches(c, '{p}') THEN '{why}' END" for w, p, o, why in (("clockwise", text.CLOCKWISE, text.COUNTER, "rotate: 应顺时针却说逆时针"), ("counterclockwise", text.COUNTER, text.CLOCKWISE, "rotate: 应逆时针却说顺时针")))


def _faults_sql(caption: str, rec: str) -> str:
    """SQL: row_id and the faults of each caption."""
    return f"""SELECT row_id, CASE WHEN length(c) < 2 THEN 'empty caption' ELSE array_to_string(list_filter([{_FORBID_SQL}, {_DIR_SQL},
CASE WHEN op = 'object_scale' AND sd = 'bigger' AND regexp_matches(c, '{text.SMALLER}') AND NOT regexp_matches(c, '{text.BIGGER}') THEN 'scale: 应放大却说缩小' END,
CASE WHEN op = 'object_scale' AND sd = 'smaller' AND regexp_matches(c, '{text.BIGGER}') AND NOT regexp_matches(c, '{text.SMALLER}') THEN 'scale: 应缩小却说放大' END, {_TURN_SQL},
CASE WHEN op = 'object_replace' AND regexp_matches(c, '(remove|delete|get rid of|删掉|移除).*' || {_ESCAPED.format(x="lower(nullif(json_extract_string(j, '$.edit.to.category'), ''))")}) THEN 'replace: 把新物体说成被删掉' END], lambda x: x IS NOT NULL), '|') END AS faults
FROM (SELECT row_id, j, op, lower(trim({caption})) AS c, CASE WHEN f > 1 THEN 'bigger' WHEN f IS NOT NULL THEN 'smaller' END AS sd, json_extract_string(j, '$.edit.turn_direction') AS turn,
 CASE WHEN op = 'object_move' THEN coalesce(TRY_CAST(json_extract(j, '$.edit.semantic_direction') AS VARCHAR[]), string_split_regex(json_extract_string(j, '$.edit.semantic_direction'), '[,\\s]+')) END AS words
 FROM (SELECT *, json_extract_string(j, '$.edit.op') AS op, TRY_CAST(json_extract_string(j, '$.edit.factor') AS DOUBLE) AS f FROM {rec} WHERE json_type(j) = 'OBJECT'))"""


@query(_faults_sql(_CAPTION_SQL, _REC))
def caption_verify(spark: SparkSession, d: str) -> DataFrame:
    """Captions of all operations that contradict the facts of their edit."""
    caption = F.expr(_CAPTION_SQL.replace("instruction", "base_instruction"))
    return facts(spark, d).select("row_id", F.concat_ws("|", text.caption_faults(caption, "op", "direction", "scale_dir", "turn_direction", "to_noun")).alias("faults"))


def _styled(f: DataFrame) -> DataFrame:
    """Facts with a style that the operation takes and a language, both by their row."""
    allowed = captions.allowed("op")
    return f.withColumn("style", F.element_at(allowed, (F.col("row_id") % F.size(allowed) + 1).cast("int"))).withColumn("lang", F.when(F.col("row_id") % 7 < 4, "zh").otherwise("en"))


def _captioned(spark: SparkSession, d: str) -> DataFrame:
    """Captions of all facts, filled in and checked."""
    filled = captions.fill(_styled(facts(spark, d)), md5_uniform(F.col("row_id"), 11))
    return filled.withColumn("faults", text.caption_faults("caption", "op", "direction", "scale_dir", "turn_direction", "to_noun"))


def _quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _case_sql(x: str, words: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in words.items()) + f" ELSE {other} END"


def _said_sql(case: str, **words: str) -> str:
    """SQL of a phrase in the row's language."""
    out = f"CASE lang WHEN 'zh' THEN {_quote(captions.PHRASES[case][0])} ELSE {_quote(captions.PHRASES[case][1])} END"
    for name, value in words.items():
        out = f"replace({out}, '{{{name}}}', coalesce({value}, ''))"
    return out


_TPL = ", ".join(f"({_quote(op)}, '{lang}', '{style}', {k}, {len(ps)}, {_quote(p)})" for (op, lang), all_ in captions.TEMPLATES.items() for style, own in zip(captions.STYLES, all_) for ps in [(own or all_[0]).split("|")] for k, p in enumerate(ps))
_STYLES_SQL = "[" + ", ".join(f"'{s}'" for s in captions.STYLES) + "]"
_STEP_SQL = f"CASE lang WHEN 'zh' THEN {_case_sql('bucket', captions.BUCKET['zh'])} ELSE {_case_sql('bucket', captions.BUCKET['en'])} END"
_VIEW_SQL = f"CASE lang WHEN 'zh' THEN {_case_sql('view', captions.VIEW['zh'])} ELSE {_case_sql('view', captions.VIEW['en'])} END"
_DRAW_SQL = "CAST(concat('0x', substr(md5(concat('11:', CAST(row_id AS VARCHAR))), 1, 8)) AS BIGINT)"


@query(f"""WITH f AS (SELECT row_id, op, coalesce(instruction, '') AS base, n, {_REF_SQL} AS reference, {_LOC_SQL} AS loc,
 CASE WHEN op = 'object_move' THEN {_WORDS_SQL}[1] END AS dir,
 CASE WHEN op = 'object_scale' THEN TRY_CAST(json_extract_string(j, '$.edit.factor') AS DOUBLE) END AS f, TRY_CAST(json_extract_string(j, '$.edit.factor_is_round') AS BOOLEAN) AS f_said,
 CASE WHEN op = 'object_rotate' THEN coalesce(TRY_CAST(json_extract_string(j, '$.edit.degrees') AS DOUBLE), TRY_CAST(json_extract_string(j, '$.edit.angle_deg') AS DOUBLE)) END AS deg,
 op = 'object_rotate' AND coalesce(TRY_CAST(json_extract_string(j, '$.edit.angle_is_round') AS BOOLEAN), false) AS deg_round, CASE WHEN op = 'object_rotate' THEN json_extract_string(j, '$.edit.turn_direction') END AS turn,
 coalesce(CASE WHEN op = 'object_rotate' THEN json_extract_string(j, '$.edit.view_change.kind') END, 'partial_turn') AS view,
 CASE WHEN op = 'object_replace' THEN nullif(json_extract_string(j, '$.edit.from.category'), '') END AS was, CASE WHEN op = 'object_replace' THEN nullif(json_extract_string(j, '$.edit.to.category'), '') END AS to_noun,
 CASE WHEN row_id % 7 < 4 THEN 'zh' ELSE 'en' END AS lang, CASE WHEN op IN {tuple(captions.BLOCKED)} THEN list_filter({_STYLES_SQL}, lambda s: s <> 'goal') ELSE {_STYLES_SQL} END AS styles
 FROM (SELECT *, json_extract_string(j, '$.edit.op') AS op, coalesce(nullif(json_extract_string(j, '$.edit.noun'), ''), CASE WHEN json_extract_string(j, '$.edit.op') = 'object_replace' THEN nullif(json_extract_string(j, '$.edit.from.category'), '') END) AS n FROM {_REC} WHERE json_type(j) = 'OBJECT')),
g AS (SELECT *, styles[row_id % len(styles) + 1] AS style, CASE WHEN lang = 'zh' THEN coalesce(n, '物体') ELSE reference END AS ref, coalesce(f_said, len(list_filter([0.25, 0.5, 0.75, 1.25, 1.5, 2.0, 3.0], lambda x: abs(f - CAST(x AS DOUBLE)) < 0.02)) > 0, false) AS f_round,
 CASE WHEN f IS NULL THEN 'moderately' WHEN r >= 1.9 THEN 'much' WHEN r >= 1.4 THEN 'moderately' ELSE 'slightly' END AS bucket FROM (SELECT *, CASE WHEN f >= 1 THEN f WHEN f > 0 THEN 1 / f ELSE 1 END AS r FROM f)),
w AS (SELECT *, CASE WHEN f > 1 AND f_round THEN {_said_sql('times bigger', n="printf('%g', f)")} WHEN f > 1 THEN {_said_sql('bigger', step=_STEP_SQL)} WHEN f_round AND abs(f - 0.5) < 0.02 THEN {_said_sql('half')}
 WHEN f_round AND f IS NOT NULL THEN {_said_sql('times smaller', n="printf('%g', f)")} ELSE {_said_sql('smaller', step=_STEP_SQL)} END AS scale, CASE WHEN deg_round AND turn IS NOT NULL AND deg IS NOT NULL
 THEN {_said_sql('degrees', n="printf('%g', round_even(abs(deg), 0))", side=f"CASE WHEN lang = 'zh' THEN CASE WHEN turn = 'clockwise' THEN '顺时针' ELSE '逆时针' END ELSE turn END")} ELSE coalesce({_VIEW_SQL}, {_said_sql('other view')}) END AS turned FROM g)
SELECT row_id, w.style, w.lang, CASE WHEN p IS NULL THEN coalesce(nullif(base, ''), 'edit ' || ref) ELSE replace(trim(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(p, '{{ref}}', ref), '{{Ref}}', upper(ref[1]) || ref[2:]),
 '{{noun}}', coalesce(n, CASE WHEN w.lang = 'zh' THEN '物体' ELSE 'object' END)), '{{loc}}', coalesce(loc, '')), '{{dir}}', coalesce({_case_sql('dir', captions.DIRECTION_ZH)}, '旁边')), '{{tail}}', coalesce(loc, 'to the ' || coalesce(dir, 'over'))), '{{scale}}', scale),
 '{{turn}}', turned), '{{from}}', coalesce(was, n, CASE WHEN w.lang = 'zh' THEN '它' ELSE 'it' END)), '{{to}}', coalesce(to_noun, CASE WHEN w.lang = 'zh' THEN '别的东西' ELSE 'something else' END)), ' .', '.')), '  ', ' ') END AS caption
FROM w LEFT JOIN (VALUES {_TPL}) t(op, lang, style, k, n_k, p) ON t.op = w.op AND t.lang = w.lang AND t.style = w.style AND t.k = {_DRAW_SQL} % t.n_k""")
def caption_templates(spark: SparkSession, d: str) -> DataFrame:
    """Captions from templates, for every operation, style and language and both patterns of a style."""
    return captions.fill(_styled(facts(spark, d)), md5_uniform(F.col("row_id"), 11)).select("row_id", "style", "lang", "caption")


_CAPTIONED = f"(SELECT r.*, t.caption, t.style, t.lang FROM {_REC} r JOIN ({ORACLES['caption_templates']}) t USING (row_id))"
_CHECKED = f"(SELECT row_id, caption, style, lang, coalesce(instruction, '') AS base, json_extract_string(j, '$.edit.op') AS op, faults FROM {_CAPTIONED} JOIN ({_faults_sql('caption', _CAPTIONED)}) USING (row_id))"


@query(f"SELECT row_id, op, style, lang, caption, faults FROM {_CHECKED}")
def caption_all(spark: SparkSession, d: str) -> DataFrame:
    """Captions of every operation, style and language, with what contradicts the facts."""
    return _captioned(spark, d).select("row_id", "op", "style", "lang", "caption", F.concat_ws("|", "faults").alias("faults"))


@query(f"SELECT style, lang, count(*) AS n, CAST(count(*) FILTER (WHERE faults = '') AS BIGINT) AS verified, CAST(count(*) FILTER (WHERE faults <> '') AS BIGINT) AS fallback FROM {_CHECKED} GROUP BY style, lang")
def caption_summary(spark: SparkSession, d: str) -> DataFrame:
    """Captions by style and language, how many are sound and how many fall back on the instruction."""
    return _captioned(spark, d).groupBy("style", "lang").agg(F.count("*").alias("n"), F.count_if(F.size("faults") == 0).alias("verified"), F.count_if(F.size("faults") > 0).alias("fallback"))


@query(f"""SELECT row_id, CASE WHEN faults = '' THEN caption ELSE base END AS caption, CASE WHEN faults = '' THEN style ELSE 'direct' END AS caption_style, CASE WHEN faults = '' THEN lang ELSE 'en' END AS caption_lang,
CASE WHEN faults = '' THEN 'stub' ELSE 'fallback_base' END AS provider, faults = '' AS verified FROM {_CHECKED}""")
def caption_fallback(spark: SparkSession, d: str) -> DataFrame:
    """The caption columns as they are written back: a caption with faults gives way to the instruction."""
    ok = F.size("faults") == 0
    pick = lambda a, b: F.when(ok, F.col(a)).otherwise(b)
    return _captioned(spark, d).select("row_id", pick("caption", F.col("base_instruction")).alias("caption"), pick("style", F.lit("direct")).alias("caption_style"), pick("lang", F.lit("en")).alias("caption_lang"), F.when(ok, "stub").otherwise("fallback_base").alias("provider"), ok.alias("verified"))


@query(f"""WITH f AS (SELECT row_id, json_extract_string(j, '$.edit.op') AS op, coalesce(nullif(json_extract_string(j, '$.edit.noun'), ''), CASE WHEN json_extract_string(j, '$.edit.op') = 'object_replace' THEN json_extract_string(j, '$.edit.from.category') END) AS noun,
 coalesce(instruction, '') AS said, CASE WHEN json_extract_string(j, '$.edit.op') = 'object_rotate' THEN json_extract_string(j, '$.edit.turn_direction') END AS turn, CASE WHEN row_id % 7 < 4 THEN 'zh' ELSE 'en' END AS lang, key, shard_path
 FROM (SELECT *, {_META} AS j FROM samples) WHERE json_type(j) = 'OBJECT'), g AS (SELECT *, CASE WHEN op IN {tuple(captions.BLOCKED)} THEN list_filter({_STYLES_SQL}, lambda s: s <> 'goal') ELSE {_STYLES_SQL} END AS styles FROM f),
h AS (SELECT *, styles[row_id % len(styles) + 1] AS style FROM g),
t AS (SELECT *, 'Edit facts: ' || CAST(json_merge_patch('{{}}', to_json({{'op': op, 'noun': noun, 'base_instruction': said, 'turn_direction': turn}})) AS VARCHAR) || chr(10) || 'Language: write ' || {_case_sql('lang', captions.LANGUAGE_HINTS)} || '.' || chr(10) || 'Style: write ' || {_case_sql('style', captions.STYLE_HINTS)}
 || '.' || chr(10) || 'Operation note: ' || coalesce({_case_sql('op', captions.OPERATION_HINTS)}, '') || chr(10) || {_quote(captions.ASKED)} AS text FROM h)
SELECT row_id, '[{{"role":"system","content":' || CAST(to_json({_quote(captions.TOLD)}) AS VARCHAR) || '}},{{"role":"user","content":[{{"type":"text","text":' || CAST(to_json(text) AS VARCHAR) || '}}' || CASE WHEN shard_path IS NULL THEN '' ELSE
 ',{{"type":"image","path":"' || key || '.before.png","label":"before"}},{{"type":"image","path":"' || key || '.after.png","label":"after"}}' END || ']}}]' AS messages FROM t""")
def prompt_messages(spark: SparkSession, d: str) -> DataFrame:
    """Requests to a caption model as JSON, with facts, hints and the images of packed samples."""
    f = _styled(facts(spark, d)).join(table(spark, d, "samples").select("row_id", "key", "shard_path"), "row_id")
    image = lambda side: F.when(F.col("shard_path").isNotNull(), F.concat("key", F.lit(f".{side}.png")))
    told = F.to_json(F.struct("op", "noun", "base_instruction", "turn_direction"))
    return f.select("row_id", captions.messages(told, F.col("op"), F.col("style"), F.col("lang"), image("before"), image("after")).alias("messages"))


# ---- images: 64 values as 8 x 8 grey pixels, each pair an image and its successor
_PIX = "[CAST(floor((x + 1) * 127) AS INT) for x in embedding]"
_PAIRS = f"(SELECT a.vec_id, a.p AS before, b.p AS after FROM (SELECT vec_id, {_PIX} AS p FROM embeddings) a JOIN (SELECT vec_id - 1 AS vec_id, {_PIX} AS p FROM embeddings) b USING (vec_id))"


def image_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor((x + F.lit(1.0)) * 127).cast("float")).alias("p"))
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("p").alias("after"))
    return e.withColumnRenamed("p", "before").join(after, "vec_id")


@query(f"SELECT vec_id, list_sum([CAST(abs(before[i] - after[i]) > 12 AS INT) for i in range(1, 65)]) / 64.0::DOUBLE AS change_ratio, list_sum([CAST(abs(before[i] - after[i]) > 12 AS INT) for i in range(1, 65)]) >= 1 AS visible FROM {_PAIRS}")
def image_change_ratio(spark: SparkSession, d: str) -> DataFrame:
    """The share of pixels that change, and whether a hundredth does."""
    r = images.change_ratio(F.col("before"), F.col("after"))
    return image_pairs(spark, d).select("vec_id", r.alias("change_ratio"), images.change_is_visible(F.col("before"), F.col("after")).alias("visible"))


@query(f"SELECT vec_id, list_sum([CAST(x AS DOUBLE) for x in before]) / 64 AS luminance FROM {_PAIRS}")
def image_luminance(spark: SparkSession, d: str) -> DataFrame:
    """Mean brightness."""
    return image_pairs(spark, d).select("vec_id", images.mean_luminance(F.col("before")).alias("luminance"))


_LAP = f"(SELECT vec_id, [before[i - 1] + before[i + 1] + before[i - 8] + before[i + 8] - 4 * before[i] for i in range(1, 65) if (i - 1) % 8 BETWEEN 1 AND 6 AND (i - 1) // 8 BETWEEN 1 AND 6] AS l FROM {_PAIRS})"


@query(f"SELECT vec_id, CAST(36 AS BIGINT) AS n, CAST(list_sum(l) AS BIGINT) AS s, CAST(list_sum([x * x for x in l]) AS BIGINT) AS q FROM {_LAP}")
def image_laplacian(spark: SparkSession, d: str) -> DataFrame:
    """I4: the moments of the Laplacian, from which sharpness is q / n - (s / n) ** 2."""
    return image_pairs(spark, d).select("vec_id", images.laplacian_moments(F.col("before"), 8, 8).alias("m")).select("vec_id", "m.*")


_MASK = "[abs(before[i] - after[i]) > 12 for i in range(1, 65)]"
_NEAR = "len([1 for k in range(1, 65) if m[k] AND abs((k - 1) % 8 - (i - 1) % 8) <= 1 AND abs((k - 1) // 8 - (i - 1) // 8) <= 1])"


@query(f"""SELECT vec_id, CASE WHEN list_contains(m, true) AND len(o) > 0 THEN CAST(round(1000 * list_sum(o) / len(o)) AS BIGINT) // 10 ELSE 0 END AS background_diff FROM (SELECT vec_id, m, [abs(before[i] - after[i]) for i in range(1, 65) if {_NEAR} = 0] AS o FROM (SELECT *, {_MASK} AS m FROM {_PAIRS}))""")
def image_background_diff(spark: SparkSession, d: str) -> DataFrame:
    """Difference outside the changed area widened by one pixel (in hundredths, whole)."""
    s = images.score_pairs(image_pairs(spark, d), "vec_id", "before", "after", 8, 8, pad=0.125)
    # three decimals as scored, so that a tie of the last digit can't tell
    return s.select("vec_id", F.floor(F.round(F.col("background_diff") * 1000).cast("long") / 10).alias("background_diff"))


@query()
def image_scores(spark: SparkSession, d: str) -> DataFrame:
    """I8: all four scores of each pair."""
    return images.score_pairs(image_pairs(spark, d), "vec_id", "before", "after", 8, 8)


# ---- sampling and jobs
_U = "CAST(concat('0x', substr(md5(concat('{seed}:', CAST({x} AS VARCHAR))), 1, 8)) AS BIGINT)"
OPS = (("object_move", 3.0), ("object_scale", 1.0), ("object_rotate", 0.5), ("object_delete", 0.0), ("object_add", 3.5))
_EDGES, _upto = [], 0.0
for _name, _w in OPS:
    if _w:
        _upto += _w
        _EDGES.append(f"WHEN u < {round(_upto / 8.0 * (1 << 32))} THEN '{_name}'")


@query(f"SELECT event_id, CASE {' '.join(_EDGES)} END AS op FROM (SELECT event_id, {_U.format(seed=7, x='event_id')} AS u FROM events)")
def weighted_choice(spark: SparkSession, d: str) -> DataFrame:
    """A weighted operation for each row by its hash."""
    return table(spark, d, "events").select("event_id", sampling.weighted_pick(md5_uniform(F.col("event_id"), 7), OPS).alias("op"))


_QUOTA = """WITH r AS (SELECT row_id, c, row_number() OVER (PARTITION BY c ORDER BY md5('7:' || row_id) || row_id) - 1 AS place FROM (SELECT row_id, {of} AS c FROM samples)),
n AS (SELECT c, count(*) AS n FROM r GROUP BY c), w AS (SELECT * FROM (VALUES {values}) t(c, option, weight, pos)), s AS (SELECT c, option, pos, weight * n / sum(weight) OVER (PARTITION BY c) AS exact, n FROM w JOIN n USING (c)),
q AS (SELECT c, option, pos, CAST(floor(exact + 1e-9) AS BIGINT) AS whole, n, row_number() OVER (PARTITION BY c ORDER BY exact - floor(exact + 1e-9) DESC, pos) AS nth, sum(CAST(floor(exact + 1e-9) AS BIGINT)) OVER (PARTITION BY c) AS given FROM s),
e AS (SELECT c, option, pos, CAST(sum(whole + CASE WHEN nth <= n - given THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY pos) AS BIGINT) AS upto FROM q) SELECT row_id, (SELECT option FROM e WHERE e.c = r.c AND place < upto ORDER BY pos LIMIT 1) AS choice FROM r"""
_OP_SQL = r"'object_' || nullif(regexp_replace(lower(regexp_replace(edit_op, '^\s+|\s+$', '', 'g')), '^object[_\s-]*', ''), '')"


def _quota_sql(options, blocked=None) -> str:
    """At most one set of blocked options."""
    sets = [(0, ())] + [(1, b) for b in set(map(tuple, (blocked or {}).values()))]
    values = ", ".join(f"({c}, '{k}', CAST({w} AS DOUBLE), {i})" for c, b in sets for i, (k, w) in enumerate(options) if k not in b)
    return _QUOTA.format(values=values, of=f"CASE WHEN {_OP_SQL} IN {tuple(blocked)} THEN 1 ELSE 0 END" if blocked else "0")


@query(_quota_sql(captions.STYLE_WEIGHTS.items(), captions.BLOCKED))
def style_quota(spark: SparkSession, d: str) -> DataFrame:
    """W9 in its parallel form: every sample a style that its operation takes, in exact quotas."""
    s = table(spark, d, "samples").select("row_id", spelling.edit_op("edit_op").alias("op"))
    return sampling.balanced(s, "row_id", list(captions.STYLE_WEIGHTS.items()), "choice", kind="op", blocked=captions.BLOCKED, otherwise="direct").select("row_id", "choice")


@query(_quota_sql(captions.LANGUAGE_WEIGHTS.items()))
def language_quota(spark: SparkSession, d: str) -> DataFrame:
    """W10 in its parallel form."""
    return sampling.balanced(table(spark, d, "samples").select("row_id"), "row_id", list(captions.LANGUAGE_WEIGHTS.items()), "choice", otherwise="zh")


@query()
def caption_deficit_exact(spark: SparkSession, d: str) -> DataFrame:
    """W9 exactly: styles that the operation takes, drawn one by one by their deficit in the order of arrival."""
    s = table(spark, d, "samples").where("row_id is not null").select("row_id", spelling.edit_op("edit_op").alias("op"))
    return sampling.deficit_sampling(s, None, "row_id", list(captions.STYLE_WEIGHTS.items()), "style", kind="op", blocked=captions.BLOCKED, otherwise="direct")


@query()
def language_deficit_exact(spark: SparkSession, d: str) -> DataFrame:
    """W10 exactly: languages drawn one by one by their deficit in the order of arrival."""
    s = table(spark, d, "samples").where("row_id is not null").select("row_id")
    return sampling.deficit_sampling(s, None, "row_id", list(captions.LANGUAGE_WEIGHTS.items()), "lang", seed=1, otherwise="zh")


@query("""WITH RECURSIVE t AS (SELECT row_id, CAST(row_number() OVER (ORDER BY row_id) AS BIGINT) AS k FROM samples WHERE row_id IS NOT NULL),
g AS (SELECT CAST(1 AS BIGINT) AS k, CAST(0 AS BIGINT) AS zh, CAST(0 AS BIGINT) AS en, 'zh' AS lang UNION ALL SELECT k + 1, zh + CASE WHEN lang = 'zh' THEN 1 ELSE 0 END, en + CASE WHEN lang = 'en' THEN 1 ELSE 0 END,
CASE WHEN 4 * (k + 1) - 5 * (zh + CASE WHEN lang = 'zh' THEN 1 ELSE 0 END) >= k + 1 - 5 * (en + CASE WHEN lang = 'en' THEN 1 ELSE 0 END) THEN 'zh' ELSE 'en' END FROM g WHERE k < (SELECT max(k) FROM t))
SELECT row_id, lang FROM t JOIN g USING (k)""")
def language_largest_deficit(spark: SparkSession, d: str) -> DataFrame:
    """W10 without chance: always the language furthest below its share, over the whole data set in the order of arrival."""
    s = table(spark, d, "samples").where("row_id is not null").select("row_id")
    return sampling.largest_deficit(s, ["row_id"], list(captions.LANGUAGE_WEIGHTS.items()), "lang")


@query()
def op_deficit(spark: SparkSession, d: str) -> DataFrame:
    """Operations balanced per job, which starts its own counts; one at its share keeps a small chance."""
    s = table(spark, d, "samples").where("job_id is not null").select("job_id", "row_id")
    return sampling.deficit_sampling(s, "job_id", "row_id", [("object_move", 1.0), ("object_scale", 1.0), ("object_add", 0.0)], "op", seed=5, extra=0.05)


@query()
def amortised_jobs(spark: SparkSession, d: str) -> DataFrame:
    """What each job makes in its slots, with retries, each operation on a subject once."""
    s = table(spark, d, "samples").select(F.regexp_extract("job_id", r"(job_\d+)", 1).alias("job"), "row_id", spelling.asset_uid("subject_uid").alias("subject"), "collision_free")
    return sampling.amortised(s, "job", "row_id", "subject", "collision_free", [("object_move", 2.0), ("object_scale", 1.0), ("object_add", 1.0)])


#: A run as its configuration file has it.
CONFIG = {
    "run": {"base_seed": 200, "granularity": "amortized"},
    "render": {"pairs_per_scene": 12},
    "scenes": [{"name": "hssd", "weight": 0.6}, {"name": "front3d", "weight": 0.4}],
    "object_sources": [{"provider": "objaverse", "weight": 3.0}, {"provider": "primitives", "weight": 1.0}],
    "edits": {"sampling_weights": {"object_move": 2.0, "object_replace": 1.0, "object_delete": 1.0}, "params": {"object_move": {"subject_source": {"scene": 1}}}},
    "ray": {"profile_by": "edit", "resources": {"default": {"num_cpus": 1}, "object_move": {"num_cpus": 2, "num_gpus": 1}}},
}


def job_table(jobs: DataFrame, index: str, config: Mapping[str, Any]) -> DataFrame:
    """A job for each index: its id, seed, scene and object source by weight, operation, profile with its resources, and the edit parameters with the sources put in."""
    i, run, seed = F.col(index), config["run"], config["run"]["base_seed"]
    pick = lambda options, salt: sampling.weighted_pick(md5_uniform(i, seed + salt), options)
    scene = pick([(x["name"], float(x.get("weight", 1.0))) for x in config["scenes"]], 0)
    source = pick([(x["provider"], float(x.get("weight", 1.0))) for x in config.get("object_sources") or ()], 1)
    op = pick([(k, float(w)) for k, w in config["edits"]["sampling_weights"].items()], 2)
    amortised = run.get("granularity", "amortized") != "per_edit" and config["render"].get("pairs_per_scene", 1) > 1
    ray = config.get("ray") or {}
    profile = {"edit": op, "scene": scene}.get(ray.get("profile_by", "scene"), F.lit("default"))
    edits = tasks.with_object_sources(config["edits"], config.get("object_sources"))
    res = ray.get("resources") or {}
    params = F.create_map(*[x for k in config["edits"]["sampling_weights"] for x in (F.lit(k), F.lit(json.dumps((edits.get("params") or {}).get(k) or {}, sort_keys=True)))])

    def have(what: str, none: int):
        """The resources of a profile, else of the default one, else none."""
        named = [x for k, r in res.items() for x in (F.lit(k), F.lit(r.get(what, none)))]
        return F.coalesce(F.create_map(*named)[F.col("profile")], F.lit((res.get("default") or {}).get(what, none))) if named else F.lit(none)

    out = jobs.select(index, F.format_string("job_%07d", i).alias("job_id"), (i + seed).alias("seed"), scene.alias("scene"), source.alias("source"), op.alias("op"), F.lit(amortised).alias("amortised"),
                      F.format_string("job_%07d_p%02d", i, i % config["render"].get("pairs_per_scene", 1)).alias("pair_id"), F.coalesce(F.nullif(profile, F.lit("")), F.lit("default")).alias("profile"))
    return out.select("*", have("num_cpus", 1).alias("cpus"), have("num_gpus", 0).alias("gpus"), params[F.col("op")].alias("params"))


def _weighted_sql(salt: int, options: list[tuple[str, float]]) -> str:
    whole, upto, out = sum(w for _, w in options), 0.0, []
    for k, w in options:
        upto += w
        out.append(f"WHEN {_U.format(seed=200 + salt, x='event_id')} < {round(upto / whole * (1 << 32))} THEN '{k}'")
    return f"CASE {' '.join(out)} END"


@query(f"""SELECT *, CASE profile WHEN 'object_move' THEN 2 ELSE 1 END AS cpus, CASE profile WHEN 'object_move' THEN 1 ELSE 0 END AS gpus, CASE op WHEN 'object_delete' THEN '{{}}' WHEN 'object_replace' THEN
'{{"provider": "composite", "provider_params": {{"sources": {json.dumps(CONFIG["object_sources"])}}}}}' ELSE '{{"spawn_params": {{"provider": "composite", "provider_params": {{"sources": {json.dumps(CONFIG["object_sources"])}}}}}, "subject_source": {{"scene": 1}}}}' END AS params
FROM (SELECT event_id, format('job_{{:07d}}', event_id) AS job_id, 200 + event_id AS seed, {_weighted_sql(0, [('hssd', 0.6), ('front3d', 0.4)])} AS scene, {_weighted_sql(1, [('objaverse', 3.0), ('primitives', 1.0)])} AS source,
 {_weighted_sql(2, [('object_move', 2.0), ('object_replace', 1.0), ('object_delete', 1.0)])} AS op, true AS amortised, format('job_{{:07d}}_p{{:02d}}', event_id, event_id % 12) AS pair_id, {_weighted_sql(2, [('object_move', 2.0), ('object_replace', 1.0), ('object_delete', 1.0)])} AS profile FROM events)""")
def job_specs(spark: SparkSession, d: str) -> DataFrame:
    """Job specs from a configuration, one for each event's number."""
    return job_table(table(spark, d, "events").select("event_id"), "event_id", CONFIG)


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS said, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events""")
def timestamps(spark: SparkSession, d: str) -> DataFrame:
    """Times as text and as seconds."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select("event_id", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("said"), F.unix_timestamp(ts).alias("seconds"))


def _pick_sql(case: str, n: int) -> str:
    options = ", ".join(f"'{p}'" for p in instructions.PATTERNS[case])
    return f"[{options}][{_U.format(seed=3, x='row_id')} % {n} + 1]"


_PHRASE_SQL = """CASE WHEN len(words) = 0 THEN 'slightly' WHEN len(list_filter(words, lambda w: w IN ('left', 'right', 'up', 'down'))) = len(words) THEN 'to the ' || array_to_string(list_reverse(words), ' ')
ELSE array_to_string([CASE w WHEN 'closer' THEN 'closer to the camera' WHEN 'farther' THEN 'away from the camera' ELSE w END for w in words], ', ') END"""


@query(f"""SELECT row_id, replace(replace(replace(replace(replace(p, '{{ref}}', coalesce(nullif(n, ''), 'object')), '{{noun}}', coalesce(nullif(n, ''), 'object')), '{{to}}', 'vase'), '{{support}}', 'desk'), '{{phrase}}', {_PHRASE_SQL}) AS said FROM (
SELECT row_id, n, words, CASE WHEN op = 'object_move' THEN 'move the {{ref}} {{phrase}}' WHEN op = 'object_delete' THEN {_pick_sql('object_delete', 3)} WHEN op = 'object_add' AND row_id % 2 = 0 THEN {_pick_sql('object_add on a support', 3)}
WHEN op = 'object_add' THEN {_pick_sql('object_add', 3)} WHEN op = 'object_replace' AND n = 'vase' THEN {_pick_sql('object_replace by the same noun', 3)} WHEN op = 'object_replace' THEN {_pick_sql('object_replace', 3)}
WHEN op = 'object_rotate' THEN {_pick_sql('object_rotate', 2)} WHEN op = 'object_scale' AND change_ratio >= 0.1 THEN {_pick_sql('object_scale up', 2)} WHEN op = 'object_scale' THEN {_pick_sql('object_scale down', 2)} END AS p
FROM (SELECT row_id, subject_category AS n, change_ratio, {_OP_SQL} AS op, coalesce({_WORDS_SQL}, []) AS words FROM (SELECT *, {_META} AS j FROM samples)))""")
def instruction_templates(spark: SparkSession, d: str) -> DataFrame:
    """Base instructions of every operation from patterns, chosen by hash; moves by their directions."""
    get = lambda k: F.try_variant_get("v", "$.edit.semantic_direction", k)
    s = table(spark, d, "samples").select("row_id", spelling.edit_op("edit_op").alias("op"), F.col("subject_category").alias("n"), "change_ratio", object_variant("meta").alias("v"))
    words = F.coalesce(get("array<string>"), F.split(get("string"), r"[,\s]+"), F.array().cast("array<string>"))
    support = F.when(F.col("row_id") % 2 == 0, "desk")
    said = instructions.instruction(F.col("op"), md5_uniform(F.col("row_id"), 3), ref=F.col("n"), noun=F.col("n"), to=F.lit("vase"), support=support, phrase=geometry.direction_phrase(words), factor=F.when(F.col("change_ratio") >= 0.1, 1.5).otherwise(0.5))
    return s.select("row_id", said.alias("said"))


@query("""SELECT vec_id, [CAST(round_even(CAST(x AS DOUBLE), 4) * 10000 AS BIGINT) for x in embedding[1:3]] AS location, [CAST(round_even(CAST(x AS DOUBLE), 6) * 1000000 AS BIGINT) for x in embedding[4:7]] AS quat FROM embeddings""")
def rounded_poses(spark: SparkSession, d: str) -> DataFrame:
    """Poses as they are written down (in whole units of the last digit)."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    pose = geometry.rounded_pose(F.slice(e, 1, 3), F.slice(e, 1, 3), F.slice(e, 4, 4))
    whole = lambda v, n: F.transform(v, lambda x: F.round(x * n).cast("long"))
    return table(spark, d, "embeddings").select("vec_id", whole(pose["location"], 10_000).alias("location"), whole(pose["rotation_quat"], 1_000_000).alias("quat"))
