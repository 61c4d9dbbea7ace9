"""Queries over the sample tables: projection, gates, statistics, export, upserts and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import spelling, text
from pairloom.functions.records import object_variant, readable, record_text
from pairloom.operators import gates, rank, sampling, upsert
from pairloom.plans.registry import query, record_sql, spelled_asset_sql, spelled_scene_sql
from pairloom.session import table

#: Scenes held out of training in the export queries, and samples per shard.
HELD_OUT = ("hs-999cf3cx", "hs-9e37899b")
SHARD_SIZE = 100

REASONS_SQL = """concat_ws(';', CASE WHEN change_ratio < 0.0 THEN 'change_too_small' END, CASE WHEN change_ratio > 0.85 THEN 'change_too_large' END,
  CASE WHEN sharpness < 3.0 THEN 'too_blurry' END, CASE WHEN background_diff > 3.0 THEN 'background_unstable' END)"""


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples")


def _reasons():
    return gates.quality_reasons(bright=None)


_TRIMMED = r"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
_SPELLED = {
    "edit_op": rf"'object_' || nullif(regexp_replace({_TRIMMED.format(c='edit_op')}, '^object[_\s-]*', ''), '')",
    "source_dataset": rf"nullif(regexp_replace({_TRIMMED.format(c='source_dataset')}, '^dataset\s*:\s*', ''), '')",
    "scene_id": spelled_scene_sql("scene_id"),
}
#: SQL: the current row of each key, with operation, dataset and scene in one spelling.
_CURRENT = f"(SELECT * REPLACE ({', '.join(f'{x} AS {c}' for c, x in _SPELLED.items())}) FROM samples QUALIFY row_number() OVER (PARTITION BY key ORDER BY row_id DESC) = 1)"


def _current(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """``columns`` of the current row of each key, with operation, dataset and scene in one spelling."""
    now = rank.current_rows(_samples(spark, d), "key", "row_id", columns)
    spell = {"edit_op": spelling.edit_op, "source_dataset": spelling.source_name, "scene_id": spelling.scene_id}
    return now.withColumns({c: f(c) for c, f in spell.items() if c in columns})


def _packed(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return _current(spark, d, "shard_path", *columns).where("shard_path is not null")


@query(f"""SELECT edit_op, count(*) AS n, CAST(count(*) FILTER (WHERE {REASONS_SQL} = '') AS BIGINT) AS n_pass, count(DISTINCT scene_id) AS n_scenes
FROM {_CURRENT} WHERE shard_path IS NOT NULL GROUP BY edit_op""")
def dataset_stats_by_op(spark: SparkSession, d: str) -> DataFrame:
    """Packed samples per operation, how many pass the quality gate, and their scenes."""
    packed = _packed(spark, d, "edit_op", "scene_id", "change_ratio", "sharpness", "background_diff")
    return packed.groupBy("edit_op").agg(F.count("*").alias("n"), F.count_if(_reasons() == "").alias("n_pass"), F.count_distinct("scene_id").alias("n_scenes"))


@query(f"SELECT row_id, {REASONS_SQL} AS reasons FROM samples")
def quality_gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why each sample fails."""
    return _samples(spark, d).select("row_id", _reasons().alias("reasons"))


@query(f"""SELECT edit_op, scene_id, source_dataset, count(*) AS n, CAST(grouping(edit_op, scene_id, source_dataset) AS BIGINT) AS level FROM {_CURRENT}
WHERE shard_path IS NOT NULL GROUP BY GROUPING SETS ((edit_op), (scene_id), (source_dataset), ())""")
def stats_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """Counts by operation, scene, dataset and in all, in one pass."""
    f = [F.col(c) for c in ("edit_op", "scene_id", "source_dataset")]
    grouped = _packed(spark, d, "edit_op", "scene_id", "source_dataset").groupingSets([[f[0]], [f[1]], [f[2]], []], *f)
    return grouped.agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def size_class(n):
    """The class of a dataset's size."""
    return F.when(n < 1000, "n<1K").when(n < 10_000, "1K<n<10K").when(n < 100_000, "10K<n<100K").otherwise("100K<n<1M")


@query(f"""SELECT count(*) AS total, count(DISTINCT CASE WHEN scene_id NOT IN ('', '?') THEN scene_id END) AS n_scenes,
CASE WHEN count(*) < 1000 THEN 'n<1K' WHEN count(*) < 10000 THEN '1K<n<10K' WHEN count(*) < 100000 THEN '10K<n<100K' ELSE '100K<n<1M' END AS size_bucket
FROM {_CURRENT} WHERE shard_path IS NOT NULL""")
def stats_total(spark: SparkSession, d: str) -> DataFrame:
    """Packed samples, their scenes, and the size class of the set."""
    n = F.count("*")
    return _packed(spark, d, "scene_id").agg(n.alias("total"), F.count_distinct(F.when(~F.col("scene_id").isin("", "?"), F.col("scene_id"))).alias("n_scenes"), size_class(n).alias("size_bucket"))


@query(f"""SELECT coalesce(source_dataset, '?') AS source, coalesce(edit_op, '?') AS op, count(*) AS n FROM {_CURRENT} GROUP BY ALL""")
def stats_with_unknown(spark: SparkSession, d: str) -> DataFrame:
    """Counts with ``?`` for what is unknown."""
    return _current(spark, d, "source_dataset", "edit_op").groupBy(F.coalesce("source_dataset", F.lit("?")).alias("source"), F.coalesce("edit_op", F.lit("?")).alias("op")).agg(F.count("*").alias("n"))


_META = record_sql("meta")


def _variant(column: str = "meta"):
    return object_variant(column)


@query(f"""SELECT 'license' AS what, json_extract_string({_META}, '$.provenance.scene_source.license') AS value FROM samples WHERE value IS NOT NULL
UNION SELECT 'version', json_extract_string({_META}, '$.provenance.pipeline_version') FROM samples WHERE json_extract_string({_META}, '$.provenance.pipeline_version') IS NOT NULL""")
def stats_licenses(spark: SparkSession, d: str) -> DataFrame:
    """the licences and pipeline versions that occur."""
    v = _samples(spark, d).select(_variant().alias("v"))
    pairs = F.array(F.struct(F.lit("license").alias("what"), F.try_variant_get("v", "$.provenance.scene_source.license", "string").alias("value")), F.struct(F.lit("version").alias("what"), F.try_variant_get("v", "$.provenance.pipeline_version", "string").alias("value")))
    return v.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").distinct()


def absent_or(v: str, path: str, fallback: str, kind: str = "double"):
    """The value at ``path``, or at ``fallback`` only where the key is absent: a null that is present stays null."""
    return F.when(F.variant_get(v, path, "variant").isNull(), F.try_variant_get(v, fallback, kind)).otherwise(F.try_variant_get(v, path, kind))


# Where a sample's columns stand in its record, and their types.
SAMPLE_COLUMNS = (
    ("job_id", "$.job_id", "string"), ("seed", "$.seed", "long"), ("scene_id", "$.provenance.scene_source.scene_id", "string"), ("source_dataset", "$.provenance.scene_source.dataset", "string"),
    ("pipeline_version", "$.provenance.pipeline_version", "string"), ("edit_op", "$.edit.op", "string"), ("instruction", "$.instruction", "string"), ("subject_category", "$.subject.category", "string"),
    ("subject_uid", "$.subject.asset_uid", "string"), ("subject_description", "$.subject.description", "string"), ("sharpness", "$.edit.validity.quality.sharpness", "double"),
    ("background_diff", "$.edit.validity.quality.background_diff", "double"), ("penetration_depth", "$.edit.validity.penetration_depth", "double"), ("floating_gap", "$.edit.validity.floating_gap", "double"),
    ("reseated", "$.edit.validity.reseated", "boolean"), ("collision_free", "$.edit.validity.collision_free", "boolean"), ("num_attempts", "$.edit.validity.num_attempts", "int"),
    ("direction_consistent", "$.edit.validity.direction_check.consistent", "boolean"),
)
_CHANGE, _OLD_CHANGE = "$.edit.validity.quality.change_ratio", "$.edit.validity.pixel_change_ratio"
_SQL_TYPES = {"long": "BIGINT", "int": "INT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _column_sql(path: str, kind: str) -> str:
    x = f"json_extract_string(j, '{path}')"
    return x if kind == "string" else f"TRY_CAST({x} AS {_SQL_TYPES[kind]})"


_CHANGE_SQL = f"CASE WHEN json_extract(j, '{_CHANGE}') IS NULL THEN {_column_sql(_OLD_CHANGE, 'double')} ELSE {_column_sql(_CHANGE, 'double')} END"


def sample_columns(v: str = "v") -> list:
    """A sample's columns out of its record ``v``, all but key and meta; the first view is 0 where none is named."""
    get = lambda p, k="string": F.try_variant_get(v, p, k)
    named = F.when(F.schema_of_variant(F.variant_get(v, "$.scene", "variant")) == "STRING", get("$.scene"))
    return [
        F.when(F.variant_get(v, "$.view", "variant").isNull(), F.lit(0)).otherwise(get("$.view", "int")).alias("view"), F.coalesce(get("$.scene.name"), named).alias("scene_name"),
        absent_or(v, _CHANGE, _OLD_CHANGE).alias("change_ratio"), *[get(p, k).alias(c) for c, p, k in SAMPLE_COLUMNS],
    ]


@query(f"""SELECT row_id, key, CASE WHEN json_extract(j, '$.view') IS NULL THEN 0 ELSE {_column_sql('$.view', 'int')} END AS view, coalesce(json_extract_string(j, '$.scene.name'),
CASE WHEN json_type(j, '$.scene') = 'VARCHAR' THEN json_extract_string(j, '$.scene') END) AS scene_name, {_CHANGE_SQL} AS change_ratio, {', '.join(f'{_column_sql(p, k)} AS {c}' for c, p, k in SAMPLE_COLUMNS)}, t AS meta
FROM (SELECT row_id, key, {_META} AS j, CASE WHEN json_type(TRY_CAST(meta AS JSON)) = 'VARCHAR' THEN json_extract_string(TRY_CAST(meta AS JSON), '$') ELSE meta END AS t FROM samples) WHERE json_type(j) = 'OBJECT'""")
def sample_flatten(spark: SparkSession, d: str) -> DataFrame:
    """All columns of a sample out of its nested record; absent is told from null."""
    v = readable(_samples(spark, d), "meta", "row_id", "key", record_text("meta").alias("meta"))
    return v.select("row_id", "key", *sample_columns(), "meta")


_CASES = """CASE event_id % 4 WHEN 0 THEN '{"a": null, "b": 2}' WHEN 1 THEN '{"b": 2}' WHEN 2 THEN '{"a": 1.5, "b": 2}' ELSE '{bad' END"""


@query(f"""SELECT event_id, CASE WHEN json_extract(j, '$.a') IS NULL THEN TRY_CAST(json_extract_string(j, '$.b') AS DOUBLE) ELSE TRY_CAST(json_extract_string(j, '$.a') AS DOUBLE) END AS x
FROM (SELECT event_id, TRY_CAST({_CASES} AS JSON) AS j FROM events)""")
def sample_flatten_null_vs_absent(spark: SparkSession, d: str) -> DataFrame:
    """1.4: the fallback applies to an absent key, not to a null."""
    v = table(spark, d, "events").select("event_id", F.try_parse_json(F.expr(_CASES)).alias("v"))
    return v.select("event_id", absent_or("v", "$.a", "$.b").alias("x"))


_SPLIT = f"CASE WHEN coalesce(scene_id, 'None') IN {HELD_OUT} THEN 'validation' ELSE 'train' END"
_DISAMBIG = r"coalesce(regexp_matches(edit_instruction, '\b(on the left|on the right|nearest|farthest)\b'), false)"
_NUMBER = "CASE WHEN NOT isnan({x}) THEN CAST({x} AS FLOAT) END"


def _split():
    return F.when(F.coalesce("scene_id", F.lit("None")).isin(*HELD_OUT), "validation").otherwise("train")


def finite(x):
    """A score as it is passed on: NaN is no score."""
    return F.when(~F.isnan(x), x)


_LANDED = r"""(SELECT file_id, regexp_extract(file_path, '^(.*)/', 1) AS folder, json_extract_string(j, '$.job_id') || coalesce('_' || nullif(replace(json_extract_string(j, '$.edit.op'), 'object_', ''), ''), '') || '_v' || json_extract_string(v, '$.view') AS key,
json_extract_string(v, '$.before') AS before, json_extract_string(v, '$.after') AS after FROM (SELECT file_id, file_path, j, unnest(CAST(json_extract(j, '$.views') AS JSON[])) AS v FROM (SELECT file_id, file_path, TRY_CAST(body AS JSON) AS j FROM sample_files) WHERE json_type(j) = 'OBJECT'))"""


def landed_views(spark: SparkSession, d: str) -> DataFrame:
    """file_id, folder, key, before, after of every view in the readable landed records."""
    v = table(spark, d, "sample_files").select("file_id", "file_path", object_variant("body", wrapped=False).alias("j")).where("j is not null")
    e = v.select("file_id", "file_path", "j", F.explode(F.try_variant_get("j", "$.views", "array<variant>")).alias("v"))
    op = F.nullif(F.replace(F.try_variant_get("j", "$.edit.op", "string"), F.lit("object_"), F.lit("")), F.lit(""))
    key = F.concat(F.try_variant_get("j", "$.job_id", "string"), F.coalesce(F.concat(F.lit("_"), op), F.lit("")), F.lit("_v"), F.try_variant_get("v", "$.view", "string"))
    return e.select("file_id", F.regexp_extract("file_path", "^(.*)/", 1).alias("folder"), key.alias("key"), F.try_variant_get("v", "$.before", "string").alias("before"), F.try_variant_get("v", "$.after", "string").alias("after"))


@query(f"""WITH i AS (SELECT key, folder || '/' || before AS source_image, folder || '/' || after AS target_image FROM {_LANDED} WHERE key IS NOT NULL AND before IS NOT NULL AND after IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY key ORDER BY file_id, before, after) = 1),
r AS (SELECT row_id, key, {_META} AS j, CASE WHEN json_type(TRY_CAST(meta AS JSON)) = 'VARCHAR' THEN json_extract_string(TRY_CAST(meta AS JSON), '$') ELSE meta END AS meta_json FROM samples),
e AS (SELECT row_id, key, coalesce(nullif(json_extract_string(j, '$.caption'), ''), json_extract_string(j, '$.instruction'), '') AS edit_instruction, json_extract_string(j, '$.caption_style') AS caption_style,
 json_extract_string(j, '$.caption_lang') AS caption_lang, json_extract_string(j, '$.edit.op') AS edit_op, json_extract_string(j, '$.provenance.scene_source.scene_id') AS scene_id, json_extract_string(j, '$.provenance.scene_source.dataset') AS source_dataset,
 json_extract_string(j, '$.subject.category') AS subject_category, json_extract_string(j, '$.subject.origin') AS subject_origin, {_column_sql('$.edit.validity.quality.sharpness', 'double')} AS s, {_CHANGE_SQL} AS c, meta_json FROM r WHERE json_type(j) = 'OBJECT')
SELECT row_id, key, {_SPLIT} AS split, source_image, target_image, edit_instruction, caption_style, caption_lang, edit_op, replace(edit_op, 'object_', '') AS op, scene_id, source_dataset, subject_category, subject_origin,
{_NUMBER.format(x='s')} AS sharpness, {_NUMBER.format(x='c')} AS change_ratio, {_DISAMBIG} AS disambiguated, meta_json FROM e LEFT JOIN i USING (key)""")
def export_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the export with their images, caption before instruction, held-out scenes as validation."""
    v = readable(_samples(spark, d), "meta", "row_id", "key", record_text("meta").alias("meta_json"))
    get = lambda p: F.try_variant_get("v", p, "string")
    said = F.coalesce(F.nullif(get("$.caption"), F.lit("")), get("$.instruction"), F.lit(""))
    rows = v.select(
        "row_id", "key", said.alias("edit_instruction"), get("$.caption_style").alias("caption_style"), get("$.caption_lang").alias("caption_lang"), get("$.edit.op").alias("edit_op"),
        get("$.provenance.scene_source.scene_id").alias("scene_id"), get("$.provenance.scene_source.dataset").alias("source_dataset"), get("$.subject.category").alias("subject_category"), get("$.subject.origin").alias("subject_origin"),
        finite(F.try_variant_get("v", "$.edit.validity.quality.sharpness", "double")).cast("float").alias("sharpness"), finite(absent_or("v", _CHANGE, _OLD_CHANGE)).cast("float").alias("change_ratio"), "meta_json",
    )
    views = landed_views(spark, d).where("key is not null and before is not null and after is not null")
    images = views.groupBy("key").agg(F.min(F.struct("file_id", "before", "after", "folder")).alias("i"))
    path = lambda c: F.concat_ws("/", "i.folder", f"i.{c}")
    images = images.select("key", path("before").alias("source_image"), path("after").alias("target_image"))
    return rows.join(images, "key", "left").select("*", _split().alias("split"), F.replace("edit_op", F.lit("object_"), F.lit("")).alias("op"), text.is_disambiguated("edit_instruction").alias("disambiguated"))


@query(f"SELECT {_SPLIT} AS split, edit_op, count(*) AS n FROM samples GROUP BY ROLLUP (split, edit_op)")
def export_counts_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Export rows per split and operation, with the sums of each split and of all."""
    return _samples(spark, d).select(_split().alias("split"), "edit_op").rollup("split", "edit_op").agg(F.count("*").alias("n"))


_FLAGS_SQL = f"""(SELECT row_id, edit_op AS op, change_ratio AS cr, background_diff AS bd,
 sqrt(list_sum([x * x for x in CAST(coalesce(json_extract(j, '$.edit.translation_world'), json_extract(j, '$.edit.offset_world')) AS DOUBLE[])])) AS m,
 json_extract_string(j, '$.edit.placement_mode') AS placement, TRY_CAST(json_extract_string(j, '$.edit.factor') AS DOUBLE) AS f, TRY_CAST(json_extract_string(j, '$.edit.dropped_supported') AS INT) AS dropped,
 TRY_CAST(json_extract_string(j, '$.edit.validity.quality.brightness') AS DOUBLE) AS br FROM (SELECT *, {_META} AS j FROM samples))"""
_CODES_SQL = f"""(SELECT row_id, list_filter([CASE WHEN cr < 0.0015 THEN 'imperceptible:3' END, CASE WHEN op = 'object_move' AND m > 3 THEN 'far_move:3' END, CASE WHEN op = 'object_move' AND m > 2 AND m <= 3 THEN 'long_move:1' END,
 CASE WHEN op = 'object_move' AND placement IN ('ceiling', 'wall', 'floating') THEN 'odd_placement:2' END, CASE WHEN op = 'object_scale' AND f <> 0 AND (f > 2.5 OR f < 0.35) THEN 'extreme_scale:2' END,
 CASE WHEN dropped <> 0 THEN 'dropped_objects:1' END, CASE WHEN cr > 0.55 THEN 'huge_change:2' END, CASE WHEN bd > 2 THEN 'bg_drift:2' END, CASE WHEN br < 15 THEN 'dark:2' END], lambda x: x IS NOT NULL) AS codes FROM {_FLAGS_SQL})"""


def _flags(spark: SparkSession, d: str) -> DataFrame:
    v = _samples(spark, d).select("*", _variant().alias("v"))
    get = lambda p, k: F.try_variant_get("v", p, k)
    moved = F.coalesce(get("$.edit.translation_world", "array<double>"), get("$.edit.offset_world", "array<double>"))
    length = F.sqrt(F.aggregate(moved, F.lit(0.0), lambda s, x: s + x * x))
    flags = gates.screen_flags(F.col("edit_op"), F.col("change_ratio"), length, get("$.edit.placement_mode", "string"), get("$.edit.factor", "double"), get("$.edit.dropped_supported", "int"), F.col("background_diff"), get("$.edit.validity.quality.brightness", "double"))
    return v.select("row_id", flags.alias("flags"))


@query(f"SELECT row_id, array_to_string(codes, ',') AS codes FROM {_CODES_SQL}")
def qa_screen_flags(spark: SparkSession, d: str) -> DataFrame:
    """The screening flags of each sample, with their severity."""
    return _flags(spark, d).select("row_id", F.concat_ws(",", F.transform("flags", lambda f: F.concat(f["code"], F.lit(":"), f["severity"].cast("string")))).alias("codes"))


@query(f"SELECT split_part(c, ':', 1) AS code, count(*) AS n FROM (SELECT unnest(codes) AS c FROM {_CODES_SQL}) GROUP BY 1")
def qa_flag_histogram(spark: SparkSession, d: str) -> DataFrame:
    """How often each flag is raised."""
    return _flags(spark, d).select(F.explode("flags.code").alias("code")).groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


@query(f"""SELECT row_id, severity, row_number() OVER (ORDER BY severity DESC, row_id) - 1 AS place FROM (
SELECT row_id, coalesce(list_max([CAST(split_part(c, ':', 2) AS INT) for c in codes]), 0) AS severity FROM {_CODES_SQL})""")
def qa_ranked(spark: SparkSession, d: str) -> DataFrame:
    """Samples by their worst flag, stable in the order of arrival."""
    worst = _flags(spark, d).select("row_id", gates.max_severity(F.col("flags")).alias("severity"), (-gates.max_severity(F.col("flags"))).alias("_o"))
    return rank.ordinal(worst, ["_o", "row_id"], "place").select("row_id", "severity", "place")


@query("""SELECT s.row_id, s.key, coalesce(v.severity, 2) AS severity, v.note FROM samples s JOIN (SELECT 'job_' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS job, CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 3 AS INT) END AS severity, event_type AS note
FROM events) v ON substr(s.job_id, 1, 11) = v.job""")
def qa_review_join(spark: SparkSession, d: str) -> DataFrame:
    """reviewers' verdicts joined to the samples of their job, unmatched ones dropped, severity 2 where none is given."""
    k = F.col("event_id")
    v = table(spark, d, "events").select(F.format_string("job_%07d", k).alias("job"), F.when(k % 3 > 0, (k % 3).cast("int")).alias("severity"), F.col("event_type").alias("note"))
    s = _samples(spark, d).select("row_id", "key", F.substring("job_id", 1, 11).alias("job"))
    return s.join(v, "job").select("row_id", "key", F.coalesce("severity", F.lit(2)).alias("severity"), "note")


@query("SELECT row_id FROM samples WHERE sharpness > 10 AND background_diff < 1 AND edit_op = 'object_move'")
def adhoc_sharp_moves(spark: SparkSession, d: str) -> DataFrame:
    """The sharp moves on a stable background."""
    return _samples(spark, d).where("sharpness > 10 and background_diff < 1 and edit_op = 'object_move'").select("row_id")


@query("""SELECT row_id, greatest(coalesce(penetration_depth, 0), coalesce(floating_gap, 0)) > 0.02 AND coalesce(edit_op, '') <> 'object_delete' AS discarded FROM samples""")
def penetration_gate(spark: SparkSession, d: str) -> DataFrame:
    """Samples whose object sinks in, but for deletions."""
    return _samples(spark, d).select("row_id", gates.penetrates(F.col("penetration_depth"), F.col("floating_gap"), F.col("edit_op")).alias("discarded"))


@query("""SELECT key, min_row AS row_id FROM (SELECT key, edit_op, subject_uid, job_id, min(row_id) AS min_row FROM samples WHERE subject_uid IS NOT NULL AND job_id IS NOT NULL GROUP BY ALL)""")
def pair_dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """of pairs of one job with the same operation and subject (and key), the first."""
    s = _samples(spark, d).where("subject_uid is not null and job_id is not null")
    return s.groupBy("key", "edit_op", "subject_uid", "job_id").agg(F.min("row_id").alias("row_id")).select("key", "row_id")


_KEYS = "(SELECT DISTINCT key FROM samples)"


@query(f"SELECT key, format('edit-{{:06d}}.tar', (row_number() OVER (ORDER BY key) - 1) // {SHARD_SIZE}) AS shard FROM {_KEYS}")
def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The shard of each key, so many in the order of the keys."""
    placed = rank.ordinal(_samples(spark, d).select("key").distinct(), ["key"])
    return placed.select("key", F.format_string("edit-%06d.tar", F.floor(F.col("ordinal") / SHARD_SIZE)).alias("shard"))


@query(f"""SELECT s.row_id, CASE WHEN m.key IS NOT NULL THEN m.shard ELSE s.shard_path END AS shard_path FROM samples s LEFT JOIN (
SELECT key, format('edit-{{:06d}}.tar', (row_number() OVER (ORDER BY key) - 1) // {SHARD_SIZE}) AS shard FROM {_KEYS} WHERE key LIKE '%move%') m USING (key)""")
def shard_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Shard paths filled in from a mapping, for the keys it has."""
    keys = _samples(spark, d).where("key like '%move%'").select("key").distinct()
    m = rank.ordinal(keys, ["key"]).select("key", F.format_string("edit-%06d.tar", F.floor(F.col("ordinal") / SHARD_SIZE)).alias("shard_path"))
    return upsert.backfill(_samples(spark, d).select("row_id", "key", "shard_path"), m, "key", "shard_path").select("row_id", "shard_path")


@query(f"SELECT key FROM (SELECT key, row_number() OVER (ORDER BY key) - 1 AS k FROM {_KEYS}) WHERE k % 8 = 3 ORDER BY k LIMIT 50")
def modulo_shard_limit(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 of one of eight workers' shares by place; the limit comes after the share."""
    placed = rank.ordinal(_samples(spark, d).select("key").distinct(), ["key"])
    return placed.where("ordinal % 8 = 3").orderBy("ordinal").limit(50).select("key")


@query(r"""SELECT DISTINCT regexp_extract(file_path, '(job_\d+)', 1) AS job FROM sample_files WHERE job NOT IN (SELECT regexp_extract(key, '(job_\d+)', 1) FROM samples WHERE view > 0)""")
def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    """Jobs that landed and have no second view among the samples yet."""
    job = lambda c: F.regexp_extract(c, r"(job_\d+)", 1).alias("job")
    return table(spark, d, "sample_files").select(job("file_path")).distinct().join(_samples(spark, d).where("view > 0").select(job("key")), "job", "left_anti")


@query(r"""SELECT regexp_extract(file_path, '(job_\d+)', 1) AS job, count(*) AS n_files FROM sample_files GROUP BY 1""")
def progress_by_job(spark: SparkSession, d: str) -> DataFrame:
    """Landed files per job, by the name of their folder."""
    return table(spark, d, "sample_files").groupBy(F.regexp_extract("file_path", r"(job_\d+)", 1).alias("job")).agg(F.count("*").alias("n_files"))


@query("""SELECT DISTINCT asset_uid, sample_key FROM asset_usage WHERE asset_uid IS NOT NULL AND sample_key IS NOT NULL""")
def usage_unique(spark: SparkSession, d: str) -> DataFrame:
    """each use of an asset by a sample once."""
    return table(spark, d, "asset_usage").where("asset_uid is not null and sample_key is not null").select("asset_uid", "sample_key").distinct()


@query("""SELECT coalesce(a.uid, u.asset_uid) AS uid, coalesce(u.n, a.used_count) AS used_count FROM assets a FULL JOIN (SELECT asset_uid, CAST(count(*) AS INT) AS n FROM asset_usage WHERE asset_uid IS NOT NULL GROUP BY 1) u ON a.uid = u.asset_uid""")
def usage_recount(spark: SparkSession, d: str) -> DataFrame:
    """Use counts by asset; the unused keep their old count, the missing are added."""
    return upsert.recount(table(spark, d, "assets").select("uid", "used_count"), table(spark, d, "asset_usage"))


@query("""SELECT uid, used_count FROM assets WHERE used_count IS NOT NULL ORDER BY used_count DESC, uid LIMIT 20""")
def assets_most_used(spark: SparkSession, d: str) -> DataFrame:
    """The twenty assets used most, as counted."""
    return table(spark, d, "assets").where("used_count is not null").orderBy(F.desc("used_count"), "uid").limit(20).select("uid", "used_count")


#: What came before this time is the table, what came after it the batch that is merged in.
CUTOFF = "2025-07-01"
_OLD, _NEW = (f"(SELECT * REPLACE (CASE WHEN NOT isnan(sharpness) THEN sharpness END AS sharpness) FROM samples WHERE created_at {sign} TIMESTAMPTZ '{CUTOFF} 00:00:00+00' QUALIFY row_number() OVER (PARTITION BY key ORDER BY row_id DESC) = 1)" for sign in ("<", ">="))
_MERGED = ["instruction", "sharpness", "reseated"]


@query(f"""SELECT coalesce(o.key, n.key) AS key, {', '.join(f'CASE WHEN n.key IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}' for c in _MERGED)}, o.shard_path
FROM {_OLD} o FULL JOIN {_NEW} n ON o.key = n.key""")
def samples_upsert(spark: SparkSession, d: str) -> DataFrame:
    """K1 K5: new rows over old ones by key; a null overwrites, NaN is no score, the shard path stays."""
    s = _samples(spark, d).withColumn("sharpness", finite(F.col("sharpness")))
    now = lambda sign: rank.current_rows(s.where(f"created_at {sign} timestamp'{CUTOFF}T00:00:00Z'"), "key", "row_id", [*_MERGED, "shard_path"])
    return upsert.merge(now("<"), now(">="), "key", _MERGED, ["shard_path"])


_SUBJECT = spelled_asset_sql("subject_uid")


def _subject():
    return spelling.asset_uid("subject_uid")


@query(f"""WITH new AS (SELECT DISTINCT key AS sample_key, {_SUBJECT} AS asset_uid FROM samples WHERE {_SUBJECT} IS NOT NULL)
SELECT DISTINCT asset_uid, sample_key FROM asset_usage WHERE sample_key IS NOT NULL AND sample_key NOT IN (SELECT sample_key FROM new) UNION SELECT asset_uid, sample_key FROM new""")
def usage_replace(spark: SparkSession, d: str) -> DataFrame:
    """The uses of each newly ingested sample replaced as a set."""
    old = table(spark, d, "asset_usage").where("sample_key is not null").select("asset_uid", "sample_key")
    new = _samples(spark, d).select(_subject().alias("asset_uid"), F.col("key").alias("sample_key")).where("asset_uid is not null")
    return upsert.replace_sets(old, new, "sample_key")


@query("""WITH catalog AS (SELECT uid, 'catalog' AS source, category FROM assets WHERE category = 'stool' UNION ALL SELECT 'new:' || scene_id, 'catalog', room_kind FROM scenes)
SELECT coalesce(a.uid, c.uid) AS uid, CASE WHEN c.uid IS NOT NULL THEN c.source ELSE a.source END AS source, CASE WHEN c.uid IS NOT NULL THEN c.category ELSE a.category END AS category,
CASE WHEN c.uid IS NOT NULL THEN 0 ELSE a.used_count END AS used_count, a.first_seen IS NOT NULL AS seen_before FROM assets a FULL JOIN catalog c ON a.uid = c.uid""")
def catalog_merge_resets(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue merged into the assets; merged ones count from zero again until the next recount."""
    a = table(spark, d, "assets")
    scenes = table(spark, d, "scenes").select(F.concat(F.lit("new:"), "scene_id").alias("uid"), F.lit("catalog").alias("source"), F.col("room_kind").alias("category"))
    catalog = a.where("category = 'stool'").select("uid", F.lit("catalog").alias("source"), "category").unionByName(scenes).withColumn("used_count", F.lit(0))
    return upsert.merge(a, catalog, "uid", ["source", "category", "used_count"], ["first_seen"]).select("uid", "source", "category", "used_count", F.col("first_seen").isNotNull().alias("seen_before"))


@query("SELECT DISTINCT asset_uid FROM asset_usage WHERE asset_uid <> ''")
def used_uids(spark: SparkSession, d: str) -> DataFrame:
    """The assets in use."""
    return table(spark, d, "asset_usage").where("asset_uid <> ''").select("asset_uid").distinct()


@query(f"""SELECT row_id, list_sort(list_distinct(list_filter(list_concat([json_extract_string(j, '$.subject.asset_uid')], coalesce(TRY_CAST(json_extract(j, '$.provenance.objaverse_uids') AS VARCHAR[]), []),
coalesce(TRY_CAST(json_extract(j, '$.provenance.assets.objaverse_uids') AS VARCHAR[]), [])), lambda x: x <> ''))) AS uids FROM (SELECT row_id, {_META} AS j FROM samples) WHERE json_type(j) = 'OBJECT'""")
def sample_uids_union(spark: SparkSession, d: str) -> DataFrame:
    """all assets that a sample's record names, under its old and its new layout."""
    v = readable(_samples(spark, d), "meta", "row_id")
    many = lambda p: F.coalesce(F.try_variant_get("v", p, "array<string>"), F.array().cast("array<string>"))
    all_ = F.concat(F.array(F.try_variant_get("v", "$.subject.asset_uid", "string")), many("$.provenance.objaverse_uids"), many("$.provenance.assets.objaverse_uids"))
    return v.select("row_id", F.array_sort(F.array_distinct(F.filter(all_, lambda x: x != ""))).alias("uids"))


_TAKEN = "(SELECT asset_uid AS uid FROM asset_usage WHERE created_at < TIMESTAMPTZ '2025-03-01 00:00:00+00' AND asset_uid IS NOT NULL)"
_FRESH = f"(SELECT {_SUBJECT} AS uid FROM samples WHERE {_SUBJECT} IS NOT NULL)"


def _taken(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "asset_usage").where("created_at < timestamp'2025-03-01T00:00:00Z' and asset_uid is not null").select(F.col("asset_uid").alias("uid"))


@query(f"SELECT uid, uid NOT IN (SELECT uid FROM {_TAKEN}) AS is_new FROM (SELECT uid FROM {_TAKEN} UNION SELECT uid FROM {_FRESH})")
def ledger_update(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of used assets after a batch, with what the batch added."""
    return upsert.ledger(_taken(spark, d), _samples(spark, d).select(_subject().alias("uid")), "uid")


@query(f"SELECT uid FROM {_FRESH} EXCEPT SELECT uid FROM {_TAKEN}")
def ledger_diff(spark: SparkSession, d: str) -> DataFrame:
    """what the batch adds."""
    return _samples(spark, d).select(_subject().alias("uid")).where("uid is not null").subtract(_taken(spark, d))


@query(f"SELECT uid FROM assets WHERE uid NOT IN (SELECT uid FROM {_TAKEN} UNION SELECT uid FROM {_FRESH})")
def unused_assets_anti(spark: SparkSession, d: str) -> DataFrame:
    """Assets in neither of two ledgers."""
    used = _taken(spark, d).union(_samples(spark, d).select(_subject()))
    return table(spark, d, "assets").select("uid").join(used, "uid", "left_anti")


def _scenes_left(spark: SparkSession, d: str, used: str) -> DataFrame:
    scenes = table(spark, d, "scenes").select("scene_id")
    ledger = _samples(spark, d).where(used).select(spelling.scene_id("scene_id").alias("scene_id")).where("scene_id is not null")
    return upsert.with_fallback(scenes.join(ledger, "scene_id", "left_anti"), scenes)


def _scenes_left_sql(used: str) -> str:
    return f"""WITH u AS (SELECT scene_id FROM scenes WHERE scene_id NOT IN (SELECT {spelled_scene_sql('scene_id')} FROM samples WHERE scene_id IS NOT NULL AND {used}))
SELECT scene_id FROM u UNION ALL SELECT scene_id FROM scenes WHERE NOT EXISTS (SELECT 1 FROM u)"""


@query(_scenes_left_sql("created_at < TIMESTAMPTZ '2025-03-01 00:00:00+00'"))
def scenes_left(spark: SparkSession, d: str) -> DataFrame:
    """Scenes that no sample had used by March."""
    return _scenes_left(spark, d, "created_at < timestamp'2025-03-01T00:00:00Z'")


@query(_scenes_left_sql("true") .replace("FROM scenes WHERE scene_id NOT IN", "FROM (SELECT scene_id FROM scenes WHERE scene_id IN (SELECT " + spelled_scene_sql("scene_id") + " FROM samples)) WHERE scene_id NOT IN"))
def anti_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Of the scenes in use, those that are not: none, so all scenes."""
    scenes = table(spark, d, "scenes").select("scene_id")
    used = _samples(spark, d).select(spelling.scene_id("scene_id").alias("scene_id")).where("scene_id is not null")
    return upsert.with_fallback(scenes.join(used, "scene_id", "left_semi").join(used, "scene_id", "left_anti"), scenes)


@query(f"""SELECT s.row_id, a.category, coalesce(a.category, 'object') AS noun FROM samples s LEFT JOIN assets a ON a.uid = {spelled_asset_sql('s.subject_uid')}""")
def asset_noun_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The category of each sample's asset, ``object`` on a miss."""
    a = table(spark, d, "assets").select(F.col("uid").alias("subject_uid"), "category")
    return _samples(spark, d).select("row_id", _subject().alias("subject_uid")).join(a, "subject_uid", "left").select("row_id", "category", F.coalesce("category", F.lit("object")).alias("noun"))


_NOUN_SQL = r"coalesce(nullif(trim(regexp_replace(translate(regexp_replace(coalesce(category, ''), '\(.*?\)', '', 'g'), '_-', '  '), '\s+', ' ', 'g')), ''), 'object')"
_STOP = ", ".join(f"'{w}'" for w in text.NOT_A_NOUN)


@query(f"""WITH t AS (SELECT uid, {_NOUN_SQL} AS noun, list_filter(regexp_split_to_array(lower(coalesce(name, '')), '[^a-zA-Z]+'), lambda x: x <> '') AS nw,
 list_filter(flatten([regexp_split_to_array(lower(x), '[^a-zA-Z]+') for x in coalesce(tags, [])]), lambda x: x <> '') AS tw FROM assets),
h AS (SELECT *, list_concat(nw, tw) AS heard, list_filter(regexp_split_to_array(lower(noun), '[^a-zA-Z]+'), lambda x: x <> '') AS cw,
 list_filter(tw, lambda x: regexp_full_match(x, '[a-z]{{3,}}') AND x NOT IN ({_STOP})) AS gt, list_filter(nw, lambda x: regexp_full_match(x, '[a-z]{{3,}}') AND x NOT IN ({_STOP})) AS gn FROM t)
SELECT uid, CASE WHEN noun <> 'object' AND EXISTS (SELECT 1 FROM (SELECT unnest(cw) AS a), (SELECT unnest(heard) AS b) WHERE a = b OR (length(a) >= 4 AND length(b) >= 4 AND (contains(a, b) OR contains(b, a))))
 THEN noun ELSE coalesce(gt[1], gn[1], noun) END AS noun FROM h""")
def best_noun(spark: SparkSession, d: str) -> DataFrame:
    """The likeliest noun of each asset by its category, name and tags."""
    return table(spark, d, "assets").select("uid", text.best_noun("category", "name", "tags").alias("noun"))


_NORM_SQL = r"regexp_replace(regexp_replace(replace(regexp_replace(trim(lower({c})), '_?\([^)]*\)', '', 'g'), '-', '_'), '_+', '_', 'g'), '^_|_$', '', 'g')"
_WALL = ", ".join(f"'{w}'" for w in text.WALL_INTEGRATED)
#: The allow list is a parameter of the semi join; these stand for it in the query.
INDOOR = ("stool", "mug", "lamp", "book", "vase", "sofa", "chair", "desk", "bowl", "plate", "basket", "pillow", "clock", "candle", "table")


@query(f"""SELECT uid, list_contains([{_WALL}], n) OR list_has_any(string_split(n, '_'), [{_WALL}]) AS wall_integrated FROM (SELECT uid, {_NORM_SQL.format(c="coalesce(category, '')")} AS n FROM assets)""")
def wall_integrated(spark: SparkSession, d: str) -> DataFrame:
    """Categories that are part of the wall."""
    return table(spark, d, "assets").select("uid", text.is_wall_integrated("category").alias("wall_integrated"))


def indoor_pool(assets: DataFrame, allowed) -> DataFrame:
    """The assets of allowed categories, by exact match of the normal form; all of them if none is allowed."""
    names = assets.sparkSession.createDataFrame([(c,) for c in allowed], "allowed string").select(text.norm_category("allowed").alias("__pl_n"))
    fit = assets.withColumn("__pl_n", text.norm_category("category")).join(names, "__pl_n", "left_semi").select(*assets.columns)
    return upsert.with_fallback(fit, assets)


@query(f"SELECT uid, category FROM assets WHERE {_NORM_SQL.format(c='category')} IN {INDOOR}")
def indoor_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Assets of allowed categories."""
    return indoor_pool(table(spark, d, "assets").select("uid", "category"), INDOOR)


@query("SELECT uid, category FROM assets")
def indoor_fallback(spark: SparkSession, d: str) -> DataFrame:
    """No category is on the list, so all assets stay."""
    return indoor_pool(table(spark, d, "assets").select("uid", "category"), ["no such category"])


@query(f"""WITH left_ AS (SELECT uid, category FROM assets WHERE {_NORM_SQL.format(c='category')} IN {INDOOR} AND uid NOT IN (SELECT asset_uid FROM asset_usage WHERE asset_uid IS NOT NULL AND created_at < TIMESTAMPTZ '2025-02-01 00:00:00+00'))
SELECT uid, category, CAST(turn AS INT) AS turn FROM (SELECT uid, category, row_number() OVER (PARTITION BY category ORDER BY md5('7:' || uid), uid) AS turn FROM left_)
ORDER BY turn, md5('7:' || category), category, uid LIMIT 60""")
def diverse_sample_round_robin(spark: SparkSession, d: str) -> DataFrame:
    """Sixty unused assets of indoor categories, one of each category per round."""
    used = table(spark, d, "asset_usage").where("asset_uid is not null and created_at < timestamp'2025-02-01T00:00:00Z'").select(F.col("asset_uid").alias("uid"))
    pool = indoor_pool(table(spark, d, "assets").where("category is not null").select("uid", "category"), INDOOR)
    return sampling.round_robin(pool, "category", "uid", 60, excluded=used)


@query("""SELECT uid, coalesce(regexp_matches(lower(name), 'carpet|rug| mat|mat |runner|carpeting'), false) AS floor_cover,
NOT coalesce(regexp_matches(lower(name), 'wall|floor|ceiling|baseboard|pocket|front|back|slab|hole|door|window|column|beam|ceil|cornice'), false) AS furniture FROM assets""")
def asset_filters(spark: SparkSession, d: str) -> DataFrame:
    """Floor coverings, and what is furniture rather than structure."""
    return table(spark, d, "assets").select("uid", text.is_floor_cover("name").alias("floor_cover"), text.is_furniture("name").alias("furniture"))


@query("""SELECT uid, CASE WHEN contains(uid, ':') THEN split_part(uid, ':', 1) WHEN starts_with(uid, 'prim_') THEN 'primitive' ELSE 'objaverse' END AS source FROM assets""")
def asset_source_from_uid(spark: SparkSession, d: str) -> DataFrame:
    """Where an asset comes from, by its uid."""
    return table(spark, d, "assets").select("uid", text.source_of_uid("uid").alias("source"))


@query("""SELECT uid, name AS description, coalesce(tags, [])[1:10] AS tags, license, array_to_string(tags, ',') AS joined,
coalesce(list_filter(string_split(array_to_string(tags, ','), ','), lambda x: x <> ''), []) AS split_again FROM assets""")
def asset_description(spark: SparkSession, d: str) -> DataFrame:
    """An asset's description with at most ten tags, and the tags joined and split again."""
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    joined = F.when(F.col("tags").isNotNull(), F.concat_ws(",", "tags"))
    return table(spark, d, "assets").select("uid", F.col("name").alias("description"), F.slice(tags, 1, 10).alias("tags"), "license", joined.alias("joined"), F.coalesce(F.filter(F.split(joined, ","), lambda x: x != ""), F.array().cast("array<string>")).alias("split_again"))


_SIZE_SQL = "CASE category " + " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in text.CATEGORY_SIZES.items()) + " ELSE 0.3 END"


@query(f"""SELECT uid, {_SIZE_SQL} AS size, 0.3::DOUBLE AS plain_size, least(coalesce(target_size, 1.0), 1.5) / CASE WHEN coalesce(target_size, 0) = 0 THEN 0.000001 ELSE target_size END AS scale,
{_SIZE_SQL} / CASE WHEN coalesce(target_size, 0) = 0 THEN 1.0 ELSE target_size END AS fit FROM assets""")
def category_size(spark: SparkSession, d: str) -> DataFrame:
    """The target size by category or without a map, the scale that matches another object's size, and the one that fits the target; no size counts as one metre."""
    from pairloom.functions.geometry import match_scale

    size, longest = text.category_size("category", 0.3, text.CATEGORY_SIZES), F.coalesce(F.nullif("target_size", F.lit(0.0)), F.lit(1.0))
    return table(spark, d, "assets").select("uid", size.alias("size"), text.category_size("category", 0.3).alias("plain_size"), match_scale(F.coalesce("target_size", F.lit(1.0)), F.coalesce("target_size", F.lit(0.0))).alias("scale"), (size / longest).alias("fit"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'cube' WHEN 1 THEN 'ball' WHEN 2 THEN 'can' WHEN 3 THEN 'cone' WHEN 4 THEN 'head' ELSE 'object' END AS primitive, CASE WHEN p_size % 3 = 0 THEN 'coffee_table' WHEN p_size % 3 = 1 THEN 'bed' ELSE 'object' END AS noun,
CASE WHEN p_size % 3 = 0 THEN 'coffee table' WHEN p_size % 2 = 0 THEN 'night stand' WHEN p_size % 3 = 1 THEN 'bed' END AS support FROM part""")
def object_names(spark: SparkSession, d: str) -> DataFrame:
    """Nouns of objects, of what carries them, and of primitives."""
    n = F.col("p_size")
    uid = F.concat(F.lit("prim_"), F.element_at(F.array(*map(F.lit, [*text.PRIMITIVES, "TORUS"])), (n % 6 + 1).cast("int")))
    noun = F.when(n % 3 == 0, "coffee_table").when(n % 3 == 1, "bed")
    category = F.when(n % 3 == 0, "").when(n % 2 == 0, "night_stand").otherwise("object")
    return table(spark, d, "part").select("p_partkey", text.primitive_noun(uid).alias("primitive"), text.object_noun(noun, F.lit("")).alias("noun"), text.support_noun(noun, category).alias("support"))


@query(f"SELECT file_id, folder, key, after FROM {_LANDED} WHERE key IN (SELECT key FROM samples)")
def sample_scan_views(spark: SparkSession, d: str) -> DataFrame:
    """Landed records exploded by view, unreadable ones skipped, only views whose packed pair exists (semi join)."""
    return landed_views(spark, d).join(_samples(spark, d).select("key"), "key", "left_semi").select("file_id", "folder", "key", "after")


@query(r"""SELECT job_id, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE collision_free) AS BIGINT) AS n_ok, CAST(count(*) FILTER (WHERE NOT collision_free) AS BIGINT) AS n_fail, CAST(sum(num_attempts) AS BIGINT) AS attempts FROM samples GROUP BY job_id""")
def run_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per job how many pairs were made, how many are sound, and the attempts they took."""
    ok = F.col("collision_free")
    return _samples(spark, d).groupBy("job_id").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_fail"), F.sum("num_attempts").alias("attempts"))


@query(r"""SELECT row_id, nullif(regexp_replace(lower(trim(source_dataset)), '^dataset\s*:\s*', ''), '') AS source, 'object_' || nullif(regexp_replace(lower(trim(edit_op)), '^object[_ -]*', ''), '') AS op, nullif(regexp_extract(pipeline_version, '(\d+\.\d+\.\d+)', 1), '') AS version,
nullif(replace(regexp_replace(regexp_replace(lower(trim(scene_id)), '^.*[/\\]', ''), '(\.scene_instance)?\.json$', ''), '_', '-'), '') AS scene FROM samples""")
def canonical_spellings(spark: SparkSession, d: str) -> DataFrame:
    """One spelling for each source, operation, version and scene."""
    return _samples(spark, d).select("row_id", spelling.source_name("source_dataset").alias("source"), spelling.edit_op("edit_op").alias("op"), spelling.version("pipeline_version").alias("version"), spelling.scene_id("scene_id").alias("scene"))


@query("""SELECT row_id, scene_id, tier FROM (SELECT row_id, scene_id, tier, min(tier) OVER (PARTITION BY scene_id) AS best FROM (SELECT row_id, scene_id,
CASE WHEN subject_category IN ('mug', 'lamp') THEN 0 WHEN subject_uid LIKE 'hssd:%' THEN 1 WHEN sharpness > 300 THEN 2 ELSE 3 END AS tier FROM samples WHERE scene_id IS NOT NULL)) WHERE tier = best""")
def subject_pool_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Per scene the first pool of subjects that isn't empty."""
    s = _samples(spark, d).where("scene_id is not null")
    tests = [F.col("subject_category").isin("mug", "lamp"), F.col("subject_uid").like("hssd:%"), F.col("sharpness") > 300]
    return gates.first_nonempty_pool(s, ["scene_id"], tests).select("row_id", "scene_id", "tier")


@query("""SELECT row_id, CASE WHEN sharpness < 100 THEN 'occluded' WHEN change_ratio IS NULL THEN 'area_unchecked' WHEN change_ratio < 0.005 THEN 'too_small' WHEN change_ratio > 0.9 THEN 'too_large' ELSE 'ok' END AS verdict FROM samples""")
def camera_quality(spark: SparkSession, d: str) -> DataFrame:
    """The camera's verdict on what it sees of the subject (sharpness stands for the visible share)."""
    return _samples(spark, d).select("row_id", gates.camera_verdict(F.col("sharpness") / 1000, F.col("change_ratio")).alias("verdict"))
