"""Queries of the problems tagged llm, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import spelling
from pairloom.llm import capping, leaks, mixing, splits, tokens, truncation
from pairloom.operators.rank import current_rows
from pairloom.session import table

CAP = 12
#: No asset may be the subject of more than this share of the samples in ``p4_share``.
SHARE = 0.02


FIELDS = {"source_dataset": spelling.source_name, "edit_op": spelling.edit_op}


def _mixed(spark: SparkSession, d: str, size) -> tuple[DataFrame, dict]:
    """Both mixes from one reading of the current rows."""
    now = current_rows(table(spark, d, "samples"), "key", "row_id", [*FIELDS, "instruction"])
    spelled = F.coalesce(*[F.when(F.col("field_name") == f, spell("source_name")) for f, spell in FIELDS.items()])
    targets = table(spark, d, "mix_targets").select("field_name", spelled.alias("source_name"), "target_share", "max_repeats")
    return mixing.mixes(now, "row_id", {f: spell(f) for f, spell in FIELDS.items()}, size, targets)


def p1_mix(spark: SparkSession, d: str) -> DataFrame:
    """Both mixes, one row per use of a record; every record weighs the same."""
    return mixing.epochs(_mixed(spark, d, F.lit(1))[0]).select("field_name", "source_name", "row_id", "epoch")


def _report(spark: SparkSession, d: str, size) -> DataFrame:
    rows, plan = _mixed(spark, d, size)
    parts = [mixing.report(rows.where(F.col("field_name") == f), plan[f]).select(F.lit(f).alias("field_name"), "*") for f in FIELDS]
    return parts[0].unionByName(parts[1])


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached, of records."""
    return _report(spark, d, F.lit(1))


def p1_token_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached when the size of a record is the number of words of its instruction."""
    return _report(spark, d, F.size(F.filter(F.split("instruction", r"\s+"), lambda w: w != "")))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    now = current_rows(table(spark, d, "samples"), "key", "row_id", ["subject_uid", "sharpness"])
    # NaN is no score
    return now.select("row_id", spelling.asset_uid("subject_uid").alias("asset"), F.when(~F.isnan("sharpness"), F.col("sharpness")).alias("sharpness"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The current rows beyond the 12 sharpest of their asset."""
    return capping.dropped(_subjects(spark, d), "asset", "sharpness", "row_id", CAP).select("row_id")


def p4_kept(spark: SparkSession, d: str) -> DataFrame:
    """The current rows that stay, with those of no asset."""
    now = _subjects(spark, d)
    return capping.kept(now, "asset", "sharpness", "row_id", CAP).unionByName(now.where("asset is null"))


def p4_share(spark: SparkSession, d: str) -> DataFrame:
    """Per asset what stays when none may have more than a fiftieth of the samples left."""
    left = capping.kept_to_share(_subjects(spark, d), "asset", "sharpness", "row_id", SHARE)
    return left.groupBy("asset").agg(F.count("*").alias("n_kept"))


def _links(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "samples")
    return s.select("row_id", F.concat(F.lit("s:"), spelling.scene_id("scene_id")).alias("scene"), F.concat(F.lit("j:"), spelling.job_number("job_id", "key")).alias("job"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of scenes that jobs link, directly or through further scenes."""
    c = splits.components(_links(spark, d).select("job", "scene"))
    scenes = c.where("node like 's:%'").select(F.expr("substring(node, 3)").alias("scene"), "root")
    a, b = scenes.select(F.col("scene").alias("scene_a"), "root"), scenes.select(F.col("scene").alias("scene_b"), "root")
    return a.join(b, "root").where("scene_a < scene_b").select("scene_a", "scene_b")


def _groups(spark: SparkSession, d: str) -> DataFrame:
    """row_id and its group: the root of its job or scene, else the row itself."""
    rows = _links(spark, d)
    c = splits.components(rows.select(F.coalesce("job", "scene").alias("a"), F.coalesce("scene", "job").alias("b")))
    node = F.coalesce("job", "scene")
    return rows.withColumn("node", node).join(c, "node", "left").select("row_id", F.coalesce("root", F.concat(F.lit("r:"), F.col("row_id").cast("string"))).alias("group"))


def p6_splits(spark: SparkSession, d: str) -> DataFrame:
    """The split of every sample."""
    rows = _groups(spark, d)
    sizes = rows.groupBy("group").agg(F.count("*").alias("size"))
    at = splits.assign(sizes, table(spark, d, "split_targets"))
    return rows.join(at, "group").select("row_id", "split_name")


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    """Samples and groups per split, against the targets."""
    sizes = _groups(spark, d).groupBy("group").agg(F.count("*").alias("size"))
    at = splits.assign(sizes, table(spark, d, "split_targets"))
    return at.groupBy("split_name").agg(F.sum("size").alias("n_samples"), F.count("*").alias("n_groups")).join(table(spark, d, "split_targets"), "split_name", "right").fillna(0, ["n_samples", "n_groups"])


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents, tokens and characters per token of each source."""
    docs = table(spark, d, "documents")
    n = tokens.encode(docs, "doc_id", "text").select("doc_id", F.size("ids").alias("n"))
    joined = n.join(docs.select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("c")), "doc_id")
    return joined.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens"), F.sum("c").alias("n_chars"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold a passage of an item, with the item."""
    return leaks.find(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Per leaked item: in how many documents, the longest run, and in how many its answer stands too."""
    found = leaks.find(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"))
    return found.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("longest").alias("longest"), F.count_distinct(F.when(F.col("answer_seen"), F.col("doc_id"))).alias("n_with_answer"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return truncation.judge(table(spark, d, "documents"), "doc_id", "text", "source", "n_chars")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents whose text was cut off."""
    return _judged(spark, d).where("cut").select(F.col("id").alias("doc_id"))


def p9_rules(spark: SparkSession, d: str) -> DataFrame:
    """How many of the cut texts each rule tells."""
    return _judged(spark, d).where("cut").groupBy("rule").agg(F.count("*").alias("n_texts"))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts its texts."""
    return truncation.rates(table(spark, d, "documents"), _judged(spark, d), "source", "text")


_CURRENT = "(SELECT * FROM samples QUALIFY row_number() OVER (PARTITION BY key ORDER BY row_id DESC) = 1)"
_ASSET = r"nullif(replace(regexp_replace(regexp_replace(lower(regexp_replace(subject_uid, '^\s+|\s+$', '', 'g')), '\.glb$', ''), '^objaverse[:/]', ''), '-', ''), '')"
_RANKED = f"""(SELECT row_id, asset, sharpness, row_number() OVER (PARTITION BY asset ORDER BY CASE WHEN isnan(sharpness) THEN NULL ELSE sharpness END DESC NULLS LAST, row_id) AS place
  FROM (SELECT row_id, sharpness, {_ASSET} AS asset FROM {_CURRENT}))"""
_SOURCE = r"regexp_replace(lower(regexp_replace({c}, '^\s+|\s+$', '', 'g')), '^dataset\s*:\s*', '')"
_OP = r"'object_' || regexp_replace(lower(regexp_replace({c}, '^\s+|\s+$', '', 'g')), '^object[_ -]*', '')"


_WORDS = r"len(list_filter(string_split_regex(instruction, '\s+'), lambda w: w <> ''))"


def _used_sql(field: str, spell: str, size: str) -> str:
    """SQL: the records of a mix with their uses, and their source's figures."""
    return f"""(SELECT *, CAST(b // n AS BIGINT) + CASE WHEN upto <= b % n THEN 1 ELSE 0 END AS uses FROM (
    SELECT *, CAST(least(n * max_repeats, floor(min(n * max_repeats / share) OVER () * share + 1e-6)) AS BIGINT) AS b FROM (
      SELECT k.source_name, k.row_id, k.size, t.max_repeats, t.target_share, t.share, CAST(sum(size) OVER (PARTITION BY k.source_name) AS BIGINT) AS n,
        CAST(sum(size) OVER (PARTITION BY k.source_name ORDER BY md5('7:' || k.row_id) || ':' || k.row_id) AS BIGINT) AS upto
      FROM (SELECT row_id, {spell.format(c=field)} AS source_name, {size} AS size FROM {_CURRENT}) k
      JOIN (SELECT {spell.format(c='source_name')} AS source_name, max_repeats, target_share, target_share / sum(target_share) OVER () AS share FROM mix_targets WHERE field_name = '{field}') t
        ON t.source_name = k.source_name WHERE size > 0)))"""


def _mix_sql(field: str, spell: str) -> str:
    return f"SELECT '{field}' AS field_name, source_name, row_id, unnest(range(uses)) AS epoch FROM {_used_sql(field, spell, '1')} WHERE uses > 0"


def _shares_sql(field: str, spell: str, size: str) -> str:
    """SQL: every target of the field, with 0 where its source has no records."""
    return f"""SELECT '{field}' AS field_name, source_name, target_share, CAST(max_repeats AS BIGINT) AS max_repeats, coalesce(n, 0) AS available, coalesce(b, 0) AS budget, coalesce(used, 0) AS used,
coalesce(n_records, 0) AS n_records, coalesce(most_uses, 0) AS most_uses, CAST(coalesce(used, 0) AS DOUBLE) / nullif(sum(used) OVER (), 0) AS actual_share
FROM (SELECT {spell.format(c='source_name')} AS source_name, target_share, max_repeats FROM mix_targets WHERE field_name = '{field}') LEFT JOIN (
 SELECT source_name, max(n) AS n, max(b) AS b, CAST(sum(size * uses) AS BIGINT) AS used, CAST(count(*) FILTER (WHERE uses > 0) AS BIGINT) AS n_records, CAST(max(uses) AS BIGINT) AS most_uses FROM {_used_sql(field, spell, size)} GROUP BY source_name) USING (source_name)"""


def _both(sql, *args: str) -> str:
    return f"{sql('source_dataset', _SOURCE, *args)} UNION ALL {sql('edit_op', _OP, *args)}"


_SCENE = r"nullif(replace(regexp_replace(regexp_replace(lower(trim(scene_id)), '^.*[/\\\\]', ''), '(\.scene_instance)?\.json$', ''), '_', '-'), '')".replace("\\\\", "\\")

ORACLES = {
    "p1_mix": _both(_mix_sql),
    "p1_shares": _both(_shares_sql, "1"),
    "p1_token_shares": _both(_shares_sql, _WORDS),
    "p4_found": f"SELECT row_id FROM {_RANKED} WHERE asset IS NOT NULL AND place > {CAP}",
    "p4_kept": f"SELECT row_id, asset, CASE WHEN NOT isnan(sharpness) THEN sharpness END AS sharpness FROM {_RANKED} WHERE asset IS NULL OR place <= {CAP}",
    "p4_share": f"""WITH n AS (SELECT asset, count(*) AS n FROM {_RANKED} GROUP BY asset), top AS (SELECT max(n) AS n FROM n WHERE asset IS NOT NULL),
c AS (SELECT max(c) AS c FROM (SELECT unnest(range(0, (SELECT n + 1 FROM top))) AS c) WHERE c <= {SHARE}::DOUBLE * (SELECT sum(CASE WHEN asset IS NULL THEN n ELSE least(n, c) END) FROM n) + 1e-9)
SELECT asset, CAST(least(n, c) AS BIGINT) AS n_kept FROM n, c WHERE asset IS NOT NULL AND c > 0""",
    "p6_found": rf"""WITH RECURSIVE e AS (SELECT DISTINCT {_SCENE} AS scene, nullif(regexp_extract(coalesce(job_id, key), '(\d{{7}})', 1), '') AS job FROM samples WHERE scene_id IS NOT NULL),
l AS (SELECT DISTINCT a.scene AS a, b.scene AS b FROM e a JOIN e b USING (job) WHERE a.scene <> b.scene), r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a) SELECT a AS scene_a, b AS scene_b FROM r WHERE a < b""",
}

QUERIES = {f.__name__: f for f in (p1_mix, p1_shares, p1_token_shares, p4_found, p4_kept, p4_share, p6_found, p6_splits, p6_shares, p7_ids, p7_counts, p8_found, p8_leaks, p9_found, p9_rules, p9_rates)}
