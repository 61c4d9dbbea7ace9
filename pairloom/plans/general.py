"""Queries of the general problems 2, 3 and 5: drifting layouts, nested records, small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import spelling
from pairloom.functions.records import object_variant
from pairloom.operators import compaction, drift, nested
from pairloom.session import cut, table, through_folder

CAMERAS, TRIALS, OBJECTS, CARRIED = "cameras", "edit.validity.trials", "scene.params.objects", "scene.params.objects.carried"

#: Options that lift the JSON reader's bounds on nesting, numbers and strings.
DEEP = {"maxNestingDepth": "2147483647", "maxNumLen": "2147483647", "maxStringLen": "2147483647"}


def _versioned(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("row_id", "key", spelling.version("pipeline_version").alias("version"), "meta")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change from one pipeline version's layout to the next."""
    layouts, renamed = drift.study(_versioned(spark, d), "row_id", "key", "version", "meta")
    return drift.changes(spark, layouts, renamed)


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    """All readable metas as one table under the newest names, in the promoted types."""
    df = _versioned(spark, d)
    layouts, renamed = drift.study(df, "row_id", "key", "version", "meta")
    return drift.consolidate(df, "row_id", "version", "meta", layouts, renamed)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every object of the four nested arrays, tied to its place and to the enclosing scene object."""
    # the labels are read three times below; the records are walked once
    n = cut(nested.nodes(table(spark, d, "samples"), "row_id", "meta", [CAMERAS, TRIALS, OBJECTS, CARRIED]))
    linked = nested.link(n.where(F.col("node_path") == CARRIED), n.where(F.col("node_path") == OBJECTS), "row_id")
    rest = n.where(F.col("node_path") != CARRIED).withColumn("parent_pos", F.lit(-1))
    return linked.select("row_id", F.col("node_path").alias("child_path"), "parent_pos", "pos").unionByName(rest.select("row_id", F.col("node_path").alias("child_path"), "parent_pos", "pos"))


def _flat(spark: SparkSession, d: str, path: str, schema: str) -> DataFrame:
    n = nested.nodes(table(spark, d, "samples"), "row_id", "meta", [path], bodies=True)
    return n.select("row_id", "pos", "pre", "post", F.from_json("body", schema, DEEP).alias("b")).select("row_id", "pos", "pre", "post", "b.*")


def p3_cameras(spark: SparkSession, d: str) -> DataFrame:
    v = "array<double>"
    t = _flat(spark, d, CAMERAS, f"view string, location {v}, position {v}, `right` {v}, up {v}, forward {v}, fov double")
    return t.select("row_id", "pos", F.expr("try_cast(view as int)").alias("view"), F.coalesce("position", "location").alias("position"), "right", "up", "forward", "fov")


def p3_trials(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, TRIALS, "n int, ok boolean, why array<string>").drop("pre", "post")


def p3_objects(spark: SparkSession, d: str) -> DataFrame:
    """Scene objects with how many objects each carries, counted by containment."""
    n = cut(nested.nodes(table(spark, d, "samples"), "row_id", "meta", [OBJECTS, CARRIED], bodies=True))
    objects = n.where(F.col("node_path") == OBJECTS)
    carried = nested.link(n.where(F.col("node_path") == CARRIED).drop("body"), objects, "row_id").groupBy("row_id", F.col("parent_pre").alias("pre")).agg(F.count("*").alias("n_carried"))
    body = F.from_json("body", "obj_id string, category string", DEEP)
    return objects.join(carried, ["row_id", "pre"], "left").select("row_id", "pos", body["obj_id"].alias("obj_id"), body["category"].alias("category"), F.coalesce("n_carried", F.lit(0)).alias("n_carried"))


def p3_carried(spark: SparkSession, d: str) -> DataFrame:
    n = cut(nested.nodes(table(spark, d, "samples"), "row_id", "meta", [OBJECTS, CARRIED], bodies=True))
    linked = nested.link(n.where(F.col("node_path") == CARRIED), n.where(F.col("node_path") == OBJECTS), "row_id")
    body = F.from_json("body", "obj_id string, category string", DEEP)
    return linked.select("row_id", "parent_pos", "pos", body["obj_id"].alias("obj_id"), body["category"].alias("category"))


#: Sizes for the compaction of sample.json files: files of some hundred bytes into ones of 1 MB, by 16 at a time.
SMALLEST, TARGET, FAN_IN = 512, 1 << 20, 16
#: Bytes that one record takes in a packed shard, for shards of which only the records are known.
RECORD_BYTES = 320


def file_keys(files: DataFrame) -> DataFrame:
    """file_id, key: the key of every view in the readable bodies (JSON objects)."""
    views = files.select(F.concat(F.lit("file:"), F.col("file_id").cast("string")).alias("file_id"), object_variant("body", wrapped=False).alias("v")).where("v is not null")
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    lone = F.when(F.schema_of_variant(F.variant_get("v", "$.views", "variant")).startswith("OBJECT"), F.array(F.variant_get("v", "$.views", "variant")))
    each = views.select("file_id", get("$.job_id", "string").alias("job"), get("$.edit.op", "string").alias("op"), F.explode(F.coalesce(get("$.views", "array<variant>"), lone)).alias("view"))
    op = F.nullif(F.replace("op", F.lit("object_"), F.lit("")), F.lit(""))
    number = F.try_variant_get("view", "$.view", "string")
    return each.select("file_id", F.concat(F.col("job"), F.coalesce(F.concat(F.lit("_"), op), F.lit("")), F.lit("_v"), number).alias("key")).where("key is not null")


def _compacted(spark: SparkSession, d: str, planned: DataFrame | None = None) -> DataFrame:
    files, samples = table(spark, d, "sample_files"), table(spark, d, "samples")
    shards = samples.select("key", spelling.shard("shard_path").alias("s")).where("s is not null").select("key", F.concat(F.lit("shard:"), "s").alias("file_id"))
    inputs = file_keys(files).withColumn("packed", F.lit(False)).unionByName(shards.withColumn("packed", F.lit(True)))
    return compaction.compact(inputs, _planned(spark, d) if planned is None else planned)


def _planned(spark: SparkSession, d: str) -> DataFrame:
    """The merges of all sample.json files and packed shards."""
    files, samples = table(spark, d, "sample_files"), table(spark, d, "samples")
    sizes = files.select(F.concat(F.lit("file:"), F.col("file_id").cast("string")).alias("file_id"), F.coalesce(F.octet_length("body"), F.lit(0)).cast("long").alias("n_bytes"))
    shards = samples.select(F.concat(F.lit("shard:"), spelling.shard("shard_path")).alias("file_id")).where("file_id is not null")
    packed = shards.groupBy("file_id").agg((F.count("*") * RECORD_BYTES).alias("n_bytes"))
    return compaction.plan(sizes.unionByName(packed), SMALLEST, TARGET, FAN_IN)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The landed records that earlier packing lost (in no shard) or doubled (in two or more), by what the merges saw of them."""
    return faults(_compacted(spark, d))


def faults(compacted: DataFrame) -> DataFrame:
    return compacted.where("landed and n_shards <> 1").select("key", F.when(F.col("n_shards") == 0, "lost").otherwise("doubled").alias("fault"))


def p5_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Every record once, with the file it ends in."""
    return _compacted(spark, d)


def p5_files(spark: SparkSession, d: str) -> DataFrame:
    """The files after compaction: how many records each holds."""
    return _compacted(spark, d).groupBy("output_id").agg(F.count("*").alias("n_records"), F.count_if("landed").alias("n_landed"))


def store(spark: SparkSession, d: str, root: str) -> compaction.Compactor:
    """The sample.json files compacted in ``root``: a row per file with its body, readable or not, and one per key.

    A file without an id goes by the digest of its body; without either it holds nothing.
    """
    files = table(spark, d, "sample_files").select(F.coalesce(F.col("file_id").cast("string"), F.md5("body")).alias("file_id"), "body").where("file_id is not null")
    bodies = files.select(F.concat(F.lit("file:"), "file_id").alias("file_id"), F.lit(None).cast("string").alias("key"), "body")
    sizes = bodies.select("file_id", F.md5("body").alias("h"), F.coalesce(F.octet_length("body"), F.lit(0)).alias("n")).distinct().groupBy("file_id").agg(F.sum("n").cast("long").alias("n_bytes"))
    compactor = compaction.Compactor(spark, root, SMALLEST, TARGET, FAN_IN)
    compactor.run(sizes, bodies.unionByName(file_keys(files).withColumn("body", F.lit(None).cast("string"))))
    return compactor


def p5_written(spark: SparkSession, d: str) -> DataFrame:
    """The sample.json files compacted in storage: what each output file holds - bodies, records by key, bytes of the bodies - read back."""

    def use(root: str) -> DataFrame:
        compactor = store(spark, d, root)
        if compactor.journal() is None:
            return spark.createDataFrame([], "output_id string, n_files long, n_records long, n_bytes long")
        return compactor.data().groupBy("output_id").agg(F.count_if(F.col("key").isNull()).alias("n_files"), F.count("key").alias("n_records"), F.sum(F.coalesce(F.octet_length("body"), F.lit(0))).alias("n_bytes"))

    return through_folder(spark, "compaction", use)


QUERIES = {f.__name__: f for f in (p2_found, p2_table, p3_found, p3_cameras, p3_trials, p3_objects, p3_carried, p5_found, p5_compacted, p5_files, p5_written)}

_REC = "(SELECT row_id, CASE WHEN json_type(j) = 'VARCHAR' THEN TRY_CAST(json_extract_string(j, '$') AS JSON) ELSE j END AS j FROM (SELECT row_id, TRY_CAST(meta AS JSON) AS j FROM samples))"


def _each(parent: str, path: str, out: str, keep: str) -> str:
    """SQL: the elements at ``path`` of JSON ``j`` with their place; a lone object is an array of one."""
    items = f"CASE json_type(j, '{path}') WHEN 'ARRAY' THEN CAST(json_extract(j, '{path}') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(j, '{path}')] ELSE [] END"
    return f"(SELECT {keep}, o[i] AS {out}, CAST(i - 1 AS INT) AS pos FROM (SELECT *, unnest(range(1, len(o) + 1)) AS i FROM (SELECT *, {items} AS o FROM {parent})) WHERE json_type(o[i]) = 'OBJECT')"


_OBJECTS = _each(_REC, "$.scene.params.objects", "j", "row_id")

ORACLES = {
    "p3_found": f"""SELECT row_id, '{CAMERAS}' AS child_path, -1 AS parent_pos, pos FROM {_each(_REC, '$.cameras', 'x', 'row_id')}
UNION ALL SELECT row_id, '{TRIALS}', -1, pos FROM {_each(_REC, '$.edit.validity.trials', 'x', 'row_id')} UNION ALL SELECT row_id, '{OBJECTS}', -1, pos FROM {_OBJECTS}
UNION ALL SELECT row_id, '{CARRIED}', parent_pos, pos FROM {_each(f'(SELECT row_id, j, pos AS parent_pos FROM {_OBJECTS})', '$.carried', 'x', 'row_id, parent_pos')}""",
    "p3_objects": f"""SELECT row_id, pos, json_extract_string(j, '$.obj_id') AS obj_id, json_extract_string(j, '$.category') AS category, CAST(CASE json_type(j, '$.carried') WHEN 'OBJECT' THEN 1 WHEN 'ARRAY' THEN
 len(list_filter(CAST(json_extract(j, '$.carried') AS JSON[]), lambda x: json_type(x) = 'OBJECT')) ELSE 0 END AS BIGINT) AS n_carried FROM {_OBJECTS}""",
    "p3_carried": f"""SELECT row_id, parent_pos, pos, json_extract_string(x, '$.obj_id') AS obj_id, json_extract_string(x, '$.category') AS category
FROM {_each(f'(SELECT row_id, j, pos AS parent_pos FROM {_OBJECTS})', '$.carried', 'x', 'row_id, parent_pos')}""",
    "p5_found": r"""WITH k AS (SELECT DISTINCT json_extract_string(j, '$.job_id') || coalesce('_' || nullif(replace(json_extract_string(j, '$.edit.op'), 'object_', ''), ''), '') || '_v' || json_extract_string(v, '$.view') AS key
 FROM (SELECT j, unnest(CAST(json_extract(j, '$.views') AS JSON[])) AS v FROM (SELECT TRY_CAST(body AS JSON) AS j FROM sample_files) WHERE json_type(j) = 'OBJECT')),
s AS (SELECT key, count(DISTINCT shard) AS n FROM (SELECT key, nullif(regexp_replace(regexp_extract(replace(lower(trim(shard_path)), '\', '/'), '((?:[^/]+/+)?[^/]+)/*$', 1), '/+', '/', 'g'), '') AS shard FROM samples) GROUP BY key)
SELECT key, CASE WHEN coalesce(n, 0) = 0 THEN 'lost' ELSE 'doubled' END AS fault FROM k LEFT JOIN s USING (key) WHERE key IS NOT NULL AND coalesce(n, 0) <> 1""".replace("'\\\\'", "'\\'"),
}
