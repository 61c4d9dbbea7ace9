"""Queries that run streams, pipelines and round trips through files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import spelling
from pairloom.functions.records import object_variant
from pairloom.operators.rank import current_rows
from pairloom.plans.registry import query, record_sql
from pairloom.session import table, through_folder
from pairloom.sources import scans, sinks
from pairloom.streaming import events as ev
from pairloom.streaming import tasks

REGISTRY = tasks.Registry()


@REGISTRY.register("plus_one")
def plus_one(p: dict) -> dict:
    return p | {"v": p["v"] + 1}


@REGISTRY.register("times_ten")
def times_ten(p: dict) -> dict:
    if p["v"] % 97 == 0:
        raise ValueError("no multiple of 97")
    return p | {"v": p["v"] * 10}


@REGISTRY.register("countdown")
def countdown(p: dict):
    for k in range(p["v"] % 4):
        if k == 2:
            raise ValueError("no third item")
        yield {"v": p["v"], "k": k}


def _payloads(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("v"))).alias("payload"))


_PIPE_SQL = "SELECT event_id, (event_id + 1) % 97 <> 0 AS ok, CASE WHEN (event_id + 1) % 97 <> 0 THEN (event_id + 1) * 10 END AS v FROM events"


def _piped(spark: SparkSession, d: str, mode: str) -> DataFrame:
    out = tasks.pipeline(_payloads(spark, d), [REGISTRY.get("plus_one"), REGISTRY.get("times_ten")], mode, keep=["event_id"])
    return out.select("event_id", "ok", F.get_json_object("result", "$.v").cast("long").alias("v"))


@query(_PIPE_SQL)
def pipeline_staged(spark: SparkSession, d: str) -> DataFrame:
    """Two stages with a barrier between; failures are rows."""
    return _piped(spark, d, "staged")


@query(_PIPE_SQL)
def pipeline_streaming(spark: SparkSession, d: str) -> DataFrame:
    """The same stages as one flow."""
    return _piped(spark, d, "streaming")


_FLAT_SQL = "SELECT event_id, true AS ok, CAST(unnest(range(least(event_id % 4, 2))) AS INT) AS k FROM events UNION ALL SELECT event_id, false, NULL FROM events WHERE event_id % 4 = 3"


def _flat(results: DataFrame) -> DataFrame:
    return results.select("event_id", "ok", F.get_json_object("result", "$.k").cast("int").alias("k"))


@query(_FLAT_SQL)
def stream_flatmap(spark: SparkSession, d: str) -> DataFrame:
    """L4 M3: a task yields several items, on a stream; those before a failure stay."""
    s = ev.event_stream(spark, d).select("event_id", F.to_json(F.struct(F.col("event_id").alias("v"))).alias("payload"))
    return ev.collect_stream(_flat(tasks.run(s, REGISTRY.get("countdown"), keep=["event_id"])))


@query("SELECT count(*) AS done, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS ok, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS fail FROM (" + _PIPE_SQL + ")")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many results came and how many failed."""
    return tasks.summary(_piped(spark, d, "streaming"))


@query("SELECT user_id, count(*) AS n, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def stream_stateful_count(spark: SparkSession, d: str) -> DataFrame:
    """State per key over a stream; the last update of each key."""
    out = ev.collect_stream(ev.running_counts(ev.event_stream(spark, d)), "update")
    return out.groupBy("user_id").agg(F.max("n").alias("n"), F.max_by("kinds", "n").alias("kinds"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """F6 on a stream: the pairs that come, each once."""
    return ev.collect_stream(ev.first_of_each(ev.event_stream(spark, d), ["user_id", "event_type"]))


@query("SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def ext_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Extension: events per hour and type over a stream with a watermark."""
    return ev.collect_stream(ev.tumbling(ev.event_stream(spark, d)), "complete")


@query("""SELECT start, count(*) AS n, max(value) AS highest FROM (SELECT value, unnest([CAST(epoch(date_trunc('hour', ts)) AS BIGINT), CAST(epoch(date_trunc('hour', ts)) AS BIGINT) - 3600]) AS start FROM events) GROUP BY start""")
def ext_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Extension: two-hour windows every hour."""
    return ev.collect_stream(ev.sliding(ev.event_stream(spark, d)), "complete")


@query("""SELECT user_id, min(us) AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, event_id, epoch_us(ts) AS us,
CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 21600000000 THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""")
def ext_session(spark: SparkSession, d: str) -> DataFrame:
    """Extension: sessions of a user, parted by six quiet hours."""
    return ev.collect_stream(ev.sessions(ev.event_stream(spark, d)), "complete")


_NOW = "(SELECT * FROM samples QUALIFY row_number() OVER (PARTITION BY key ORDER BY row_id DESC) = 1)"


@query(f"SELECT coalesce(edit_op, '?') AS op, count(*) AS n FROM {_NOW} GROUP BY 1")
def tar_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Current samples packed into tar shards, and the statistics read off the shards."""
    now = current_rows(table(spark, d, "samples"), "key", "row_id", ["edit_op"])

    def use(at: str) -> DataFrame:
        packed = sinks.pack(now.select("key", F.to_json(F.struct("key", "edit_op")).alias("body")), "key", "body", f"{at}/shards")
        packed.write.mode("overwrite").parquet(f"{at}/keys")  # runs the packing once
        return scans.tar_members(spark, f"{at}/shards").groupBy(F.coalesce(F.get_json_object("body", "$.edit_op"), F.lit("?")).alias("op")).agg(F.count("*").alias("n"))

    return through_folder(spark, "tar", use)


@query(f"SELECT CASE WHEN row_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS rows_sum FROM samples GROUP BY 1")
def split_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Splits written as Parquet and told by their names when read."""

    def use(at: str) -> DataFrame:
        s = table(spark, d, "samples").select("row_id", "key", F.when(F.col("row_id") % 10 == 0, "validation").otherwise("train").alias("split"))
        sinks.save_splits(s, at)
        return scans.splits(spark, at).groupBy("split").agg(F.count("*").alias("n"), F.sum("row_id").alias("rows_sum"))

    return through_folder(spark, "splits", use)


@query("SELECT coalesce(nullif(regexp_replace(lower(trim(edit_op)), '^object[_ -]*', ''), ''), '?') AS op, count(*) AS n, CAST(sum(least(view + 1, 2)) AS BIGINT) AS n_pairs FROM samples GROUP BY 1")
def pair_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """B1: pairs zipped to the shorter list, written as JSON by operation and read again."""

    def use(at: str) -> DataFrame:
        s = table(spark, d, "samples")
        names = lambda n: F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("v"), i.cast("string")))
        out = s.select("row_id", F.coalesce(F.replace(spelling.edit_op("edit_op"), F.lit("object_"), F.lit("")), F.lit("?")).alias("op"), sinks.paired(names(F.col("view") + 1), names(F.lit(2))).alias("views"))
        sinks.write_pairs(out, at)
        read = spark.read.schema("row_id long, views array<struct<before string, after string>>, op string").json(at)
        return read.groupBy("op").agg(F.count("*").alias("n"), F.sum(F.size("views")).alias("n_pairs"))

    return through_folder(spark, "pairs", use)


@query("""SELECT uid AS key, coalesce(nullif(trim(category), ''), 'object') AS category FROM assets""")
def semantics_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A table of semantics as CSV, read with its fallbacks: every uid on two lines, of which the last counts, half of them named by the synset only."""
    synset = F.substring(F.md5("uid"), 1, 1) < "8"
    a = table(spark, d, "assets").select("uid", F.when(~synset, F.col("category")).alias("main_category"), F.when(synset, F.concat("category", F.lit(".n.01"))).alias("wnsynsetkey"), F.lit(1).alias("line"))
    lines = a.unionByName(a.select("uid", F.lit("outdated").alias("main_category"), F.lit(None).cast("string").alias("wnsynsetkey"), F.lit(0).alias("line")))

    def use(at: str) -> DataFrame:
        lines.repartition(1).sortWithinPartitions("uid", "line").drop("line").write.option("header", True).csv(at)
        return scans.semantics(spark, at)

    return through_folder(spark, "semantics", use)


@query("SELECT DISTINCT asset_uid AS uid FROM asset_usage WHERE asset_uid IS NOT NULL")
def ledger_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of used assets saved and loaded."""

    def use(at: str) -> DataFrame:
        sinks.save_ledger(table(spark, d, "asset_usage").select(F.col("asset_uid").alias("uid")), at)
        return spark.read.schema("uid string").json(at)

    return through_folder(spark, "ledger", use)


@query("""SELECT file_id, json_extract_string(j, '$.job_id') AS job FROM (SELECT file_id, TRY_CAST(body AS JSON) AS j FROM sample_files) WHERE j IS NOT NULL""")
def pair_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Pairs told by marked lines of a log; other and broken lines are skipped."""
    lines = table(spark, d, "sample_files").select(F.concat(F.lit(scans.PAIR), F.lit('{"id":'), F.col("file_id").cast("string"), F.lit(',"r":'), F.col("body"), F.lit("}")).alias("value"))
    noise = table(spark, d, "events").select(F.concat(F.lit("progress "), F.col("event_id").cast("string")).alias("value"))
    got = scans.pair_lines(lines.unionByName(noise))
    return got.select(F.get_json_object("record", "$.id").cast("long").alias("file_id"), F.get_json_object("record", "$.r.job_id").alias("job"))


_LIST = "CASE json_type(j, '{p}') WHEN 'ARRAY' THEN CAST(json_extract(j, '{p}') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(j, '{p}')] END"
_CARRIED = "CASE json_type(x, '$.carried') WHEN 'ARRAY' THEN json_array_length(x, '$.carried') WHEN 'OBJECT' THEN 1 ELSE 0 END"


@query(f"""SELECT row_id, len(o) AS n_objects, CAST(coalesce(list_sum([{_CARRIED} for x in o]), 0) AS INT) AS n_carried
FROM (SELECT row_id, {_LIST.format(p='$.scene.params.objects')} AS o FROM (SELECT row_id, {record_sql('meta')} AS j FROM samples)) WHERE o IS NOT NULL""")
def scene_objects(spark: SparkSession, d: str) -> DataFrame:
    """The object lists of scenes, natively from the nested record; a lone object in a list's place is a list of one."""
    items = lambda v, p: F.coalesce(F.try_variant_get(v, p, "array<variant>"), F.when(F.schema_of_variant(F.variant_get(v, p, "variant")).startswith("OBJECT"), F.array(F.variant_get(v, p, "variant"))))
    v = table(spark, d, "samples").select("row_id", object_variant("meta").alias("v")).select("row_id", items("v", "$.scene.params.objects").alias("o")).where("o is not null")
    carried = F.transform("o", lambda x: F.coalesce(F.size(items(x, "$.carried")), F.lit(0)))
    return v.select("row_id", F.size("o").alias("n_objects"), F.aggregate(F.transform(carried, lambda n: F.greatest(n, F.lit(0))), F.lit(0), lambda s, x: s + x).alias("n_carried"))
