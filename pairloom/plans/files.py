"""Queries that read and write the forms in which data comes and goes: job folders, lists, maps, scene files, databases, reports, progress."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import images, spelling
from pairloom.operators import upsert
from pairloom.plans import samples
from pairloom.plans.registry import query, record_sql, spelled_asset_sql
from pairloom.plans.samples import _LANDED
from pairloom.session import cut, remove, table, through_folder
from pairloom.sources import scans, sinks
from pairloom.streaming import tasks


#: Job folders that are there at once; more follow in waves, as a folder's directory and three files take far more room than its record.
FOLDERS = 40_000


def _files(spark: SparkSession, d: str) -> DataFrame:
    """file_id, folder, file, content: the landed records as job folders f<file_id> with sample.json and images; some images are missing, some broken."""
    i = F.col("file_id")
    folder = F.format_string("f%d", i).alias("folder")
    records = table(spark, d, "sample_files").where("body is not null").select(i, folder, F.lit("sample.json").alias("file"), F.encode("body", "utf-8").alias("content"))
    content = F.when(i % 11 == 0, F.lit(b"no image")).otherwise(F.lit(scans.PNG))
    sides = F.array(F.when(i % 7 != 0, F.col("before")), F.when(i % 5 != 0, F.col("after")))
    shown = samples.landed_views(spark, d).select(i, F.explode(sides).alias("file")).where("file is not null")  # one that is named twice is the same file
    return records.unionByName(shown.select(i, folder, "file", content.alias("content")))


def _job_folders(files: DataFrame, root: str, old: str | None) -> list[str]:
    """Job folders of ``files``; returns the folders that hold them. On a local file system they are made of those below ``old``, which are there no more."""
    files = files.repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "folder").sortWithinPartitions("folder")  # a folder is made by one task, at once
    if isinstance(sinks.filesystem(root)[0], fs.LocalFileSystem):
        return sinks.refill_folders(files, "folder", "file", "content", root, old)
    sinks.write_files(files.select(F.concat_ws("/", "folder", "file").alias("name"), "content"), "name", "content", root)
    return [root]


def _through_job_folders(spark: SparkSession, d: str, scan: Callable[[list[str]], DataFrame]) -> DataFrame:
    """What ``scan`` reads from all job folders, of which at most twice ``FOLDERS`` are there at once: the next wave is made of a wave's folders or, where that can't be, written while they are removed."""

    def use(at: str) -> DataFrame:
        waves = max(1, -(-table(spark, d, "sample_files").count() // FOLDERS))
        files = _files(spark, d)
        if waves > 1:  # parted once, so that a wave reads no other's
            files = files.withColumn("wave", F.pmod(F.xxhash64("file_id"), F.lit(waves)))
            files.write.partitionBy("wave").parquet(f"{at}/files")
            files = spark.read.schema(files.schema).parquet(f"{at}/files")  # there may be none
        local = isinstance(sinks.filesystem(at)[0], fs.LocalFileSystem)
        with ThreadPoolExecutor(1) as aside:
            removed = None
            for k in range(waves):
                made = _job_folders(files.where(F.col("wave") == k) if waves > 1 else files, f"{at}/wave-{k}", f"{at}/wave-{k - 1}" if k else None)
                scan(made).write.mode("append").parquet(f"{at}/scanned")
                if removed:
                    removed.result()
                if not local:
                    removed = aside.submit(remove, spark, made[0])
            sinks.remove_folders(spark, made) if local else removed.result()
        return spark.read.parquet(f"{at}/scanned")

    return through_folder(spark, "jobs", use)


def _file_id():
    return F.expr("cast(substring(job_dir, 2) as bigint)").alias("file_id")


@query(f"SELECT file_id, key, before, after FROM {_LANDED} WHERE file_id % 7 <> 0 AND file_id % 5 <> 0")
def folder_scan(spark: SparkSession, d: str) -> DataFrame:
    """Job folders written and scanned: readable records by view, only those whose two images are there."""
    return _through_job_folders(spark, d, lambda at: scans.sample_views(spark, at).select(_file_id(), "key", "before", "after"))


@query(f"SELECT file_id, min(before) AS before, min(after) AS after FROM {_LANDED} WHERE file_id % 7 <> 0 AND file_id % 5 <> 0 AND file_id % 11 <> 0 GROUP BY file_id")
def first_image_scan(spark: SparkSession, d: str) -> DataFrame:
    """A2: job folders by their first images, only those where both are PNG files."""
    return _through_job_folders(spark, d, lambda at: scans.first_images(spark, at).select(_file_id(), "before", "after"))


@query("SELECT uid FROM assets")
def uid_list_scan(spark: SparkSession, d: str) -> DataFrame:
    """A5: a list of uids, trimmed, blank lines skipped."""

    def use(at: str) -> DataFrame:
        lines = table(spark, d, "assets").select(F.explode(F.array(F.concat(F.lit("  "), "uid", F.lit(" ")), F.lit(""), F.lit("   "))).alias("value"))
        lines.write.text(at)
        return scans.uid_list(spark, at)

    return through_folder(spark, "uids", use)


def _map_file(entries: DataFrame, root: str) -> None:
    """One JSON object of key and value (JSON text)."""
    pairs = entries.select(F.concat(F.to_json(F.array("key")), F.lit(":"), "value").alias("p"), "key")
    members = F.array_join(F.transform(F.collect_list("p"), lambda p: F.regexp_replace(p, r'^\[(.*?)\]:', "$1:")), ",")
    sinks.write_files(pairs.agg(F.concat(F.lit("{"), members, F.lit("}")).alias("content")).select(F.lit("map.json").alias("name"), "content"), "name", "content", root)


@query("SELECT uid, coalesce(category, 'object') AS category FROM assets")
def category_map_scan(spark: SparkSession, d: str) -> DataFrame:
    """A JSON map of categories."""

    def use(at: str) -> DataFrame:
        _map_file(table(spark, d, "assets").select(F.col("uid").alias("key"), F.regexp_extract(F.to_json(F.array(F.coalesce("category", F.lit("object")))), r"^\[(.*)\]$", 1).alias("value")), at)
        return scans.category_map(spark, f"{at}/map.json")

    return through_folder(spark, "map", use)


@query("SELECT uid, category, name, tags, license FROM assets WHERE substr(md5(uid), 1, 1) < '8'")
def meta_map_scan(spark: SparkSession, d: str) -> DataFrame:
    """A JSON map of which only the entries that are objects count."""

    def use(at: str) -> DataFrame:
        whole = F.to_json(F.struct("category", "name", "tags", "license"))
        _map_file(table(spark, d, "assets").select(F.col("uid").alias("key"), F.when(F.substring(F.md5("uid"), 1, 1) < "8", whole).otherwise('"no object"').alias("value")), at)
        return scans.meta_map(spark, f"{at}/map.json")

    return through_folder(spark, "map", use)


_PLACED = """(SELECT p_partkey // 50 AS scene, 'objects/' || p_type AS template, row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS pos, CAST(p_size AS DOUBLE) AS x,
CASE WHEN p_partkey % 3 = 0 THEN [0.0, 1.0, 0.0, 0.0] ELSE [1.0, 0.0, 0.0, 0.0] END AS q, CASE p_partkey % 4 WHEN 0 THEN [2.0, 2.0, 2.0] WHEN 1 THEN [1.0, 2.0, 3.0] ELSE [1.0, 1.0, 1.0] END AS s FROM part)"""


def _scene_files(spark: SparkSession, d: str, root: str) -> DataFrame:
    """Scene files of the parts, fifty a scene: a turn and a scale where they aren't the usual ones, one number as scale for some."""
    k = F.col("p_partkey")
    turn = F.when(k % 3 == 0, F.lit(', "rotation": [0, 1, 0, 0]')).otherwise("")
    scale = F.when(k % 4 == 0, F.lit(', "non_uniform_scale": 2')).when(k % 4 == 1, ', "non_uniform_scale": [1, 2, 3]').otherwise("")
    one = F.concat(F.lit('{"template_name": "objects/'), "p_type", F.lit('", "translation": ['), F.col("p_size").cast("string"), F.lit(", 0, 0.5]"), turn, scale, F.lit("}"))
    scenes = table(spark, d, "part").groupBy(F.floor(k / 50).alias("scene")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), one.alias("o")))), lambda x: x["o"]), ",").alias("o"))
    sinks.write_files(scenes.select(F.format_string("scene-%d.json", "scene").alias("name"), F.concat(F.lit('{"object_instances": ['), "o", F.lit("]}")).alias("content")), "name", "content", root)
    return scans.scene_instances(spark, f"{root}/*.json").withColumn("scene", F.regexp_extract("file", r"scene-(\d+)\.json$", 1).cast("long"))


@query(f"SELECT scene, CAST(pos AS INT) AS pos, template, [x, 0.0, 0.5]::DOUBLE[] AS translation, q::DOUBLE[] AS rotation, s::DOUBLE[] AS scale FROM {_PLACED}")
def scene_instance_scan(spark: SparkSession, d: str) -> DataFrame:
    """The object instances of scene files with their poses and defaults."""
    return through_folder(spark, "scenes", lambda at: _scene_files(spark, d, at).select("scene", "pos", "template", "translation", "rotation", "scale"))


@query(f"SELECT DISTINCT template FROM {_PLACED} ORDER BY template")
def scene_templates(spark: SparkSession, d: str) -> DataFrame:
    """F8: the templates that scenes use, each once, in order."""
    return through_folder(spark, "scenes", lambda at: _scene_files(spark, d, at).select("template").distinct()).orderBy("template")


@query("""SELECT template, CASE WHEN length(template) % 4 = 0 THEN template[9:9] || '/' || template || '.glb' WHEN length(template) % 4 = 1 THEN 'decomposed/' || template[9:9] || '/' || template || '.glb'
WHEN length(template) % 4 = 2 THEN 'decomposed/' || template || '.glb' END AS path FROM (SELECT DISTINCT 'objects/' || p_type AS template FROM part)""")
def first_candidate_path(spark: SparkSession, d: str) -> DataFrame:
    """Of three places where a template's file can be, the first that the listing has."""
    t = table(spark, d, "part").select(F.concat(F.lit("objects/"), "p_type").alias("template")).distinct()
    head, n = F.substring("template", 9, 1), F.length("template") % 4
    places = F.array(F.concat(head, F.lit("/"), "template", F.lit(".glb")), F.concat(F.lit("decomposed/"), head, F.lit("/"), "template", F.lit(".glb")), F.concat(F.lit("decomposed/"), "template", F.lit(".glb")))
    # the first kind is listed in all its places, so that the order tells
    listing = t.select(F.explode(F.when(n == 0, places).when(n == 1, F.slice(places, 2, 2)).when(n == 2, F.slice(places, 3, 1)).otherwise(F.array().cast("array<string>"))).alias("file"))
    return scans.first_existing(t, places, listing, "file", "path")


_DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


def _derby(spark: SparkSession, url: str, *statements: str) -> None:
    """Statements run in this JVM by an embedded database, which is then shut down so that other JVMs can open it."""
    driver = spark._jvm.org.apache.derby.jdbc.EmbeddedDriver()
    if statements:
        connection = driver.connect(f"{url};create=true", spark._jvm.java.util.Properties())
        for s in statements:
            connection.createStatement().execute(s)
        connection.close()
    try:
        driver.connect(f"{url};shutdown=true", spark._jvm.java.util.Properties())
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # how it says that it has shut down
            raise


@query("SELECT uid, category, used_count FROM assets WHERE used_count > 3")
def database_scan(spark: SparkSession, d: str) -> DataFrame:
    """A table over JDBC, read in parallel by ranges of a number, with filter and columns pushed down.

    The database is an embedded one, which only one JVM can write: tasks write the rows as text, the driver's JVM has the
    database import that file by file and packs it, and all executors read the pack, which needs no lock. The shared
    folder must be one that the machines have mounted; ``scans.database`` takes any URL.
    """

    def use(at: str) -> DataFrame:
        system, root = sinks.filesystem(at)
        if not isinstance(system, fs.LocalFileSystem):
            raise RuntimeError("an embedded database needs a spark.checkpoint.dir that all machines have mounted")
        quoted = lambda c: F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
        fields = [F.xxhash64("uid").cast("string"), quoted("uid"), quoted("category"), F.coalesce(F.col("used_count").cast("string"), F.lit(""))]
        table(spark, d, "assets").select(F.concat_ws(",", *fields).alias("value")).write.text(f"{at}/rows")
        with tempfile.TemporaryDirectory() as folder:
            spark._jvm.System.setProperty("derby.stream.error.file", os.path.join(folder, "log"))
            parts = sorted(f.path for f in system.get_file_info(fs.FileSelector(f"{root}/rows")) if f.path.endswith(".txt") and f.size)
            made = os.path.join(folder, "db")
            imports = [f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, 'ASSETS', '{p}', NULL, NULL, 'UTF-8', 0)" for p in parts]
            _derby(spark, f"jdbc:derby:{made}", 'CREATE TABLE ASSETS ("id" BIGINT, "uid" CLOB, "category" CLOB, "used_count" INTEGER)', *imports)
            with zipfile.ZipFile(f"{root}/db.zip", "w", zipfile.ZIP_STORED) as pack:  # stored, so that a page is found without reading those before it
                for at_, _, names in os.walk(made):
                    for name in names:
                        pack.write(os.path.join(at_, name), os.path.relpath(os.path.join(at_, name), folder))
        url = f"jdbc:derby:jar:({root}/db.zip)db"
        try:
            return cut(scans.database(spark, url, "assets", "id", (-(1 << 63), (1 << 63) - 1), 4, driver=_DERBY).where("used_count > 3").select("uid", "category", "used_count"))
        finally:
            _derby(spark, url)

    return through_folder(spark, "database", use)


_FIRST_USE = f"(SELECT uid, min(strftime(created_at, '%Y-%m')) AS month FROM (SELECT {spelled_asset_sql('subject_uid')} AS uid, created_at FROM samples) WHERE uid IS NOT NULL AND created_at IS NOT NULL GROUP BY uid)"


@query(f"SELECT month, count(*) AS new_uids, CAST(sum(count(*)) OVER (ORDER BY month) AS BIGINT) AS all_uids FROM {_FIRST_USE} GROUP BY month ORDER BY month DESC LIMIT 5")
def ledger_batches(spark: SparkSession, d: str) -> DataFrame:
    """The last five batches of the ledger: monthly, with the assets each added and all up to it."""
    used = table(spark, d, "samples").select(spelling.asset_uid("subject_uid").alias("uid"), F.date_format("created_at", "yyyy-MM").alias("month"))
    return upsert.batches(used, "uid", "month").orderBy(F.desc("month")).limit(5)


@query("SELECT count(*) AS done, CAST(count(*) FILTER (WHERE event_type <> 'view') AS BIGINT) AS ok, CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS fail FROM events WHERE event_type IS NOT NULL")
def progress_log(spark: SparkSession, d: str) -> DataFrame:
    """Progress appended in two parts as JSON lines, and its summary."""

    def use(at: str) -> DataFrame:
        e = table(spark, d, "events").where("event_type is not null").select("event_id", (F.col("event_type") != "view").alias("ok"))
        for part in (0, 1):
            sinks.append_progress(e.where(F.col("event_id") % 2 == part), at)
        return tasks.summary(spark.read.schema("event_id long, ok boolean").json(at))

    return through_folder(spark, "progress", use)


@query(f"""SELECT CAST(place // 500 AS BIGINT) AS page, count(*) AS n_rows, min(row_id) AS lowest, max(row_id) AS highest FROM (SELECT row_id, row_number() OVER (ORDER BY severity DESC, row_id) - 1 AS place FROM (
SELECT row_id, list_max([CAST(split_part(c, ':', 2) AS INT) for c in codes]) AS severity FROM {samples._CODES_SQL} WHERE len(codes) > 0)) GROUP BY 1""")
def report_pages(spark: SparkSession, d: str) -> DataFrame:
    """All flagged samples as a report in pages, the worst first, with what each page holds read back."""

    def use(at: str) -> DataFrame:
        flagged = samples._flags(spark, d).where("size(flags) > 0").join(table(spark, d, "samples").select("row_id", "instruction"), "row_id")
        rows = flagged.select("row_id", "instruction", F.concat_ws(", ", "flags.code").alias("flags"), (-samples.gates.max_severity(F.col("flags"))).alias("order"), F.concat(F.lit("before_"), F.col("row_id").cast("string")).alias("before"))
        sinks.write_pages(rows, ["order", "row_id"], ["row_id", "instruction", "flags", "before"], "flagged", at, images=["before"])
        ids = F.regexp_extract_all("value", F.lit(r"<tr><td>(\d+)</td>")).cast("array<long>")
        pages = spark.read.option("wholetext", True).text(f"{at}/*.html").select(F.regexp_extract(F.input_file_name(), r"page-(\d+)\.html$", 1).cast("long").alias("page"), F.explode(ids).alias("row_id"))
        return pages.groupBy("page").agg(F.count("*").alias("n_rows"), F.min("row_id").alias("lowest"), F.max("row_id").alias("highest"))

    return through_folder(spark, "report", use)


@query()
def dataset_card(spark: SparkSession, d: str) -> DataFrame:
    """The dataset card, line by line."""
    by_source = samples._packed(spark, d, "source_dataset").groupBy(F.col("source_dataset").alias("source")).agg(F.count("*").alias("n"))
    text = sinks.card("Object edits", samples.stats_total(spark, d), samples.dataset_stats_by_op(spark, d), by_source, samples.stats_licenses(spark, d))
    return spark.createDataFrame(list(enumerate(text.splitlines())), "line int, text string")


# The licences of scene datasets.
SCENE_LICENSES = {"hssd": "CC-BY-NC 4.0", "front3d": "academic", "tabletop": "synthetic", "room": "synthetic composite"}
_LICENSE_SQL = "CASE dataset " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SCENE_LICENSES.items()) + " END"


@query(f"""SELECT row_id, dataset, {_LICENSE_SQL} AS license, uids, subject_uid, coalesce(json_extract_string(j, '$.subject.origin'), 'scene') AS origin, list_filter(string_split(coalesce(json_extract_string(j, '$.subject.tags'), ''), ','), lambda t: t <> '' AND t NOT LIKE '[%') AS tags
FROM (SELECT row_id, j, coalesce(json_extract_string(j, '$.provenance.scene_source.dataset'), json_extract_string(j, '$.provenance.dataset')) AS dataset, json_extract_string(j, '$.subject.asset_uid') AS subject_uid,
 list_sort(list_distinct(coalesce(TRY_CAST(json_extract(j, '$.provenance.assets.objaverse_uids') AS VARCHAR[]), TRY_CAST(json_extract(j, '$.provenance.objaverse_uids') AS VARCHAR[]), []))) AS uids FROM (SELECT row_id, {record_sql('meta')} AS j FROM samples) WHERE json_type(j) = 'OBJECT' AND json_type(j, '$.subject.tags') = 'VARCHAR')""")
def provenance(spark: SparkSession, d: str) -> DataFrame:
    """The provenance of a sample put together: dataset with its licence, assets each once, subject and its origin, tags split (of records whose tags are one text)."""
    from pairloom.functions.records import object_variant

    v = table(spark, d, "samples").select("row_id", object_variant("meta").alias("v")).where("v is not null").where(F.schema_of_variant(F.variant_get("v", "$.subject.tags", "variant")) == "STRING")
    get = lambda p, k="string": F.try_variant_get("v", p, k)
    dataset = F.coalesce(get("$.provenance.scene_source.dataset"), get("$.provenance.dataset"))
    uids = F.coalesce(get("$.provenance.assets.objaverse_uids", "array<string>"), get("$.provenance.objaverse_uids", "array<string>"), F.array().cast("array<string>"))
    license_ = F.create_map(*[F.lit(x) for kv in SCENE_LICENSES.items() for x in kv])[dataset]
    tags = F.filter(F.split(get("$.subject.tags"), ","), lambda t: (t != "") & ~F.startswith(t, F.lit("[")))
    block = F.struct(dataset.alias("dataset"), license_.alias("license"), F.array_sort(F.array_distinct(uids)).alias("uids"), get("$.subject.asset_uid").alias("subject_uid"), F.coalesce(get("$.subject.origin"), F.lit("scene")).alias("origin"), tags.alias("tags"))
    return v.select("row_id", block.alias("p")).select("row_id", "p.*")


@query("SELECT row_id, key, CAST(NULL AS VARCHAR) AS scene_id, source_dataset, CAST(NULL AS VARCHAR) AS pipeline_version FROM samples")
def added_columns(spark: SparkSession, d: str) -> DataFrame:
    """K6: a table of an older form with its missing columns added as nulls; those it has stay."""
    old = table(spark, d, "samples").select("row_id", "key", "source_dataset")
    return upsert.add_columns(old, {c: "string" for c in ("scene_id", "source_dataset", "pipeline_version")}).select("row_id", "key", "scene_id", "source_dataset", "pipeline_version")


@query("SELECT CASE WHEN row_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split, count(*) AS n, 'packed, counted' AS steps FROM samples GROUP BY 1")
def post_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Steps after rendering in turn, each fed by the results of those before: pack by split, then count what was packed."""

    def packed(p: dict) -> dict:
        sinks.save_splits(table(spark, d, "samples").select("row_id", F.when(F.col("row_id") % p["every"] == 0, "validation").otherwise("train").alias("split")), p["raw_dir"] + "/packed")
        return {"parquet_dir": p["raw_dir"] + "/packed", "steps": "packed"}

    def counted(p: dict) -> dict:
        return {"counts": scans.splits(spark, p["parquet_dir"]).groupBy("split").agg(F.count("*").alias("n")), "steps": p["steps"] + ", counted"}

    def use(at: str) -> DataFrame:
        out = tasks.fold({"raw_dir": at}, [(packed, {"every": 10}), (counted, {})])
        return out["counts"].withColumn("steps", F.lit(out["steps"]))

    return through_folder(spark, "post", use)


def _plus(p: dict) -> dict:
    return p | {"v": p["v"] + 1}


def _even(p: dict) -> dict:
    if p["v"] % 2:
        raise ValueError("odd")
    return p


@query("SELECT 'plus' AS stage, count(*) AS done, count(*) AS ok FROM events UNION ALL SELECT 'even', count(*), CAST(count(*) FILTER (WHERE (event_id + 1) % 2 = 0) AS BIGINT) FROM events")
def produced_per_stage(spark: SparkSession, d: str) -> DataFrame:
    """What each stage of a pipeline gave, counted on the way."""
    payloads = table(spark, d, "events").select(F.to_json(F.struct(F.col("event_id").alias("v"))).alias("payload"))
    return tasks.stage_counts(payloads, [("plus", _plus), ("even", _even)])


def _slow(p: dict) -> dict:
    import time

    time.sleep(6 if p["v"] == 7 else 0)
    return p


@query("SELECT event_id, event_id <> 7 AS ok, CASE WHEN event_id = 7 THEN 'TimeoutError: more than 3.0 s' END AS error FROM events")
def task_timeouts(spark: SparkSession, d: str) -> DataFrame:
    """Tasks several at once, without order; one that takes too long fails and is left behind."""
    payloads = table(spark, d, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("v"))).alias("payload"))
    return tasks.run(payloads, _slow, keep=["event_id"], timeout=3.0, at_once=8).select("event_id", "ok", "error")


@query("SELECT event_type, count(*) AS n, max(value) - min(value) AS spread FROM events GROUP BY event_type")
def reduced_by_key(spark: SparkSession, d: str) -> DataFrame:
    """M4: an aggregate of one's own over the rows of each key."""
    f = lambda pdf: {"n": len(pdf), "spread": pdf["value"].max() - pdf["value"].min()}
    return tasks.reduce(table(spark, d, "events").select("event_type", "value"), ["event_type"], f, "n long, spread double")


_SHARES = "[abs(CAST(x AS DOUBLE)) for x in embedding]"


@query(f"SELECT vec_id, [CAST(floor(least(greatest(x * CASE WHEN top <= 1 THEN 255.0 ELSE 1.0 END, 0.0), 255.0)) AS INT) for x in p] AS bytes FROM (SELECT vec_id, p, list_max(p) AS top FROM (SELECT vec_id, [a[i] for i in range(1, 65) if (i - 1) % 4 < 3] AS p FROM (SELECT vec_id, {_SHARES} AS a FROM embeddings)))")
def image_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Rendered images with an alpha channel as bytes without it."""
    return table(spark, d, "embeddings").select("vec_id", images.to_bytes(F.transform("embedding", lambda x: F.abs(x.cast("double"))), 4).alias("bytes"))
