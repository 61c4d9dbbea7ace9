"""Sources: job folders, lists, maps, tables of semantics, scene instances, tar shards, databases, splits and logs."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.records import object_variant
from pairloom.session import cut
from pairloom.sources.sinks import filesystem


#: The first bytes of a PNG file.
PNG = bytes([0x89, 0x50, 0x4E, 0x47, 0x0D, 0x0A, 0x1A, 0x0A])
#: Folders whose contents a task gives on at once.
FOLDERS_AT_ONCE = 500


def job_folders(spark: SparkSession, raw: str | Sequence[str], heads: bool = False) -> DataFrame:
    """job_dir, record (the text of ``raw/*/sample.json``), images (names of PNG files beside it), before, after (the first by name), whole.

    ``raw``: a folder of job folders, or several on one file system.

    One task lists the names of the folders, all tasks then open them, so the driver holds nothing of the listing and a
    folder is opened once. Files whose names begin with . or _ are no images. ``heads``: whole tells whether the two
    first images begin as PNG files do; else it is null. A folder that is not there is empty.
    """
    raws = [filesystem(r) for r in ([raw] if isinstance(raw, str) else raw)]
    system, roots = raws[0][0], [root for _, root in raws]

    def names(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for root in roots:
            found = [f.base_name for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.type == fs.FileType.Directory]
            for k in range(0, len(found), 10_000):
                some = found[k : k + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([root] * len(some), pa.string()), pa.array(some, pa.string())], names=["root", "job_dir"])

    def read(path: str, n: int | None = None) -> bytes:
        with system.open_input_file(path) as f:
            return f.read(n)

    def row(root: str, job_dir: str) -> tuple | None:
        there = [f.base_name for f in system.get_file_info(fs.FileSelector(f"{root}/{job_dir}")) if f.type == fs.FileType.File]
        if "sample.json" not in there:
            return None
        shown = not job_dir.startswith((".", "_"))
        images = sorted(n for n in there if shown and n.endswith(".png") and not n.startswith((".", "_")))
        firsts = [next((n for n in images if n.startswith(s)), None) for s in ("before_", "after_")]
        whole = all(n is not None and read(f"{root}/{job_dir}/{n}", len(PNG)) == PNG for n in firsts) if heads else None
        return job_dir, read(f"{root}/{job_dir}/sample.json"), images, *firsts, whole

    kinds = (pa.string(), pa.binary(), pa.list_(pa.string()), pa.string(), pa.string(), pa.bool_())
    columns = ("job_dir", "record", "images", "before", "after", "whole")

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, dirs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for k in range(0, len(dirs), FOLDERS_AT_ONCE):
                rows = [r for r in map(row, at[k : k + FOLDERS_AT_ONCE], dirs[k : k + FOLDERS_AT_ONCE]) if r is not None]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=list(columns))

    listed = spark.range(1, numPartitions=1).mapInArrow(names, "root string, job_dir string").repartition(4 * spark.sparkContext.defaultParallelism)
    opened = listed.mapInArrow(contents, "job_dir string, record binary, images array<string>, before string, after string, whole boolean")
    return opened.withColumn("record", F.col("record").cast("string"))


def sample_views(spark: SparkSession, raw: str | Sequence[str], complete: bool = True) -> DataFrame:
    """job_dir, key, view, before, after, record (JSON) of each view below ``raw/*/sample.json``.

    Unreadable records are skipped. ``complete``: only views whose two images are in the folder (names only, the images
    are not read). A record without an operation has a key without one.
    """
    v = job_folders(spark, raw).select("job_dir", "record", "images", object_variant("record", wrapped=False).alias("v")).where("v is not null")
    get = lambda at, p, k="string": F.try_variant_get(at, p, k)
    e = v.select("job_dir", "record", "images", "v", F.explode(get("v", "$.views", "array<variant>")).alias("w"))
    op = F.nullif(F.replace(get("v", "$.edit.op"), F.lit("object_"), F.lit("")), F.lit(""))
    key = F.concat(get("v", "$.job_id"), F.coalesce(F.concat(F.lit("_"), op), F.lit("")), F.lit("_v"), get("w", "$.view"))
    out = e.select("job_dir", key.alias("key"), get("w", "$.view", "int").alias("view"), get("w", "$.before").alias("before"), get("w", "$.after").alias("after"), "record", "images")
    if complete:
        out = out.where(F.array_contains("images", F.col("before")) & F.array_contains("images", F.col("after")))
    return out.drop("images")


def first_views(views: DataFrame) -> DataFrame:
    """One view per job folder, the first by its image's name."""
    return views.groupBy("job_dir").agg(F.min_by(F.struct("key", "view", "before", "after", "record"), "before").alias("r")).select("job_dir", "r.*")


def first_images(spark: SparkSession, raw: str | Sequence[str]) -> DataFrame:
    """job_dir, record, before, after: job folders with a readable record, by their first images by name, where both are PNG files."""
    return job_folders(spark, raw, heads=True).where("whole").where(object_variant("record", wrapped=False).isNotNull()).select("job_dir", "record", "before", "after")


def first_existing(df: DataFrame, candidates: Column, listing: DataFrame, path: str, name: str) -> DataFrame:
    """``df`` with ``name``: the first of its candidate paths (an array) that the listing has, else null."""
    numbered = df.withColumn("__pl_id", F.monotonically_increasing_id())
    numbered = cut(numbered)  # the numbers must stay as they are
    each = numbered.select("__pl_id", F.posexplode(candidates).alias("__pl_rank", "__pl_path"))
    there = each.join(listing.select(F.col(path).alias("__pl_path")).distinct(), "__pl_path").groupBy("__pl_id").agg(F.min_by("__pl_path", "__pl_rank").alias(name))
    return numbered.join(there, "__pl_id", "left").drop("__pl_id")


def uid_list(spark: SparkSession, path: str) -> DataFrame:
    """uid: the lines of a text file, trimmed, blank ones skipped; a missing file is an empty list."""
    try:
        lines = spark.read.text(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "uid string")
    return lines.select(F.trim("value").alias("uid")).where("uid <> ''")


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """key, value (variant) of a file that holds one JSON object; a missing or unreadable file is an empty map."""
    try:
        text = spark.read.option("wholetext", True).text(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        text = spark.createDataFrame([], "value string")
    text.select(object_variant("value").alias("v")).where("v is not null").createOrReplaceTempView("__pl_json_map")
    return spark.sql("select key, value from __pl_json_map, lateral variant_explode(v)")


def category_map(spark: SparkSession, path: str) -> DataFrame:
    """uid, category of a JSON map of strings."""
    return json_map(spark, path).select(F.col("key").alias("uid"), F.try_variant_get("value", "$", "string").alias("category"))


def meta_map(spark: SparkSession, path: str) -> DataFrame:
    """uid, category, name, tags, license of the entries of a JSON map that are objects."""
    m = json_map(spark, path).where(F.schema_of_variant("value").startswith("OBJECT"))
    get = lambda k, t="string": F.try_variant_get("value", f"$.{k}", t).alias(k)
    return m.select(F.col("key").alias("uid"), get("category"), get("name"), get("tags", "array<string>"), get("license"))


def semantics(spark: SparkSession, path: str) -> DataFrame:
    """key, category of a CSV file: its first column, and main_category, else the wnsynsetkey without its ending, else ``object``.

    Of a key that comes twice the last line counts (lines are numbered by file position).
    """
    t = spark.read.option("header", True).csv(path)
    blank = F.lit("")
    col = lambda c: F.nullif(F.trim(F.col(c)), blank) if c in t.columns else F.lit(None).cast("string")
    category = F.coalesce(col("main_category"), F.nullif(F.regexp_replace(col("wnsynsetkey"), r"\.n\.\d+$", ""), blank), F.lit("object"))
    rows = t.select(F.col(t.columns[0]).alias("key"), category.alias("category"), F.monotonically_increasing_id().alias("line"))
    return rows.where("key is not null").groupBy("key").agg(F.max_by("category", "line").alias("category"))


def scene_instances(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, template, translation, rotation (w, x, y, z), scale of the object instances of scene files; one number as scale counts for all axes."""
    v = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("v"))
    e = v.select("file", F.posexplode(F.try_variant_get("v", "$.object_instances", "array<variant>")).alias("pos", "o"))
    get = lambda p, k: F.try_variant_get("o", p, k)
    vec = lambda p, none: F.coalesce(get(p, "array<double>"), F.array(*map(F.lit, none)))
    one = get("$.non_uniform_scale", "double")
    scale = F.coalesce(get("$.non_uniform_scale", "array<double>"), F.when(one.isNotNull(), F.array(one, one, one)), F.array(*[F.lit(1.0)] * 3))
    return e.select("file", "pos", get("$.template_name", "string").alias("template"), vec("$.translation", (0.0, 0.0, 0.0)).alias("translation"), vec("$.rotation", (1.0, 0.0, 0.0, 0.0)).alias("rotation"), scale.alias("scale"))


def tar_members(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """shard, name, body of the members of tar files that end in ``suffix``; a broken file yields what stands before the break.

    One task reads one tar file at a time, member by member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows: list[tuple[str, str]] = []
                try:
                    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                        for m in tar:
                            if m.isfile() and m.name.endswith(suffix) and (f := tar.extractfile(m)):
                                rows.append((m.name, f.read().decode("utf-8", "replace")))
                except (tarfile.TarError, EOFError):
                    pass
                yield pa.RecordBatch.from_arrays([pa.array([p.rpartition("/")[2]] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["shard", "name", "body"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(path).select("path", "content")
    return files.mapInArrow(run, "shard string, name string, body string")


def splits(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files or folders by split, with ``split`` from their name."""
    read = spark.read.option("recursiveFileLookup", True).parquet(path)
    return read.withColumn("split", F.regexp_extract(F.input_file_name(), r"/(?:split=)?([^/=]+?)(?:\.parquet)?(?:/[^/]+)?$", 1)) if "split" not in read.columns else read


def database(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A table over JDBC, read in parallel by ranges of ``key`` if its bounds are given; filters and columns are pushed down."""
    read = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if key and bounds:
        read = read.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return read.load()


#: The prefix of log lines that carry a finished pair.
PAIR = "##PAIR## "


def pair_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The JSON after the prefix of log lines, batch or stream; other and malformed lines are skipped."""
    rest = F.substr(F.col(column), F.lit(len(PAIR) + 1))
    return lines.where(F.startswith(column, F.lit(PAIR))).select(F.try_parse_json(rest).alias("v")).where("v is not null").select(F.to_json("v").alias("record"))


def pair_stream(spark: SparkSession, path: str) -> DataFrame:
    return pair_lines(spark.readStream.text(path))


def config(path: str) -> dict:
    """A YAML or JSON configuration, on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text) or {}


