"""Consolidating very many small files: size-tiered, level by level, with an idempotent journal.

``plan`` works on the file table alone. Files fall into tiers by size (each tier ``fan_in`` times the last); the files
of a tier are merged, in the order of their id's hash, into files of the next tier, level by level, until the target
size. Files are dealt to buckets of bounded bytes and numbers by their hash, once; all levels of a bucket are prefix
sums and merges inside one task, so that planning shuffles the file table once. A merge's id is a digest of what it
reads, so planning again over the same files gives the same merges. ``journal`` lists them.

``compact`` moves records by a plan: each key comes out once, in the output of its first input file, with what the
merges saw of it. ``Compactor`` writes the outputs, with the files' content, and the journal; a run that is repeated,
or that died between data and journal, neither loses nor doubles a record.

Defined cases: files of null or negative size count as empty; any number of empty files is merged, at most
``MOST_INPUTS`` at once; a file at or above the target stays as it is; a lone file of a tier is carried to the next;
repeated (key, file) rows count once; records without a key are left out of ``compact`` and kept by ``Compactor``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.session import cut

#: Inputs that one merge may read, and files whose merges one task plans.
MOST_INPUTS, FILES_PER_BUCKET = 1024, 50_000
STEP = "array<struct<level: int, merge_id: string, input_id: string, output_id: string, n_bytes: bigint>>"


def levels(smallest: int, target: int, fan_in: int) -> int:
    return max(1, math.ceil(math.log(target / smallest, fan_in)))


def plan(files: DataFrame, smallest: int = 1 << 10, target: int = 128 << 20, fan_in: int = 16, bucket_bytes: int | None = None) -> DataFrame:
    """file_id, output_id, n_bytes (of the output) and steps for ``files`` (file_id string, n_bytes long).

    ``steps`` holds the journal's rows of the merges that read a file, as it is or as the first of an earlier output.
    ``bucket_bytes``: the bytes of a bucket, by default 64 targets; each bucket leaves at most one file below its
    tier's size.
    """
    bucket_bytes = bucket_bytes or 64 * target
    size_of = F.greatest(F.coalesce("n_bytes", F.lit(0)), F.lit(0)).cast("long")
    start = cut(files.select(F.col("file_id").cast("string").alias("file_id"), size_of.alias("n_bytes")).where("file_id is not null").groupBy("file_id").agg(F.max("n_bytes").alias("n_bytes")))
    n, total = start.agg(F.count("*"), F.sum("n_bytes")).first()
    buckets = max(1, n // FILES_PER_BUCKET, (total or 0) // bucket_bytes)
    at = start.withColumns({"bucket": F.pmod(F.conv(F.substring(F.md5("file_id"), 1, 8), 16, 10).cast("long"), F.lit(buckets)), "now": F.col("file_id"), "first": F.lit(True), "steps": F.array().cast(STEP)})
    for level in range(levels(smallest, target, fan_in)):
        size = min(target, smallest * fan_in ** (level + 1))
        at = at.withColumns({"small": F.col("n_bytes") < size, "weight": F.greatest(F.col("n_bytes"), F.lit(max(1, size // MOST_INPUTS))), "h": F.md5("now")})
        # the rows of one file are peers: its weight counts once, at its first row
        upto = F.sum(F.when(F.col("small") & F.col("first"), F.col("weight")).otherwise(0)).over(Window.partitionBy("bucket").orderBy("h", "now").rangeBetween(Window.unboundedPreceding, Window.currentRow))
        at = at.withColumn("batch", F.when(F.col("small"), F.floor((upto - F.col("weight")) / size).cast("string")).otherwise(F.concat(F.lit("as is "), "now")))
        of = Window.partitionBy("bucket", "batch")
        own = lambda x: F.sum(F.when(F.col("first"), x)).over(of)
        # a digest of the set of inputs that needs no list of them in one place
        at = at.withColumns({"n": own(F.lit(1)), "sum": own(F.col("n_bytes")), "digest": own(F.xxhash64("now").cast("decimal(20,0)")), "least": F.min("file_id").over(of)})
        at = at.withColumn("merge_id", F.when(F.col("small") & (F.col("n") > 1), F.md5(F.concat_ws(":", F.lit(level), F.col("digest").cast("string"), "least"))))
        output, merged = F.concat(F.lit(f"L{level + 1}-"), F.substring("merge_id", 1, 24)), F.col("merge_id").isNotNull()
        step = F.struct(F.lit(level).alias("level"), "merge_id", F.col("now").alias("input_id"), output.alias("output_id"), F.col("sum").alias("n_bytes"))
        at = at.select(
            "file_id", "bucket", F.when(merged & F.col("first"), F.concat("steps", F.array(step))).otherwise(F.col("steps")).alias("steps"), F.when(merged, output).otherwise(F.col("now")).alias("now"),
            F.when(merged, F.col("sum")).otherwise(F.col("n_bytes")).alias("n_bytes"), F.when(merged, F.col("file_id") == F.col("least")).otherwise(F.col("first")).alias("first"),
        )
    return cut(at.select("file_id", F.col("now").alias("output_id"), "n_bytes", "steps"))


def journal(planned: DataFrame) -> DataFrame:
    """level, merge_id, input_id, output_id, n_bytes: one row per input of a merge."""
    return planned.select(F.explode("steps").alias("s")).select("s.*")


def compact(inputs: DataFrame, planned: DataFrame) -> DataFrame:
    """Each key of ``inputs`` (key, file_id, packed: whether the file is a packed shard) once, read off the merges.

    key, output_id, n_files, n_shards, landed. Each (key, file) goes once to the output of its file; a key whose files
    are all unknown to the plan is not moved. What the merges saw of a key is counted over its outputs, beginning with
    the distinct (key, file) pairs, so a key that is repeated very often is reduced before it is shuffled by key alone.
    """
    seen = inputs.where("key is not null and file_id is not null").groupBy("key", "file_id").agg(F.max("packed").alias("packed"))
    moved = seen.join(planned.select("file_id", "output_id"), "file_id")
    return moved.groupBy("key").agg(F.min_by("output_id", "file_id").alias("output_id"), F.count("*").alias("n_files"), F.count_if("packed").alias("n_shards"), F.max(~F.col("packed")).alias("landed"))


class Compactor:
    """Compaction of stored files with a journal in ``root``: data in root/data/run=..., journal in root/journal/run=....

    ``run(files, records)``: ``records`` has file_id, key and any columns of content. Rows with a key come out once by
    key, in the output of the first file that has it; rows without a key (a file's body) are all kept, exact repeats
    once. Only files that the journal doesn't know are taken, so a run after new files have come merges these alone
    with what earlier runs left below the target. A file that no merge reads is stored under its own id (level -1 of
    the journal), so the store holds every file's rows. Each output is one physical file. Rows of files that ``files``
    doesn't name are not taken. One writer at a time: what a run that died has left is removed by the next.
    """

    def __init__(self, spark: SparkSession, root: str, smallest: int = 1 << 10, target: int = 128 << 20, fan_in: int = 16):
        self.spark, self.root = spark, root.rstrip("/")
        self.args = {"smallest": smallest, "target": target, "fan_in": fan_in}

    def _folder(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, name: str) -> bool:
        fs, path = self._folder(name)
        return fs.exists(path)

    def _runs(self, name: str, complete: bool) -> set[str]:
        """The runs in a folder; ``complete``: those whose files are all written."""
        fs, path = self._folder(name)
        found = fs.listStatus(path) if fs.exists(path) else []
        return {f.getPath().getName() for f in found if f.getPath().getName().startswith("run=") and (not complete or self._exists(f"{name}/{f.getPath().getName()}/_SUCCESS"))}

    def clear(self) -> None:
        """Removes the data and journals of runs that died before their journal was written."""
        known = self._runs("journal", True)
        for name in ("data", "journal"):
            for run in self._runs(name, False) - known:
                fs, path = self._folder(f"{name}/{run}")
                fs.delete(path, True)

    def journal(self) -> DataFrame | None:
        runs = sorted(self._runs("journal", True))
        return self.spark.read.option("basePath", f"{self.root}/journal").parquet(*[f"{self.root}/journal/{r}" for r in runs]) if runs else None

    def data(self) -> DataFrame:
        """The records as they stand: those of journalled runs, in outputs that no later merge has read."""
        d, j = self.spark.read.parquet(f"{self.root}/data"), self.journal()
        dead = j.where("level >= 0").select(F.col("input_id").alias("output_id")).distinct()
        return d.join(F.broadcast(j.select("run").distinct()), "run", "left_semi").join(dead, "output_id", "left_anti").drop("run", "file")

    def run(self, files: DataFrame, records: DataFrame) -> int:
        """Merges what is new until nothing more can be merged; returns how many merges were made.

        All rounds are planned on the file table first (each leaves fewer files, so they end), then the records are
        written once; a run over files that are known already writes nothing.
        """
        self.clear()
        done, old = self.journal(), None
        fresh = files.select(F.col("file_id").cast("string").alias("file_id"), F.greatest(F.coalesce("n_bytes", F.lit(0)), F.lit(0)).cast("long").alias("n_bytes"))
        fresh = fresh.where("file_id is not null").groupBy("file_id").agg(F.max("n_bytes").alias("n_bytes")).withColumn("fresh", F.lit(True))
        if done is not None:
            read = done.where("level >= 0").select(F.col("input_id").alias("file_id")).distinct()
            left = done.groupBy(F.col("output_id").alias("file_id")).agg(F.max("n_bytes").alias("n_bytes")).join(read, "file_id", "left_anti")
            known = done.select(F.col("input_id").alias("file_id")).distinct()
            fresh = fresh.join(known, "file_id", "left_anti").unionByName(left.withColumn("fresh", F.lit(False)))
            old = self.data()
        start = cut(fresh)
        live, at, steps = start.select("file_id", "n_bytes"), start.withColumn("output_id", F.col("file_id")), []
        made = 0
        while True:
            planned = plan(live, **self.args)
            j = journal(planned)
            n = j.agg(F.count_distinct("merge_id")).first()[0]
            if not n:
                break
            made += n
            steps.append(j)
            at = cut(at.join(planned.select(F.col("file_id").alias("output_id"), F.col("output_id").alias("next")), "output_id", "left").select("file_id", "n_bytes", "fresh", F.coalesce("next", "output_id").alias("output_id")))
            live = planned.groupBy(F.col("output_id").alias("file_id")).agg(F.max("n_bytes").alias("n_bytes"))
        entered = at.where("fresh and output_id = file_id").select(F.lit(-1).alias("level"), F.lit(None).cast("string").alias("merge_id"), F.col("file_id").alias("input_id"), "output_id", "n_bytes")
        for j in steps:
            entered = entered.unionByName(j)
        head = entered.agg(F.count("*").alias("n"), F.sum(F.xxhash64("merge_id", "input_id").cast("decimal(20,0)")).alias("d")).first()
        if not head["n"]:
            return 0
        run = f"{head['n']}_{abs(int(head['d']))}"  # the same inputs give the same run, which then replaces itself
        taken = at.where("fresh").select("file_id", "output_id")
        rest = [c for c in records.columns if c != "key"]
        keyed = records.where("key is not null").join(taken, "file_id").groupBy("key").agg(F.min_by(F.struct(*rest, "output_id"), "file_id").alias("r")).select("key", "r.*")
        if old is not None:
            keyed = keyed.join(old.select("key").where("key is not null").distinct(), "key", "left_anti")
        out = keyed.unionByName(records.where("key is null").dropDuplicates().join(taken, "file_id").select(*keyed.columns))
        if old is not None:
            moved = at.where("not fresh and output_id <> file_id").select(F.col("file_id").alias("output_id"), F.col("output_id").alias("next"))
            out = out.unionByName(old.join(moved, "output_id").drop("output_id").withColumnRenamed("next", "output_id").select(*out.columns))
        # the folder's name is a copy, as reading it back may change its type
        out.withColumn("file", F.col("output_id")).repartition("output_id").write.mode("overwrite").partitionBy("file").parquet(f"{self.root}/data/run={run}")
        entered.write.mode("overwrite").parquet(f"{self.root}/journal/run={run}")
        return made
