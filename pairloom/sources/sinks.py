"""Sinks: paired records, tar shards, splits, ledgers, progress, pages and the dataset card."""

from __future__ import annotations

import errno
import hashlib
import io
import os
import re
import shutil
import tarfile
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import html_escape
from pairloom.operators.rank import ordinal


def paired(before: Column | str, after: Column | str) -> Column:
    """array<struct<before, after>> of two lists, as long as the shorter one."""
    b, a = (F.col(x) if isinstance(x, str) else x for x in (before, after))
    n = F.least(F.size(b), F.size(a))
    return F.transform(F.arrays_zip(F.slice(b, 1, n).alias("before"), F.slice(a, 1, n).alias("after")), lambda p: F.struct(p["before"].alias("before"), p["after"].alias("after")))


def write_pairs(df: DataFrame, path: str, op: str = "op") -> None:
    """Records as JSON lines in a folder per operation."""
    df.write.mode("overwrite").partitionBy(op).json(path)


def shard_names(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` with ``shard``: edit-000000.tar, ... of so many records in the order of their unique keys."""
    return ordinal(df, [key], "__pl_place").withColumn("shard", F.format_string("edit-%06d.tar", F.floor(F.col("__pl_place") / size))).drop("__pl_place")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all tasks can write, and the folder's path in it: local, hdfs://, s3a:// and what else Arrow knows."""
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def put(uri: str, name: str, content: bytes, made: set[str] | None = None) -> None:
    """One whole file: written under a name of its own and then renamed, so that a task that runs twice leaves one. ``made``: folders below it that are there."""
    system, root = filesystem(uri)
    path = f"{root}/{name}"
    folder, _, last = path.rpartition("/")
    if made is None or name.rpartition("/")[0] not in made:
        system.create_dir(folder, recursive=True)
    partial = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with system.open_output_stream(partial) as f:
        f.write(content)
    system.move(partial, path)


def write_files(df: DataFrame, name: str, content: str, root: str) -> int:
    """A file of each row's content (text or bytes; null is empty) by its name below ``root``; returns how many were written.

    On a local file system files of a batch that have equal content are links to one file, as making a file costs far
    more than a link. Nothing here writes into a file that is there, so no file changes with another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = filesystem(root)
        for b in batches:
            made: set[str] = set()
            contents = [x.encode("utf-8", "surrogatepass") if isinstance(x, str) else x or b"" for x in b.column(1).to_pylist()]
            times = Counter(contents) if isinstance(system, fs.LocalFileSystem) else {}
            first: dict[bytes, str] = {}  # a name of each repeated content that only this task knows
            for n, x in zip(b.column(0).to_pylist(), contents):
                folder = n.rpartition("/")[0]
                if folder not in made:
                    system.create_dir(f"{at}/{folder}", recursive=True)
                    made.add(folder)
                if times.get(x, 1) > 1:
                    if x not in first:
                        put(root, hidden := f".{uuid.uuid4().hex}", x)
                        first[x] = f"{at}/{hidden}"
                    try:
                        os.link(first[x], f"{at}/{n}")
                        continue
                    except OSError:  # it is there already, or has no room for links
                        pass
                put(root, n, x, made)
            for path in first.values():
                os.unlink(path)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    return df.where(F.col(name).isNotNull()).select(name, content).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def refill_folders(df: DataFrame, folder: str, file: str, content: str, root: str, old: str | None = None, own: str = "sample.json") -> list[str]:
    """Folders of files (content is bytes, null is empty) on a local file system; returns the folders below ``root`` that hold them, one for each task.

    The rows of a folder stand side by side in one partition. Folders that an earlier call left below ``old`` are renamed
    and refilled and are there no more: a file system takes several times as long to make and remove a folder, and longer
    still where many files were removed a moment ago. Of each folder the file ``own`` is its own and is overwritten, all
    others are links to one file per content. A task works in a folder of its own, which it shows when it is whole.
    """
    parts, before = filesystem(root)[1], filesystem(old)[1] if old else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        at = f"{parts}/.{uuid.uuid4().hex}"
        os.makedirs(parts, exist_ok=True)
        try:
            os.rename(f"{before}/{place}", at) if before else os.mkdir(at)  # no other task gets it
        except FileNotFoundError:
            os.mkdir(at)
        linked: dict[bytes, tuple[str, int]] = {}  # the file with this content, and its inode
        spare: dict[str, dict[str, int]] = {}  # folders not used yet: inodes of their files, 0 for a folder
        alike: dict[frozenset, list[str]] = {}  # those of the same files, but for their own
        for d in os.scandir(at):
            if d.is_dir(follow_symlinks=False):
                spare[d.name] = {e.name: 0 if e.is_dir(follow_symlinks=False) else e.inode() for e in os.scandir(d.path)}
                alike.setdefault(frozenset(x for x in spare[d.name].items() if x[0] != own), []).append(d.name)

        def source(x: bytes) -> tuple[str, int]:
            if x not in linked:
                path = f"{at}/.{hashlib.sha256(x).hexdigest()}"
                if not os.path.exists(path):
                    with open(path, "wb") as f:
                        f.write(x)
                linked[x] = path, os.stat(path).st_ino
            return linked[x]

        def taken(name: str, wanted: frozenset) -> dict[str, int]:
            """The folder ``name``, made of one that has the same files if there is one, with what is in it."""
            if name in spare:
                return spare.pop(name)
            while names := alike.get(wanted):
                if (found := names.pop()) in spare:
                    break
            else:
                if not spare:
                    os.mkdir(f"{at}/{name}")
                    return {}
                found = next(iter(spare))
            os.rename(f"{at}/{found}", f"{at}/{name}")
            return spare.pop(found)

        def fill(name: str, files: dict[str, bytes]) -> None:
            wanted = {n: source(x) for n, x in files.items() if n != own}
            had = taken(name, frozenset((n, inode) for n, (_, inode) in wanted.items()))
            for n, inode in had.items():
                if n not in files or n != own and inode != wanted[n][1]:
                    shutil.rmtree(f"{at}/{name}/{n}") if not inode else os.unlink(f"{at}/{name}/{n}")
            for n, (path, inode) in wanted.items():
                if had.get(n) != inode:
                    if "/" in n:
                        os.makedirs(f"{at}/{name}/{n.rpartition('/')[0]}", exist_ok=True)
                    try:
                        os.link(path, f"{at}/{name}/{n}")
                    except FileExistsError:
                        raise
                    except OSError:  # no room for links
                        shutil.copyfile(path, f"{at}/{name}/{n}")
            if own in files:
                f = os.open(f"{at}/{name}/{own}", os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    os.truncate(f, os.write(f, files[own]))  # in this order the file keeps its blocks
                finally:
                    os.close(f)

        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for name, some in groupby(rows, lambda r: r[0]):
            fill(name, {f: x or b"" for _, f, x in some})
        for name in spare:
            shutil.rmtree(f"{at}/{name}")
        try:
            os.rename(at, f"{parts}/{place}")
        except OSError as e:
            if e.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                raise
            shutil.rmtree(at)  # the task ran before, to its end
        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64())], names=["place"])

    return [f"{root}/{r[0]}" for r in df.select(folder, file, content).mapInArrow(run, "place long").collect()] or [root]


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Removes folders on a local file system, each by a task."""
    paths = [filesystem(f)[1] for f in folders]
    spark.sparkContext.parallelize(paths, len(paths)).foreach(lambda p: shutil.rmtree(p, ignore_errors=True))


def pack(df: DataFrame, key: str, body: str, path: str, size: int = 1000) -> DataFrame:
    """Tar shards of ``size`` records in ``path`` (a folder all tasks can write); returns key -> shard. A shard is one task's work of bounded size."""
    named = shard_names(df.select(key, body), key, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: str | None = None
        tar = out = None

        def close() -> None:
            if tar is not None:
                tar.close()
                put(path, open_, out.getvalue())

        for b in batches:
            for k, text, shard in zip(*(b.column(i).to_pylist() for i in range(3))):
                if shard != open_:
                    close()
                    open_, out = shard, io.BytesIO()
                    tar = tarfile.open(fileobj=out, mode="w")
                data = (text or "").encode()
                info = tarfile.TarInfo(f"{k}.json")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], names=["key", "shard"])
        close()

    ready = named.select(F.col(key).cast("string").alias("key"), F.col(body).alias("body"), "shard").repartition("shard").sortWithinPartitions("shard", "key")
    return ready.mapInArrow(run, "key string, shard string")


def save_splits(df: DataFrame, path: str, split: str = "split", files_per_split: int | None = None) -> None:
    """Parquet in a folder per split; with ``files_per_split`` each split's rows are spread over so many files."""
    if files_per_split:
        df = df.repartition(files_per_split, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_split)))
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def append_progress(df: DataFrame, path: str) -> None:
    """Progress records appended as JSON lines."""
    df.write.mode("append").json(path)


def save_ledger(uids: DataFrame, path: str, key: str = "uid") -> None:
    """The distinct keys, sorted, as JSON lines."""
    uids.select(key).where(F.col(key).isNotNull()).distinct().sort(key).write.mode("overwrite").json(path)


def table_rows(columns: Sequence[str], images: Sequence[str] = ()) -> Column:
    """A row of an HTML table; the cells are escaped by the engine, those of ``images`` are paths shown as images."""
    text = {c: html_escape(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns}
    cell = {c: F.concat(F.lit('<img src="'), F.replace(x, F.lit('"'), F.lit("&quot;")), F.lit('">')) if c in images else x for c, x in text.items()}
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), cell[c], F.lit("</td>")) for c in columns], F.lit("</tr>"))


def _page(title: str, columns: Sequence[str], body: Column) -> Column:
    head = "".join(f"<th>{c}</th>" for c in columns)
    return F.concat(F.lit(f"<!doctype html><meta charset='utf-8'><title>{title}</title><h1>{title}</h1><table><tr>{head}</tr>\n"), body, F.lit("\n</table>\n"))


def write_pages(rows: DataFrame, order: Sequence[str], columns: Sequence[str], title: str, root: str, images: Sequence[str] = (), per_page: int = 500) -> int:
    """All rows of a report in their order as HTML pages page-000000.html, ... of so many rows each; returns how many pages."""
    placed = ordinal(rows, order, "__pl_place").select(F.floor(F.col("__pl_place") / per_page).alias("page"), "__pl_place", table_rows(columns, images).alias("row"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__pl_place", "row"))), lambda x: x["row"]), "\n")
    pages = placed.groupBy("page").agg(_page(title, columns, body).alias("html"))  # per_page rows each
    return write_files(pages.select(F.format_string("page-%06d.html", "page").alias("name"), "html"), "name", "html", root)


def card(title: str, totals: DataFrame, by_op: DataFrame, by_source: DataFrame, licenses: DataFrame) -> str:
    """A dataset card in Markdown from four small tables of statistics."""
    t = totals.first()
    terms = {what: sorted(r["value"] for r in licenses.where(F.col("what") == what).collect()) for what in ("license", "version")}
    ops = by_op.orderBy(F.desc("n"), "edit_op").collect()
    sources = ", ".join(f"{r['source'] or '?'} ({r['n']})" for r in by_source.orderBy(F.desc("n"), "source").collect())
    lines = ["---", "license: other", "task_categories:", "- image-to-image", "tags:", "- image-editing", "- instruction-guided", "- synthetic", "size_categories:", f"- {t['size_bucket']}", "---", f"# {title}", ""]
    lines += [f"{t['total']} pairs over {t['n_scenes']} scenes; sources: {sources}.", f"Pipeline versions: {', '.join(terms['version']) or 'n/a'}", ""]
    lines += ["## Files", "", "Shards `edit-{shard:06d}.tar`; of each pair `<key>.before.png`, `<key>.after.png` and `<key>.json` (instruction, edit, cameras, subject, provenance).", ""]
    lines += ["## Operations", "", "| operation | pairs |", "|-|-|", *(f"| {r['edit_op'] or '?'} | {r['n']} |" for r in ops), ""]
    lines += ["## Licences", "", *(f"- {x}" for x in terms["license"] or ["see the provenance of each pair"])]
    return "\n".join(lines) + "\n"
