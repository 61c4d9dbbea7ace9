"""Schemas that drift between versions of nested records: profile, compare, log the changes, cast to one table.

1. ``profile``: each task reads its records and counts, per version, how many hold each path with each kind (partial
   counts, so what is shuffled has the size of the schema, not of the data).
2. ``changes``: the profiles, folded through the promotion lattice, are compared version by version. The profile is as
   small as the schema, so this fold runs on the driver.
3. ``rename_votes``: for paths gone and come, the values held by the same key before and after are compared.
4. ``consolidate``: every readable record cast to the union schema under its newest names.

Defined cases: null versions don't count; unreadable records are left out; null, ``[]`` and ``{}`` are absent; of two
rows with one key and version the one with the greater id speaks for the key; an empty table has no changes; columns
that the input has besides the named ones are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.records import KINDS, leaf_kinds, leaves, read_record, write
from pairloom.session import cut

#: A version has a path if one in so many of its readable records holds it.
PRESENT_ONE_IN = 50
#: A path gone and a path come are one renamed path if this share of the keys that hold both has equal values.
RENAME_AGREEMENT = 0.8
#: A number as JSON writes it.
NUMBER = re.compile(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?")


def promote(kinds: Iterable[str]) -> str:
    """The least kind of the lattice ``KINDS`` that can hold all ``kinds``."""
    return max(kinds, key=KINDS.index)


def rounded(value) -> bool:
    """Whether a double can't hold the whole number ``value``."""
    if type(value) is not int or -(1 << 53) <= value <= 1 << 53:
        return False
    try:
        return int(float(value)) != value
    except OverflowError:
        return True


def _text(value) -> str:
    """A value as comparable text: numbers by their value, strings as they are, arrays element by element."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        try:
            return repr(float(value))
        except OverflowError:
            return str(value)
    if isinstance(value, str):
        return value
    try:
        return json.dumps([_text(x) if x is not None else None for x in value] if isinstance(value, list) else value, sort_keys=True)
    except RecursionError:
        return write(value)


#: Paths that a task counts before it passes the counts on.
HELD = 200_000


def profile(df: DataFrame, version: str, text: str) -> DataFrame:
    """version, path, n and a count per kind: how many readable records of a version hold a path, and with which kinds; path '' counts the records."""
    counted = ("n", *KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[tuple[str, str], list[int]] = {}
        names: dict = {}

        def flush() -> pa.RecordBatch:
            keys = list(by)
            out = [pa.array([k[i] for k in keys], pa.string()) for i in range(2)] + [pa.array([by[k][i] for k in keys], pa.int64()) for i in range(len(counted))]
            by.clear()
            names.clear()
            return pa.RecordBatch.from_arrays(out, names=["version", "path", *counted])

        place = {k: i for i, k in enumerate(counted)}
        for b in batches:
            for v, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                record = read_record(t)
                if record is None:
                    continue
                for path, kinds in [("", ()), *leaf_kinds(record, names).items()]:
                    n = by.get((v, path))
                    if n is None:
                        n = by[v, path] = [0] * len(counted)
                    n[0] += 1
                    if type(kinds) is str:
                        n[place[kinds]] += 1
                    else:  # several kinds at one path: each counts, the path once
                        for k in kinds:
                            n[place[k]] += 1
            if len(by) + len(names) > HELD:
                yield flush()
        yield flush()

    picked = df.select(F.col(version).alias("version"), F.col(text).alias("text")).where("version is not null")
    each = picked.mapInArrow(run, "version string, path string, " + ", ".join(f"{c} long" for c in counted))
    return each.groupBy("version", "path").agg(*[F.sum(c).alias(c) for c in counted])


def layout_paths(profiled: DataFrame) -> DataFrame:
    """The rows of a profile that a layout has: one in ``PRESENT_ONE_IN`` of its version's records holds the path."""
    profiled = cut(profiled)
    records = profiled.where("path = ''").select("version", F.col("n").alias("__pl_all"))
    return profiled.join(records, "version").where(F.col("n") * PRESENT_ONE_IN >= F.col("__pl_all")).drop("__pl_all")


@dataclass
class Layouts:
    """What each version holds: version -> path -> kind, for the paths that it has."""

    versions: list[str] = field(default_factory=list)
    kinds: dict[str, dict[str, str]] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: Iterable) -> Layouts:
        """Of the rows of ``layout_paths``; a path's kind is the most common, of several equally common the one that holds them all."""
        rows = list(rows)
        versions = sorted((r["version"] for r in rows if not r["path"]), key=lambda v: [int(x) for x in v.split(".")])
        out = cls(versions, {v: {} for v in versions})
        for r in rows:
            if r["path"]:
                most = max(r[k] for k in KINDS)
                out.kinds[r["version"]][r["path"]] = promote(k for k in KINDS if r[k] == most)
        return out

    def steps(self) -> list[tuple[str, str]]:
        return list(zip(self.versions, self.versions[1:]))

    def gone_and_come(self) -> dict[str, tuple[list[str], list[str]]]:
        """By the newer version of a step: the paths gone and come, where there are both."""
        out = {}
        for a, b in self.steps():
            gone, come = sorted(set(self.kinds[a]) - set(self.kinds[b])), sorted(set(self.kinds[b]) - set(self.kinds[a]))
            if gone and come:
                out[b] = (gone, come)
        return out


def rename_votes(df: DataFrame, id_: str, key: str, version: str, text: str, layouts: Layouts) -> DataFrame:
    """version, old_path, new_path, n_both, n_equal over the keys written before and after each step.

    Each record is read once more, for the values at the paths gone and come alone; of these only hashes of 48 bits
    travel, so what is shuffled is a fraction of the records. Per key and version only the newest row is compared, so a
    key with very many rows weighs no more than another and is reduced before the shuffle.
    """
    wanted = layouts.gone_and_come()
    order = {v: i for i, v in enumerate(layouts.versions)}
    schema = "version string, old_path string, new_path string, n_both long, n_equal long"
    if not wanted:
        return df.sparkSession.createDataFrame([], schema)
    paths = sorted({p for ps in wanted.values() for side in ps for p in side})
    number = {p: i for i, p in enumerate(paths)}
    # the versions before or at a step, whose records can be on one of its sides
    first, last = min(map(order.get, wanted)) - 1, max(map(order.get, wanted))
    rank = F.create_map(*[F.lit(x) for v, i in order.items() for x in (v, i)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picks = Picks(number)
        for b in batches:
            out = []
            for t in b.column(3).to_pylist():
                record = read_record(t)
                # 16 bits of the path's number, 48 of the values' hash
                out.append(None if record is None else [p << 48 | zlib.crc32(x) << 16 | zlib.adler32(x) & 0xFFFF for p, x in picks.of(record)])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.list_(pa.int64()))], names=["key", "v", "id", "at"])

    picked = df.select(F.col(key).alias("key"), rank[F.col(version)].alias("v"), F.col(id_).alias("id"), F.col(text).alias("text")).where(F.col("key").isNotNull() & F.col("v").between(first, last))
    kinds = picked.schema
    values = picked.mapInArrow(read, f"key {kinds['key'].dataType.simpleString()}, v int, id {kinds['id'].dataType.simpleString()}, at array<long>")
    # one aggregate by key with a place for every version
    newest = [F.max_by(F.struct(F.lit(i).alias("v"), "at"), F.when(F.col("v") == i, F.col("id"))).alias(f"w{i}") for i in range(first, last + 1)]
    per_key = values.groupBy("key").agg(*newest).select(F.array_compact(F.array(*[f"w{i}" for i in range(first, last + 1)])).alias("w")).where("size(w) > 1")
    pair = lambda i: F.struct(F.element_at("w", i).alias("a"), F.element_at("w", i + 1).alias("b"))
    pairs = per_key.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), pair)).alias("p")).select("p.a.v", F.col("p.a.at").alias("old"), F.col("p.b.v").alias("upto"), F.col("p.b.at").alias("new"))
    steps = [(names, order[v], {number[p]: p for p in gone}, {number[p]: p for p in come}) for v, (gone, come) in wanted.items() for names in [v]]

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        same: Counter = Counter()
        for b in batches:
            for v0, old, v1, new in zip(*(c.to_pylist() for c in b.columns)):
                old, new = ({x >> 48: x & (1 << 48) - 1 for x in side or ()} for side in (old, new))
                for name, at, gone, come in steps:
                    if v0 < at <= v1:
                        for p in gone.keys() & old.keys():
                            for q in come.keys() & new.keys():
                                n[name, gone[p], come[q]] += 1
                                same[name, gone[p], come[q]] += old[p] == new[q]
        keys = list(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array([c[k] for k in keys], pa.int64()) for c in (n, same)],
            names=["version", "old_path", "new_path", "n_both", "n_equal"],
        )

    return pairs.mapInArrow(vote, schema).groupBy("version", "old_path", "new_path").agg(F.sum("n_both").alias("n_both"), F.sum("n_equal").alias("n_equal"))


class Picks:
    """The values at some paths of records, as ``leaves`` gives them, without a look at what leads to none of them."""

    def __init__(self, number: dict[str, int]):
        self.number, self.memo = number, {}

    def _about(self, base: str, name: str) -> tuple[str, int | None, bool, bool] | None:
        path = f"{base}.{name}" if base else name
        at, below, items = self.number.get(path), any(p.startswith(path + ".") for p in self.number), any(p.startswith(path + "[].") for p in self.number)
        return (path, at, below, items) if at is not None or below or items else None

    def of(self, record: dict) -> list[tuple[int, bytes]]:
        """(the path's number, its values in order as bytes, each by its length)."""
        memo, out, todo = self.memo, {}, [(record, "")]
        if len(memo) > HELD:
            memo.clear()
        while todo:
            node, base = todo.pop()
            inside = []
            for name, x in node.items():
                try:
                    about = memo[base, name]
                except KeyError:
                    about = memo[base, name] = self._about(base, name)
                if about is None or x is None:
                    continue
                path, at, below, items = about
                if type(x) is dict:
                    if below:
                        inside.append((x, path))
                elif type(x) is list and any(type(y) is dict for y in x):
                    if items:
                        inside.extend([(y, path + "[]") for y in x if type(y) is dict])
                elif at is not None and x != []:
                    out.setdefault(at, []).append(_text(x))
            todo.extend(reversed(inside))
        return [(p, "".join(f"{len(x)}:{x}" for x in xs).encode("utf-8", "surrogatepass")) for p, xs in out.items()]


def renames(votes: Iterable) -> dict[tuple[str, str], str]:
    """(newer version, old path) -> new path, one to one, by the most agreement."""
    out: dict[tuple[str, str], str] = {}
    taken = set()
    good = [r for r in votes if r["n_equal"] >= RENAME_AGREEMENT * r["n_both"]]
    for r in sorted(good, key=lambda r: (-r["n_equal"] / r["n_both"], -r["n_both"], r["old_path"], r["new_path"])):
        if (r["version"], r["old_path"]) not in out and (r["version"], r["new_path"]) not in taken:
            out[r["version"], r["old_path"]] = r["new_path"]
            taken.add((r["version"], r["new_path"]))
    return out


def study(df: DataFrame, id_: str, key: str, version: str, text: str) -> tuple[Layouts, dict[tuple[str, str], str]]:
    layouts = Layouts.of(layout_paths(profile(df, version, text)).collect())  # as many rows as the layouts have paths: paths held by few records stay behind
    return layouts, renames(rename_votes(df, id_, key, version, text, layouts).collect())


def changes(spark: SparkSession, layouts: Layouts, renamed: dict[tuple[str, str], str]) -> DataFrame:
    """version, change, old_path, new_path: the ordered log of differences."""
    rows = []
    for a, b in layouts.steps():
        old, new = layouts.kinds[a], layouts.kinds[b]
        pairs = {p: q for (v, p), q in renamed.items() if v == b}
        rows += [(b, "renamed", p, q) for p, q in sorted(pairs.items())]
        rows += [(b, "removed", p, "") for p in sorted(set(old) - set(new) - set(pairs))]
        rows += [(b, "added", "", q) for q in sorted(set(new) - set(old) - set(pairs.values()))]
        rows += [(b, "retyped", p, p) for p in sorted(set(old) & set(new)) if old[p] != new[p]]
    return spark.createDataFrame(rows, "version string, change string, old_path string, new_path string")


def union_schema(layouts: Layouts, renamed: dict[tuple[str, str], str]) -> tuple[dict[str, str], dict[str, str]]:
    """path of any version -> newest name; newest name -> kind, promoted over all versions."""
    newest: dict[str, str] = {p: p for v in layouts.versions for p in layouts.kinds[v]}
    for v in layouts.versions:
        for (at, p), q in renamed.items():
            if at == v:
                for x in newest:
                    if newest[x] == p:
                        newest[x] = q
    kinds: dict[str, list[str]] = defaultdict(list)
    for v in layouts.versions:
        for p, k in layouts.kinds[v].items():
            kinds[newest[p]].append(k)
    return newest, {p: promote(k) for p, k in sorted(kinds.items())}


def column_name(path: str) -> str:
    return path.replace("[]", "").replace(".", "__")


def consolidate(df: DataFrame, id_: str, version: str, text: str, layouts: Layouts, renamed: dict[tuple[str, str], str]) -> DataFrame:
    """One row per readable record: id, version, a column per path of the union schema, and ``other`` (JSON: path -> values) for what no version has as a rule.

    number -> double, boolean -> boolean, string -> string, array -> array<string>; a path below an array of objects
    is an array of the text of each object's value. A lone object in an array's place counts as that array.

    Kinds are promoted over each version's usual kind. A number written as a string is still a number; any other value
    that its column can't hold goes to ``other``, and so do whole numbers that a column would round, the second and
    further values of a column for one, and paths named like a column of the table's own.
    """
    newest, kinds = union_schema(layouts, renamed)
    by_bare = {p.replace("[]", ""): newest[p] for p in sorted(newest, key=lambda p: p.count("[]"))}
    # of two paths with one name the array of objects has the column, which holds the values of both
    columns = {column_name(p): (p, k) for p, k in sorted(kinds.items(), key=lambda x: x[0].count("[]")) if column_name(p) not in ("row_id", "version", "other")}
    kind_type = {"boolean": T.BooleanType(), "number": T.DoubleType(), "string": T.StringType(), "array": T.ArrayType(T.StringType())}
    schema = T.StructType([T.StructField("row_id", df.schema[id_].dataType), T.StructField("version", T.StringType())])
    for name, (p, k) in columns.items():
        schema.add(name, T.ArrayType(T.StringType()) if "[]" in p else kind_type[k])
    schema.add("other", T.StringType())
    arrow = {"boolean": pa.bool_(), "number": pa.float64(), "string": pa.string(), "array": pa.list_(pa.string())}
    types = [pa.list_(pa.string()) if "[]" in p else arrow[k] for p, k in columns.values()]

    def cast(values: list, path: str, kind: str) -> tuple:
        """What the column holds of ``values`` (path, value), and those that it doesn't hold as they are."""
        if "[]" in path or kind == "array":
            flat = [x for _, v in values for x in (v if isinstance(v, list) and "[]" not in path else [v])]
            return [_text(x) if x is not None else None for x in flat], [(p, v) for p, v in values if rounded(v) or isinstance(v, list) and any(map(rounded, v))]
        v, rest = values[0][1], values[1:]
        if kind == "string":
            return v if isinstance(v, str) else _text(v), values if rounded(v) else rest
        if kind == "boolean":
            return (v, rest) if isinstance(v, bool) else (None, values)
        number = json.loads(v) if isinstance(v, str) and len(v) < 300 and NUMBER.fullmatch(v) and math.isfinite(float(v)) else v
        if not isinstance(number, (int, float)):
            return None, values
        try:
            return float(number), values if rounded(number) else rest
        except OverflowError:
            return None, values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(len(columns) + 3)]
            for i, v, t in zip(*(b.column(j).to_pylist() for j in range(3))):
                record = read_record(t)
                if record is None:
                    continue
                got: dict[str, list] = defaultdict(list)
                rest: dict[str, list] = defaultdict(list)
                for p, x in leaves(record, strays=True):
                    name = newest.get(p) or by_bare.get(p.replace("[]", ""))
                    name = name and column_name(name)
                    if name in columns:
                        got[name].append((p, x))
                    else:
                        rest[p].append(x)
                out[0].append(i)
                out[1].append(v)
                for at, (name, (p, k)) in enumerate(columns.items(), 2):
                    held, over = cast(got[name], p, k) if name in got else (None, ())
                    out[at].append(held)
                    for q, x in over:
                        rest[q].append(x)
                out[-1].append(write(dict(sorted(rest.items()))) if rest else None)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.column(0).type), pa.array(out[1], pa.string()), *(pa.array(x, t) for x, t in zip(out[2:-1], types)), pa.array(out[-1], pa.string())], names=schema.names)

    return df.select(F.col(id_), F.col(version).alias("version"), F.col(text)).mapInArrow(run, schema)


__all__ = ["Layouts", "changes", "column_name", "consolidate", "profile", "promote", "rename_votes", "renames", "study", "union_schema"]
