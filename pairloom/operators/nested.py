"""Deeply nested records as flat tables, tied to their parents by interval labels.

One depth-first walk numbers every node of a record: ``pre`` when it is entered, ``post`` when it is left. A node lies
inside another exactly if its pre is greater and its post smaller, so any two node tables of one record can be tied by
containment, whatever lies between them.

Defined cases: unreadable records have no nodes; depth is unbounded; a lone object in an array's place is its element
0; null and scalar elements are no nodes of a table but keep their place; repeated record ids keep their own nodes only
if the caller's id is unique (it ties nodes together).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.records import read_record, write

NODE_SCHEMA = "node_path string, pre int, post int, pos int, body string"


def label(record: dict, wanted: frozenset[str], bodies: bool) -> list[tuple[str, int, int, int, str | None]]:
    """(path, pre, post, pos, body) of every object whose path is wanted; the numbers count all nodes of the record."""
    out: list = []
    pre = post = 0

    def walk(node: dict | list, path: str, pos: int) -> None:
        nonlocal pre, post
        entered = pre
        pre += 1
        if type(node) is dict:
            base = path + "." if path else ""
            for k, v in node.items():
                if type(v) is dict or type(v) is list:
                    walk(v, base + k, 0)
                else:
                    pre += 1
                    post += 1
            if path in wanted:
                out.append((path, entered, post, pos, write(node) if bodies else None))
        else:
            for i, v in enumerate(node):
                if type(v) is dict or type(v) is list:
                    walk(v, path, i)
                else:
                    pre += 1
                    post += 1
        post += 1

    try:
        walk(record, "", 0)
    except RecursionError:
        return _label_deep(record, wanted, bodies)
    return out


def _label_deep(record: dict, wanted: frozenset[str], bodies: bool) -> list[tuple[str, int, int, int, str | None]]:
    """``label`` with a stack of its own, for nesting beyond the interpreter's."""
    out: list = []
    pre = post = 0
    stack: list = [(record, "", 0, None)]
    while stack:
        node, path, pos, entered = stack.pop()
        if entered is not None:
            if type(node) is dict and path in wanted:
                out.append((path, entered, post, pos, write(node) if bodies else None))
            post += 1
        elif type(node) is dict or type(node) is list:
            stack.append((node, path, pos, pre))
            pre += 1
            if type(node) is dict:
                base = path + "." if path else ""
                stack.extend((v, base + k, 0, None) for k, v in reversed(node.items()))
            else:
                stack.extend((v, path, i, None) for i, v in zip(range(len(node) - 1, -1, -1), reversed(node)))
        else:
            pre += 1
            post += 1
    return out


def nodes(df: DataFrame, id_: str, text: str, paths: Sequence[str], bodies: bool = False) -> DataFrame:
    """id, node_path, pre, post, pos and, if asked for, the node's JSON: one row per object at one of ``paths``."""
    wanted = frozenset(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if (record := read_record(t)) is not None:
                    got = label(record, wanted, bodies)
                    rows += got
                    ids += [i] * len(got)
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), *(pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds))], names=["id", "node_path", "pre", "post", "pos", "body"])

    kind = df.schema[id_].dataType.simpleString()
    return df.select(id_, text).mapInArrow(run, f"id {kind}, {NODE_SCHEMA}").withColumnRenamed("id", id_)


def link(children: DataFrame, parents: DataFrame, id_: str) -> DataFrame:
    """``children`` with ``parent_pre`` and ``parent_pos`` of the node of ``parents`` that contains each, else null and -1.

    The parents are nodes of one path, so none lies inside another: in the order of ``pre`` the last parent before a
    child contains it if any does, and its interval tells. One sort of a record's nodes, without pairs of them.
    """
    rest = [c for c in children.columns if c not in (id_, "pre", "post", "pos")]
    interval = F.struct("pre", "post", "pos")
    both = children.select(id_, "pre", "post", "pos", F.struct(*rest).alias("__pl_rest"), F.lit(None).cast(parents.select(interval.alias("i")).schema["i"].dataType).alias("__pl_parent"))
    both = both.unionByName(parents.select(id_, "pre", "post", "pos", F.lit(None).cast(both.schema["__pl_rest"].dataType).alias("__pl_rest"), interval.alias("__pl_parent")))
    last = F.last("__pl_parent", ignorenulls=True).over(Window.partitionBy(id_).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1))
    tied = both.withColumn("__pl_last", last).where(F.col("__pl_parent").isNull())
    p = F.when(F.col("post") < F.col("__pl_last.post"), F.col("__pl_last"))
    return tied.select(*[c if c in (id_, "pre", "post", "pos") else F.col(f"__pl_rest.{c}").alias(c) for c in children.columns], p["pre"].alias("parent_pre"), F.coalesce(p["pos"], F.lit(-1)).alias("parent_pos"))
