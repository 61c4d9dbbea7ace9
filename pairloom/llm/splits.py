"""Splits that keep related records together.

``components``: distributed union-find. Each task folds its links into a local forest and passes on one link per node
(its root), flushing when the forest reaches ``forest_nodes``, so its memory is bounded. While many forests are left
they are merged hierarchically, ``fan_in`` partitions into one; when a level no longer shrinks the links below what
one task may hold, large-star and small-star rounds over aggregates finish the job without gathering any component.

``assign``: greedy, the largest group first, each to the split furthest below its target. Groups of one size are
interchangeable, so the greedy runs over the histogram of sizes and the groups of a size take the resulting places in
the order of their hash; no list of groups is ever in one place.

Defined cases: without splits (named, of positive share) nothing is assigned; links with a null end are left out; a
link from a node to itself makes the node known; no links give no components; a record with neither node is a group of
its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.rank import distributed_rank
from pairloom.session import cut

#: Nodes in a task's forest before it is passed on and begun anew.
FOREST_NODES = 2_000_000
#: Links that one task may hold when forests are merged to the end; beyond it the star rounds take over.
ONE_TASK_LINKS = 2_000_000
FAN_IN = 8

_LINK = "a string, b string"


def local_forest(limit: int):
    """A mapInArrow function: links in, links node -> root out, with the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[str, str] = {}

        def find(x: str) -> str:
            root = x
            while (up := parent[root]) != root:
                root = up
            while (up := parent[x]) != root:
                parent[x], x = root, up
            return root

        def flush() -> Iterator[pa.RecordBatch]:
            nodes = list(parent)
            roots = [find(x) for x in nodes]
            for i in range(0, len(nodes), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + 50_000], pa.string()), pa.array(roots[i : i + 50_000], pa.string())], names=["a", "b"])
            parent.clear()

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if a not in parent:
                    parent[a] = a
                if b not in parent:
                    parent[b] = b
                a, b = find(a), find(b)
                if a < b:
                    parent[b] = a
                elif b < a:
                    parent[a] = b
            if len(parent) >= limit:
                yield from flush()
        yield from flush()

    return run


def star_rounds(links: DataFrame, most: int = 60) -> DataFrame:
    """node a -> root b, by alternating large-star and small-star until nothing changes."""
    links = cut(links)
    seen = None
    for _ in range(most):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b >= a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        links = cut(small)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == seen:
            return links
        seen = now
    raise RuntimeError(f"no fixed point after {most} rounds")


def components(links: DataFrame, forest_nodes: int = FOREST_NODES, one_task_links: int = ONE_TASK_LINKS, fan_in: int = FAN_IN) -> DataFrame:
    """node, root (the least node of the component) for every node of ``links`` (two string columns)."""
    a, b = links.columns
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    forest = cut(links.mapInArrow(local_forest(forest_nodes), _LINK))
    n, parts = forest.count(), forest.rdd.getNumPartitions()
    while parts > 1 and n > one_task_links:
        parts = -(-parts // fan_in)
        merged = cut(forest.coalesce(parts).mapInArrow(local_forest(forest_nodes), _LINK))
        m = merged.count()
        forest, shrunk, n = merged, m < 0.7 * n, m
        if not shrunk:
            break
    if n <= one_task_links:
        out = forest.coalesce(1).mapInArrow(local_forest(2 * one_task_links + 1), _LINK)
    else:
        out = star_rounds(forest)
        out = out.where("a <> b").union(out.select("b", F.col("b").alias("r")).distinct())
    return out.select(F.col("a").alias("node"), F.col("b").alias("root"))


def greedy(histogram: list[tuple[int, int]], targets: list[tuple[str, float]]) -> dict[int, dict[str, int]]:
    """size -> split -> how many groups of that size it gets, largest first, each to the split furthest below target.

    Of splits equally far below, the one named first in ``targets`` takes the group. Runs of equal picks are taken in
    bulk, so the work grows with the sizes, not with the groups.
    """
    records = sum(s * k for s, k in histogram)
    whole = sum(t for _, t in targets) or 1.0
    lack = {name: records * t / whole for name, t in targets}
    order = {name: i for i, (name, _) in enumerate(targets)}
    out: dict[int, dict[str, int]] = {}
    for size, k in sorted(histogram, reverse=True):
        got = dict.fromkeys(lack, 0)
        if k > 64:  # everything above a common level that leaves a small rest
            lo, hi = min(lack.values()) - size * (k + 1), max(lack.values())
            for _ in range(200):
                mid = (lo + hi) / 2
                if sum(max(0, int((d - mid) // size)) for d in lack.values()) > k - 32:
                    lo = mid
                else:
                    hi = mid
            for name, d in lack.items():
                got[name] = max(0, int((d - hi) // size))
        for name in lack:
            lack[name] -= size * got[name]
        heap = [(-d, order[name], name) for name, d in lack.items()]
        heapq.heapify(heap)
        for _ in range(k - sum(got.values())):
            d, i, name = heapq.heappop(heap)
            got[name] += 1
            lack[name] -= size
            heapq.heappush(heap, (d + size, i, name))
        out[size] = got
    return out


def assign(groups: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """group, size, split_name for ``groups`` (group string, size long).

    Collected: the histogram of sizes (at most the root of twice the records) and the table of splits.
    """
    spark = groups.sparkSession
    histogram = [(r["size"], r["k"]) for r in groups.groupBy("size").agg(F.count("*").alias("k")).collect()]
    named = targets.where("split_name is not null and target_share > 0")
    wanted = [(r["split_name"], r["target_share"]) for r in named.orderBy(F.desc("target_share"), "split_name").collect()]
    if not wanted:
        return spark.createDataFrame([], "group string, size long, split_name string")
    places = []
    for size, got in greedy(histogram, wanted).items():
        upto = 0
        for name, n in got.items():
            if n:
                places.append((size, name, upto, upto + n))
                upto += n
    at = spark.createDataFrame(places, "size long, split_name string, low long, high long")
    ranked = distributed_rank(groups.withColumn("__pl_h", F.md5(F.concat(F.lit(f"{seed}:"), "group"))), ["size"], "__pl_h", "__pl_rank", digits=2)
    joined = ranked.join(at, (ranked["size"] == at["size"]) & (ranked["__pl_rank"] >= at["low"]) & (ranked["__pl_rank"] < at["high"]))
    return joined.select("group", ranked["size"], "split_name")
