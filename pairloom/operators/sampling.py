"""Samples that are diverse, weighted, balanced or tried again, by hashes instead of a sequential generator.

A draw is a hash of the seed and the row's key, so it doesn't depend on order, partitions or the number of tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.rank import distributed_rank, ordinal

#: Names with their weights, and by kind the names that it does not take.
Options = Sequence[tuple[str, float]]
Blocked = Mapping[str, Sequence[str]]


def round_robin(df: DataFrame, category: str, id_: str, n: int, seed: int = 7, excluded: DataFrame | None = None) -> DataFrame:
    """``n`` rows spread over the categories: one of each per round, categories and rows in hash order.

    ``excluded`` (a table with ``id_``) is left out. Only the first n of a category can be taken, so the rank is
    limited before the shuffle; the last step sorts at most n rows of each category's first rounds.
    """
    left = df if excluded is None else df.join(excluded.select(id_), id_, "left_anti")
    key = lambda x: F.md5(F.concat(F.lit(f"{seed}:"), x.cast("string")))
    w = Window.partitionBy(category).orderBy(key(F.col(id_)), id_)
    ranked = left.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n)
    return ranked.orderBy("turn", key(F.col(category)), category, id_).limit(n)


def weighted_pick(u: Column, options: Sequence[tuple[str, float]], whole: int = 1 << 32) -> Column:
    """The option in whose share of [0, whole) the uniform ``u`` falls; options of no weight are never taken, without weights null."""
    live = [(name, w) for name, w in options if w > 0]
    total = sum(w for _, w in live)
    out, upto = None, 0.0
    for name, w in live:
        upto += w
        edge = F.lit(int(round(upto / total * whole)))
        out = F.when(u < edge, name) if out is None else out.when(u < edge, name)
    return out if out is not None else F.lit(None).cast("string")


def quotas(n: int, options: Sequence[tuple[str, float]]) -> dict[str, int]:
    """``n`` shared out by weight: whole parts, then one more each by the largest remainder, ties in the order given."""
    total = sum(max(0.0, w) for _, w in options)
    if not total:
        return {}
    exact = {name: n * max(0.0, w) / total for name, w in options}
    out = {name: int(x + 1e-9) for name, x in exact.items()}
    for name in sorted(exact, key=lambda k: -(exact[k] - out[k]))[: n - sum(out.values())]:
        out[name] += 1
    return out


def balanced(df: DataFrame, id_: str, options: Options, name: str, seed: int = 7, kind: str | None = None, blocked: Blocked | None = None, otherwise: str | None = None) -> DataFrame:
    """``df`` with ``name``: every row one option, the counts being ``quotas``; the parallel form of deficit sampling.

    Rows whose ``kind`` is in ``blocked`` share out the options that are not blocked for it, ``otherwise`` where none is
    left; kinds with the same options are counted together. Rows take the options in the order of their hash; ranks
    come from prefix sums over hash ranges, and only one number per set of options is collected.
    """
    sets = {k: tuple(sorted(b)) for k, b in (blocked or {}).items()}
    of = F.lit(0)
    numbers = {b: i for i, b in enumerate(dict.fromkeys(sets.values()), 1)}
    for k, b in sets.items():
        of = F.when(F.col(kind) == k, numbers[b]).otherwise(of)
    keyed = df.withColumn("__pl_h", F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_).cast("string"))), F.col(id_).cast("string"))).withColumn("__pl_c", of)
    sizes = {r["__pl_c"]: r["n"] for r in keyed.groupBy("__pl_c").agg(F.count("*").alias("n")).collect()}
    ranked = distributed_rank(keyed, ["__pl_c"], "__pl_h", "__pl_place")
    out = F.lit(otherwise).cast("string")
    for b, i in [((), 0), *numbers.items()]:
        edges, upto = [], 0
        for option, n in quotas(sizes.get(i, 0), [o for o in options if o[0] not in b]).items():
            upto += n
            edges.append((option, upto))
        for option, edge in reversed(edges):
            out = F.when((F.col("__pl_c") == i) & (F.col("__pl_place") < edge), option).otherwise(out)
    # of a set's edges the first that lies above the place counts, which is the one put on last
    return ranked.withColumn(name, out).drop("__pl_h", "__pl_c", "__pl_place")


class Deficits:
    """Draws one by one, each with chances in proportion to how far the options are below their share of the next total.

    All state is a vector of counts. Where nothing is lacking the shares are the chances; ``extra`` is added to every
    deficit; without ``seed`` the largest deficit wins, the first of equals.
    """

    def __init__(self, options: Options, seed: Sequence[int] | None = None, extra: float = 0.0, blocked: Blocked | None = None):
        self.names = [k for k, w in options if w > 0]
        weights = np.array([w for _, w in options if w > 0], float)
        self.made, self.extra = np.zeros(len(weights)), extra
        self.chance = None if seed is None else np.random.default_rng(seed)
        masks = {None: np.ones(len(weights), bool)} | {k: np.array([n not in b for n in self.names], bool) for k, b in (blocked or {}).items()}
        # per kind: which options it takes, as places, and their shares
        self.takes = {k: (np.flatnonzero(m), weights[m] / weights[m].sum()) for k, m in masks.items()}

    def draw(self, kind: str | None = None) -> str | None:
        """The next option, counted; None if the kind takes none."""
        k = self.choose(kind)
        if k is None:
            return None
        self.made[k] += 1
        return self.names[k]

    def choose(self, kind: str | None = None) -> int | None:
        """The place of the next option, not counted."""
        at, share = self.takes.get(kind) or self.takes[None]
        if not len(at):
            return None
        lack = np.maximum(share * (self.made[at].sum() + 1) - self.made[at], 0) + self.extra
        if self.chance is None:
            return at[lack.argmax()]
        upto = np.cumsum(lack if lack.sum() > 1e-9 else share)
        return at[min(np.searchsorted(upto, self.chance.random() * upto[-1], side="right"), len(at) - 1)]


def cycle(options: Options) -> list[str]:
    """The sequence of draws by the largest deficit up to the first place where all shares hold exactly, from which it repeats."""
    weights = [Fraction(str(w)) for _, w in options if w > 0]
    draws, out = Deficits(options), []
    while weights:
        out.append(draws.draw())
        if all(Fraction(int(m)) == w / sum(weights) * len(out) for m, w in zip(draws.made, weights)):
            break
    return out


def largest_deficit(df: DataFrame, order: Sequence[str], options: Options, name: str) -> DataFrame:
    """``df`` with ``name``: always the option furthest below its share, over all rows in their ``order``; a row's place tells its option."""
    repeated = F.array(*map(F.lit, cycle(options)))
    return ordinal(df, order, "__pl_place").withColumn(name, F.get(repeated, (F.col("__pl_place") % F.size(repeated)).cast("int"))).drop("__pl_place")


def deficit_sampling(
    df: DataFrame, group: str | None, order: str, options: Options, name: str, seed: int = 0,
    extra: float = 0.0, kind: str | None = None, blocked: Blocked | None = None, otherwise: str | None = None, block: int = 1_000_000,
) -> DataFrame:
    """group, order, ``name``: the sequential draws of each group in its order; without ``group`` of each ``block`` of rows.

    A row whose ``kind`` has options in ``blocked`` draws among the others; ``otherwise`` stands where none is left.
    Each group has draws and counts of its own. A draw depends on all before it, so a group is one task's work, read as
    a stream whose state is the counts; so all rows are drawn for in blocks, each of which holds the shares by itself.
    ``balanced`` is the form without sequence.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keep = [c for c in (group, order) if c]
    at = df if group else ordinal(df, [order], "__pl_place").withColumn("__pl_block", F.floor(F.col("__pl_place") / block))
    by = group or "__pl_block"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, draws = object(), None
        for b in batches:
            drawn = []
            for g, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if g != now:
                    now, draws = g, Deficits(options, [seed, zlib.crc32(str(g).encode())], extra, blocked)
                drawn.append(draws.draw(k) or otherwise)
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(drawn, pa.string())], names=[*keep, name])

    rows = at.select(F.col(by).alias("__pl_g"), (F.col(kind) if kind else F.lit(None).cast("string")).alias("__pl_kind"), *keep)
    return rows.repartition("__pl_g").sortWithinPartitions("__pl_g", order).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + f", {name} string")


def amortised(df: DataFrame, job: str, order: str, subject: str, ok: str, options: Options, pairs: int = 12, tries: int = 4, seed: int = 0, extra: float = 0.05) -> DataFrame:
    """job, slot, attempt, op, subject: what each job makes in at most ``pairs`` slots of at most ``tries`` attempts.

    An attempt takes the job's next row and an operation by deficit. It makes a pair if the row is ``ok`` and the job has
    not had this operation on this subject; a slot whose attempts are used up stays empty. The state (counts, what was
    seen) is the job's own and goes with it through one task, which reads the job as a stream.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, draws, seen, slot, attempt = object(), None, set(), 0, 0
        for b in batches:
            out = []
            for j, s, good in zip(*(b.column(i).to_pylist() for i in range(3))):
                if j != now:
                    now, draws, seen, slot, attempt = j, Deficits(options, [seed, zlib.crc32(str(j).encode())], extra), set(), 0, 0
                if slot >= pairs:
                    continue
                k = draws.choose()
                made = bool(good) and k is not None and (k, s) not in seen
                if made:
                    seen.add((k, s))
                    draws.made[k] += 1
                    out.append((j, slot, attempt, draws.names[k], s))
                attempt += 1
                if made or attempt == tries:
                    slot, attempt = slot + 1, 0
            types = (b.column(0).type, pa.int32(), pa.int32(), pa.string(), b.column(1).type)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["job", "slot", "attempt", "op", "subject"])

    rows = df.where(F.col(job).isNotNull()).repartition(job).sortWithinPartitions(job, order).select(job, subject, ok)
    return rows.mapInArrow(run, f"job {kinds[job]}, slot int, attempt int, op string, subject {kinds[subject]}")


def first_valid(df: DataFrame, keys: Sequence[str], attempt: str, ok: Column, most: int = 30) -> DataFrame:
    """keys, ok, n_tries: the first of at most ``most`` attempts that passes, or all tried in vain. One aggregate, no order."""
    tried = df.where(F.col(attempt) <= most)
    out = tried.groupBy(*keys).agg(F.min(F.when(ok, F.col(attempt))).alias("__pl_first"), F.max(attempt).alias("__pl_last"))
    return out.select(*keys, F.col("__pl_first").isNotNull().alias("ok"), F.coalesce("__pl_first", "__pl_last").alias("n_tries"))


def ideal_or_first(df: DataFrame, keys: Sequence[str], draw: str, ideal: Column, legal: Column, most: int = 10) -> DataFrame:
    """Per key one of the first ``most`` draws: the first ideal one, else the first legal one, else no row."""
    kept = df.where((F.col(draw) <= most) & F.coalesce(legal, F.lit(False)))
    order = F.struct(F.when(F.coalesce(ideal, F.lit(False)), 0).otherwise(1).alias("tier"), F.col(draw).alias("draw"))
    rest = [c for c in df.columns if c not in keys]
    return kept.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__pl_r")).select(*keys, *[F.col(f"__pl_r.{c}").alias(c) for c in rest])
