"""Mixing sources to target weights.

Each record gets a hash-random key (md5 of seed and id). Within a source the records are taken in the order of that
key until the source's budget is full; where the budget exceeds the source, whole epochs come first. The place of the
cut is found by a radix search, in place of a sort of each source by range, with the same cut: prefix sums of sizes over the ranges of the key's next digits give the range in which
the budget ends, and only that range is looked into again, so the sums are distributed and no source is sorted whole.

The total is the largest at which every source can hold its share: min(size * max_repeats / share).

Defined cases: records of null or unnamed sources, and of null, NaN or non-positive size, are left out; a target
source without records gets nothing and the total is set by the others, whose shares are then taken relative to each
other; shares that don't add up to 1 are scaled; no targets or no records give an empty mix. Repeated ids are separate
records that enter together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import cut

#: Hex digits by which a level of the radix search splits; 16**3 ranges per source.
DIGITS = 3
#: Levels of the search, after which a range is sorted: 16**6 ranges hold some thousand records of 100 billion each.
LEVELS = 2


@dataclass
class Budget:
    source: str
    share: float
    max_repeats: int
    available: int
    budget: int = 0

    @property
    def epochs(self) -> int:
        return self.budget // self.available if self.available else 0

    @property
    def rest(self) -> int:
        return self.budget - self.epochs * self.available if self.available else 0


def budgets(available: dict[str, int], targets: list[tuple[str, float, int]]) -> list[Budget]:
    """Each target source's budget in units of size."""
    out = [Budget(s, share, max(0, reps), available.get(s, 0)) for s, share, reps in targets if share and share > 0]
    live = [b for b in out if b.available and b.max_repeats]
    whole = sum(b.share for b in live)
    if live:
        total = min(b.available * b.max_repeats / (b.share / whole) for b in live)
        for b in live:
            b.budget = min(b.available * b.max_repeats, math.floor(total * (b.share / whole) + 1e-6))
    return out


def mixes(df: DataFrame, id_: str, sources: Mapping[str, Column], size: Column, targets: DataFrame, seed: int = 7, digits: int = DIGITS, levels: int = LEVELS) -> tuple[DataFrame, dict[str, list[Budget]]]:
    """(rows, budgets by field). rows: field_name, source_name, id, size, uses - records with at least one use.

    ``sources``: a mix is made for each field, from one reading of ``df``. ``targets`` (field_name, source_name,
    target_share, max_repeats) is the caller's table of a few sources; it is the only thing collected besides one number
    per source and level of the search.
    """
    spark = df.sparkSession
    wanted: dict[str, list] = {f: [] for f in sources}
    for r in targets.where(F.col("field_name").isin(*sources)).collect():
        wanted[r["field_name"]].append((r["source_name"], r["target_share"], r["max_repeats"]))
    pools = {(f, w[0]): t for t, (f, w) in enumerate((f, w) for f, ws in wanted.items() for w in ws if w[0] is not None)}
    named = spark.createDataFrame([(*k, t) for k, t in pools.items()], "field_name string, source_name string, pool int")
    each = df.select(F.col(id_).alias("id"), size.cast("long").alias("size"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), c.alias("source_name")) for f, c in sources.items()])).alias("s"))
    each = each.where("size > 0").select("id", "size", "s.*").join(F.broadcast(named), ["field_name", "source_name"])  # as many rows as targets
    said = F.col("id").cast("string")
    keyed = cut(each.select("pool", "id", "size")).withColumn("h", F.concat(F.md5(F.concat(F.lit(f"{seed}:"), said)), F.lit(":"), said))
    have = {r["pool"]: r["n"] for r in keyed.groupBy("pool").agg(F.sum("size").alias("n")).collect()}
    plan = {f: budgets({s: have[t] for (g, s), t in pools.items() if g == f and t in have}, ws) for f, ws in wanted.items()}
    budget = {pools[f, b.source]: b for f, bs in plan.items() for b in bs if (f, b.source) in pools}
    open_ = {t: ("", b.rest) for t, b in budget.items() if b.rest}  # pool -> prefix of the range, what is left of the budget in it

    def inside() -> DataFrame:
        at = spark.createDataFrame([(t, p, r) for t, (p, r) in open_.items()], "pool int, prefix string, rest long")
        return keyed.join(F.broadcast(at), "pool").where(F.col("h").startswith(F.col("prefix")))

    for level in range(levels):
        if not open_:
            break
        sums = inside().groupBy("pool", "rest", F.substring("h", 1, digits * (level + 1)).alias("range")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("pool").orderBy("range"))  # at most 16**digits rows a pool
        ends = sums.withColumn("upto", upto).where("upto > rest and upto - n <= rest").collect()
        open_ = {r["pool"]: (r["range"], r["rest"] - (r["upto"] - r["n"])) for r in ends}
    last: dict[int, str] = {}
    if open_:
        upto = F.sum("size").over(Window.partitionBy("pool").orderBy("h"))
        taken = inside().withColumn("upto", upto).where("upto <= rest").groupBy("pool").agg(F.max("h").alias("h"))
        last = {r["pool"]: r["h"] for r in taken.collect()}
    # up to and with ``last`` a record is used once more than the whole epochs; a range prefix sorts before all in it
    ends = [(f, s, t, budget[t].epochs, last.get(t) or (open_[t][0] if t in open_ else "")) for (f, s), t in pools.items() if t in budget]
    cuts = spark.createDataFrame(ends, "field_name string, source_name string, pool int, epochs long, last string")
    rows = keyed.join(F.broadcast(cuts), "pool")  # as many rows as there are targets
    rows = rows.withColumn("uses", F.col("epochs") + (F.col("h") <= F.col("last")).cast("long"))
    return rows.where("uses > 0").select("field_name", "source_name", F.col("id").alias(id_), "size", "uses"), plan


def mix(df: DataFrame, id_: str, source: Column, size: Column, targets: DataFrame, seed: int = 7, digits: int = DIGITS, levels: int = LEVELS) -> tuple[DataFrame, list[Budget]]:
    """One mix: (rows, budgets) without ``field_name``, by ``targets`` (source_name, target_share, max_repeats)."""
    rows, plan = mixes(df, id_, {"": source}, size, targets.select(F.lit("").alias("field_name"), "source_name", "target_share", "max_repeats"), seed, digits, levels)
    return rows.drop("field_name"), plan[""]


def epochs(rows: DataFrame) -> DataFrame:
    """One row per use, numbered from 0 in ``epoch``."""
    return rows.select(*[c for c in rows.columns if c != "uses"], F.explode(F.sequence(F.lit(0), F.col("uses") - 1)).alias("epoch"))


def report(rows: DataFrame, plan: list[Budget]) -> DataFrame:
    """Per target source: its share as wished and as reached, its records, and the most uses of one."""
    spark = rows.sparkSession
    names = "source_name string, target_share double, max_repeats long, available long, budget long"
    wished = spark.createDataFrame([(b.source, float(b.share), int(b.max_repeats), int(b.available), int(b.budget)) for b in plan], names)
    got = rows.groupBy("source_name").agg(F.sum(F.col("size") * F.col("uses")).alias("used"), F.count("*").alias("n_records"), F.max("uses").alias("most_uses"))
    out = wished.join(got, "source_name", "left").fillna(0, ["used", "n_records", "most_uses"])
    whole = F.sum("used").over(Window.partitionBy(F.lit(1)))  # as many rows as targets
    return out.withColumn("actual_share", F.try_divide(F.col("used").cast("double"), whole))
