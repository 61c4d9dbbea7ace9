"""Capping records per dominant contributor, by a count or by a share, keeping the best by quality.

A small count: the best of a contributor are found with a rank whose limit is applied in each input partition before
the shuffle (WindowGroupLimit), so even a contributor with a third of all rows sends at most ``cap`` rows per partition.
A large count, above which Spark doesn't limit ranks early: the rows of the contributors above it are sorted by ranges
of (contributor, quality, id), so that a hot one lies in many partitions, and the place of its last kept row follows
from prefix sums over the partitions' counts. A share limit is turned into a count first, by water-filling over the
histogram of contributor sizes.

Defined cases: a null contributor is no contributor, its records all stay; null and NaN quality is worst; of equals
the smaller id stays; an empty table keeps nothing; other columns are not looked at. Ids are numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import cut

#: The largest count for which Spark limits a rank before the shuffle (``spark.sql.optimizer.windowGroupLimitThreshold``).
RANKED_EARLY = 1000


def _score(quality: str) -> Column:
    return F.when(~F.isnan(quality), F.col(quality))


def _place(quality: str, id_: str) -> Column:
    """What orders a contributor's rows, the best first."""
    return F.struct((-F.coalesce(_score(quality), F.lit(float("-inf")))).alias("q"), F.col(id_).alias("i"))


def last_kept(df: DataFrame, contributor: str, quality: str, id_: str, cap: int, few: bool = False) -> DataFrame:
    """contributor, __pl_last: the place of the last kept row of each contributor with more than ``cap`` (at least 1) rows.

    ``few``: the contributors above the cap are known to be so few that their names can be broadcast.
    """
    hint = F.broadcast if few else lambda x: x
    named = df.where(F.col(contributor).isNotNull())
    over = named.groupBy(contributor).agg(F.count("*").alias("__pl_n")).where(F.col("__pl_n") > cap).select(contributor)
    hot = named.select(contributor, _place(quality, id_).alias("__pl_at")).join(hint(over), contributor)
    ranged = cut(hot.repartitionByRange(contributor, "__pl_at").sortWithinPartitions(contributor, "__pl_at"))
    placed = ranged.withColumn("__pl_k", F.monotonically_increasing_id()).withColumn("__pl_p", F.shiftrightunsigned("__pl_k", 33))
    # a row per contributor and partition
    runs = placed.groupBy(contributor, "__pl_p").agg(F.count("*").alias("n"), F.min("__pl_k").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(contributor).orderBy("__pl_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = runs.withColumn("before", before).where((F.col("before") < cap) & (F.col("before") + F.col("n") >= cap)).select((F.col("first") + F.lit(cap - 1) - F.col("before")).alias("__pl_k"))
    return placed.join(hint(ends), "__pl_k").select(contributor, F.col("__pl_at").alias("__pl_last"))


def kept(df: DataFrame, contributor: str, quality: str, id_: str, cap: int, few: bool = False) -> DataFrame:
    """The rows of named contributors that stay."""
    named = df.where(F.col(contributor).isNotNull())
    if cap > RANKED_EARLY:
        last = last_kept(df, contributor, quality, id_, cap, few)
        both = named.join(F.broadcast(last) if few else last, contributor, "left")
        return both.where(F.col("__pl_last").isNull() | (_place(quality, id_) <= F.col("__pl_last"))).drop("__pl_last")
    rank = F.row_number().over(Window.partitionBy(contributor).orderBy(_score(quality).desc_nulls_last(), F.col(id_).asc()))
    return named.withColumn("__pl_rank", rank).where(F.col("__pl_rank") <= cap).drop("__pl_rank")


def dropped(df: DataFrame, contributor: str, quality: str, id_: str, cap: int) -> DataFrame:
    """The rows that don't stay: those below the last kept row of their contributor.

    One row per contributor over its cap (its last kept quality and id) is joined back; a side that grows with the
    contributors, so the planner chooses how, and splits a hot contributor's rows where it shuffles them.
    """
    if cap > RANKED_EARLY:
        last = last_kept(df, contributor, quality, id_, cap)
    else:
        best = kept(df.select(contributor, quality, id_), contributor, quality, id_, cap)
        last = best.groupBy(contributor).agg(F.max(_place(quality, id_)).alias("__pl_last"), F.count("*").alias("__pl_n")).where(F.col("__pl_n") >= cap).drop("__pl_n")
    return df.where(F.col(contributor).isNotNull()).join(last, contributor).where(_place(quality, id_) > F.col("__pl_last")).drop("__pl_last")


def kept_to_share(df: DataFrame, contributor: str, quality: str, id_: str, share: float) -> DataFrame:
    """The rows of named contributors that stay when none may have more than ``share`` of all that stay.

    Where c records are at most the share, fewer than 1 / share contributors can have more than c that stay, so the
    names above the count are few.
    """
    cap = share_cap(df, contributor, share)
    return df.where(F.col(contributor).isNotNull()) if cap is None else kept(df, contributor, quality, id_, cap, few=share >= 1e-4)


def water_level(histogram: list[tuple[int, int]], share: float, uncapped: int = 0) -> int | None:
    """The largest count c such that c records are at most ``share`` of what is left when every contributor is cut to c.

    ``histogram``: (records, contributors with so many). ``uncapped``: records that always stay. None: no limit is
    needed. 0: even one record each is more than the share (fewer contributors than 1/share and nothing else).
    """
    sizes = sorted(h for h in histogram if h[0] > 0)
    if not sizes:
        return None
    total = uncapped + sum(n * k for n, k in sizes)
    if sizes[-1][0] <= share * total:
        return None
    below, above = uncapped, sum(k for _, k in sizes)
    best = 0
    previous = 0
    for n, k in sizes:
        # for c in previous..n the kept total is below + c * above; c <= share * total solves in closed form
        room = 1 - share * above
        top = n if room <= 1e-12 else min(n, int(share * below / room + 1e-9))
        if top >= previous:
            best = max(best, top)
        below, above, previous = below + n * k, above - k, n
    return best


def share_cap(df: DataFrame, contributor: str, share: float) -> int | None:
    """The count to which a share limit comes; what is collected is the histogram of contributor sizes, whose rows are at most the root of twice the records."""
    sizes = df.groupBy(contributor).agg(F.count("*").alias("n"))
    loose = sizes.where(F.col(contributor).isNull()).agg(F.sum("n")).first()[0] or 0
    histogram = sizes.where(F.col(contributor).isNotNull()).groupBy("n").agg(F.count("*").alias("k")).collect()
    return water_level([(r["n"], r["k"]) for r in histogram], share, loose)
