"""Ranks and prefix sums that don't need one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import cut


def distributed_rank(df: DataFrame, group: Sequence[str], order: str, name: str = "rank", digits: int = 3) -> DataFrame:
    """``df`` with ``name``: the 0-based place of each row in its group by the hex digest ``order``.

    A group is cut into 16**digits ranges of the digest; only a range is sorted in one task, and the ranges' offsets
    are prefix sums over a table of at most 16**digits rows per group.
    """
    keyed = df.withColumn("__pl_b", F.substring(order, 1, digits))
    sizes = keyed.groupBy(*group, "__pl_b").agg(F.count("*").alias("__pl_n"))
    before = Window.partitionBy(*group).orderBy("__pl_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__pl_o", F.coalesce(F.sum("__pl_n").over(before), F.lit(0))).drop("__pl_n")
    inside = F.row_number().over(Window.partitionBy(*group, "__pl_b").orderBy(order)) - 1
    return keyed.withColumn("__pl_r", inside).join(offsets, [*group, "__pl_b"]).withColumn(name, F.col("__pl_r") + F.col("__pl_o")).drop("__pl_r", "__pl_o", "__pl_b")


def current_rows(df: DataFrame, key: str, id_: str, columns: Sequence[str]) -> DataFrame:
    """The row with the greatest id of each key, with ``columns``; a null key is a key of its own.

    An aggregate with map-side combine: a key written very often is reduced before the shuffle.
    """
    best = F.max_by(F.struct(*columns), F.col(id_)) if columns else F.max(F.struct(F.col(id_)))
    return df.groupBy(key).agg(F.max(id_).alias(id_), best.alias("__pl_r")).select(key, id_, *[F.col(f"__pl_r.{c}").alias(c) for c in columns if c not in (key, id_)])


def md5_uniform(x: Column, seed: str | int) -> Column:
    """A 32-bit number that any engine with md5 reproduces: the first eight hex digits of md5('seed:x')."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), x.cast("string"))), 1, 8), 16, 10).cast("long")


def ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """``df`` with ``name``: the 0-based place of every row in the order of ``order`` over the whole table.

    Rows are range-partitioned and sorted, written once (so that the ranges stay as they are), and numbered inside
    their partition; the partitions' offsets are prefix sums over one row per partition. Rows that tie in ``order``
    get distinct places, but which is not said: end ``order`` with a unique column.
    """
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id()
    placed = ranged.withColumn("__pl_at", at).withColumn("__pl_p", F.shiftrightunsigned("__pl_at", 33)).withColumn("__pl_i", F.col("__pl_at").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("__pl_p").agg(F.count("*").alias("__pl_n"))
    before = Window.orderBy("__pl_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("__pl_p", F.coalesce(F.sum("__pl_n").over(before), F.lit(0)).alias("__pl_o"))
    return placed.join(F.broadcast(offsets), "__pl_p").withColumn(name, F.col("__pl_i") + F.col("__pl_o")).drop("__pl_at", "__pl_p", "__pl_i", "__pl_o")
