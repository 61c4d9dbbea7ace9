"""Keyed tables without a row-level MERGE: join and rewrite.

Every function is idempotent: applying the same input again gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(old: DataFrame, new: DataFrame, key: str, overwrite: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``old`` with the rows of ``new`` merged in by ``key``.

    A key of ``new`` overwrites the ``overwrite`` columns, a null in it too, and leaves the ``keep`` columns of an old
    row as they are (null for a fresh row). Keys must be unique in each table; a null key matches nothing.
    """
    n = new.select(F.col(key).alias("__pl_k"), F.struct(*overwrite).alias("__pl_n"))
    both = old.join(n, old[key] == n["__pl_k"], "full")
    fresh = F.col("__pl_k").isNotNull()
    return both.select(F.coalesce(old[key], F.col("__pl_k")).alias(key), *[F.when(fresh, F.col(f"__pl_n.{c}")).otherwise(old[c]).alias(c) for c in overwrite], *[old[c] for c in keep])


def replace_sets(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` without the rows of any key in ``new``, plus ``new``, distinct."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns)).dropDuplicates()


def recount(assets: DataFrame, usage: DataFrame, uid: str = "uid", usage_uid: str = "asset_uid", count: str = "used_count") -> DataFrame:
    """``assets`` with ``count`` set from ``usage``; used assets that are missing are added, unused ones keep their old count."""
    n = usage.where(F.col(usage_uid).isNotNull()).groupBy(F.col(usage_uid).alias("__pl_u")).agg(F.count("*").cast("int").alias("__pl_n"))
    both = assets.join(n, assets[uid] == n["__pl_u"], "full")
    return both.select(*[(F.coalesce(assets[uid], F.col("__pl_u")) if c == uid else F.coalesce(F.col("__pl_n"), assets[count]) if c == count else assets[c]).alias(c) for c in assets.columns])


def backfill(table: DataFrame, mapping: DataFrame, key: str, column: str) -> DataFrame:
    """``table`` with ``column`` taken from ``mapping`` where it has the key; no row is added."""
    m = mapping.select(F.col(key).alias("__pl_k"), F.col(column).alias("__pl_v"))
    return table.join(m, table[key] == m["__pl_k"], "left").select(*[(F.coalesce(F.col("__pl_v"), table[c]) if c == column else table[c]).alias(c) for c in table.columns])


def add_columns(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``table`` with the missing ones of ``columns`` (name -> type) added as nulls."""
    return table.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in table.columns})


def with_fallback(unused: DataFrame, all_: DataFrame) -> DataFrame:
    """``unused``, or all of ``all_`` if it is empty; looks at one row only."""
    return all_ if unused.isEmpty() else unused


def ledger(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The keys of both, each once, with whether it was added now."""
    o = old.select(key).distinct().withColumn("__pl_old", F.lit(True))
    n = new.select(key).distinct()
    return o.join(n, key, "full").where(F.col(key).isNotNull()).select(key, F.col("__pl_old").isNull().alias("is_new"))


def batches(used: DataFrame, key: str, batch: str) -> DataFrame:
    """batch, new_uids, all_uids: how many keys each batch used first, and how many all up to it; null keys and batches don't count."""
    first = used.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(batch).alias(batch)).where(F.col(batch).isNotNull())
    new = first.groupBy(batch).agg(F.count("*").alias("new_uids"))
    return new.withColumn("all_uids", F.sum("new_uids").over(Window.orderBy(batch)))  # a row per batch
