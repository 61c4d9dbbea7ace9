"""Joins over axis-aligned boxes of scene objects.

Boxes (scene, obj, lo_x..hi_z) meet through a grid: each box is copied to the cells that its ground plan covers, pairs
are made inside a cell, and a pair is kept only in the first cell that both cover. So a scene with very many objects is
spread over its cells instead of being paired with itself in one task, and no pair comes twice. ``cell`` is a length in
the units of the boxes, to be chosen near the usual size of an object.

Boxes with a null corner touch nothing. An object never pairs with itself.

The planner takes a box copied to its cells to be no larger than the box, so it would send all copies to every executor
by way of the driver. These joins therefore sort and merge, whatever the tables' files weigh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("lo_x", "lo_y", "lo_z", "hi_x", "hi_y", "hi_z")


def _cells(df: DataFrame, cell: int, reach: int) -> DataFrame:
    cut = lambda c, d: F.floor((F.col(c) + d) / cell)
    x0, x1, y0, y1 = cut("lo_x", -reach), cut("hi_x", reach), cut("lo_y", -reach), cut("hi_y", reach)
    return df.where(F.col("lo_x").isNotNull() & F.col("hi_x").isNotNull() & F.col("lo_y").isNotNull() & F.col("hi_y").isNotNull()).withColumn("_x", F.explode(F.sequence(x0, x1))).withColumn("_y", F.explode(F.sequence(y0, y1)))


def _sided(df: DataFrame, side: str, cell: int, reach: int) -> DataFrame:
    cells = _cells(df.select("scene", "obj", *BOX), cell, reach)
    return cells.select(F.col("scene").alias(f"{side}_scene"), F.col("obj").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in BOX], F.col("_x").alias(f"{side}_x"), F.col("_y").alias(f"{side}_y"), F.floor((F.col("lo_x") - reach) / cell).alias(f"{side}_x0"), F.floor((F.col("lo_y") - reach) / cell).alias(f"{side}_y0"))


def pairs(left: DataFrame, right: DataFrame, cell: int, reach: int = 0) -> DataFrame:
    """Candidate pairs (a of ``left``, b of ``right``) of one scene whose ground plans, a's widened by ``reach``, share a cell; each pair once."""
    a, b = _sided(left, "a", cell, reach), _sided(right, "b", cell, 0)
    same = (a["a_scene"] == b["b_scene"]) & (a["a_x"] == b["b_x"]) & (a["a_y"] == b["b_y"])
    first = (F.col("a_x") == F.greatest("a_x0", "b_x0")) & (F.col("a_y") == F.greatest("a_y0", "b_y0"))
    return a.join(b.hint("merge"), same).where(first & (F.col("a") != F.col("b"))).withColumnRenamed("a_scene", "scene")


def _centred(df: DataFrame, side: str, cell: int) -> DataFrame:
    """Each box once, in the cell of its ground-plan centre; one without a centre is in no cell."""
    at = lambda axis: F.floor((F.col(f"lo_{axis}") + F.col(f"hi_{axis}")) / (2 * cell)).alias(f"{side}_{axis}")
    return df.select(F.col("scene").alias(f"{side}_scene"), F.col("obj").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in BOX], at("x"), at("y"))


def _near(df: DataFrame, side: str, cell: int, reach: int) -> DataFrame:
    """Each box copied to the cells that a centre at most ``reach`` from its own along each axis can be in."""
    twice = lambda axis: F.col(f"lo_{axis}") + F.col(f"hi_{axis}")
    cells = lambda axis: F.explode(F.sequence(F.floor((twice(axis) - 2 * reach) / (2 * cell)), F.floor((twice(axis) + 2 * reach) / (2 * cell))))
    copies = df.where(twice("x").isNotNull() & twice("y").isNotNull()).withColumn("_x", cells("x")).withColumn("_y", cells("y"))
    return copies.select(F.col("scene").alias(f"{side}_scene"), F.col("obj").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in BOX], F.col("_x").alias(f"{side}_x"), F.col("_y").alias(f"{side}_y"))


def _same_cell(a: str, b: str) -> Column:
    """Of one scene and cell, and not the same object."""
    return (F.col(f"{a}_scene") == F.col(f"{b}_scene")) & (F.col(f"{a}_x") == F.col(f"{b}_x")) & (F.col(f"{a}_y") == F.col(f"{b}_y")) & (F.col(a) != F.col(b))


def _over(inner: DataFrame, outer: DataFrame, i: str, o: str, cell: int) -> DataFrame:
    """Candidate pairs of an ``outer`` box (columns ``o``_...) and one of ``inner`` whose centre lies in a cell that it covers; each pair once, as a centre is in one cell."""
    return _sided(outer, o, cell, 0).join(_centred(inner, i, cell).hint("merge"), _same_cell(i, o))


def _overlap(a: str, b: str, axis: str) -> Column:
    return F.least(f"{a}_hi_{axis}", f"{b}_hi_{axis}") - F.greatest(f"{a}_lo_{axis}", f"{b}_lo_{axis}")


def _centre_inside(inner: str, outer: str) -> Column:
    """The ground-plan centre of ``inner`` lies in ``outer``; doubled, so that whole units stay whole."""
    twice = lambda axis: F.col(f"{inner}_lo_{axis}") + F.col(f"{inner}_hi_{axis}")
    return (twice("x") >= 2 * F.col(f"{outer}_lo_x")) & (twice("x") <= 2 * F.col(f"{outer}_hi_x")) & (twice("y") >= 2 * F.col(f"{outer}_lo_y")) & (twice("y") <= 2 * F.col(f"{outer}_hi_y"))


def resting_on(objects: DataFrame, cell: int, gap: int) -> DataFrame:
    """scene, carrier, carried: bottom within ``gap`` of the carrier's top, centre over it, half of the ground plan on it."""
    p = _over(objects, objects, "b", "a", cell)
    own = (F.col("b_hi_x") - F.col("b_lo_x")) * (F.col("b_hi_y") - F.col("b_lo_y"))
    shared = F.greatest(_overlap("a", "b", "x"), F.lit(0)) * F.greatest(_overlap("a", "b", "y"), F.lit(0))
    on = (F.abs(F.col("b_lo_z") - F.col("a_hi_z")) <= gap) & _centre_inside("b", "a") & (2 * shared >= own)
    return p.where(on).select(F.col("a_scene").alias("scene"), F.col("a").alias("carrier"), F.col("b").alias("carried"))


def penetration(objects: DataFrame, cell: int, skin: int) -> DataFrame:
    """scene, obj, depth: how deep an object's bottom is inside the deepest object under its centre, 0 if in none; one row per object."""
    inside = _centre_inside("a", "b") & (F.col("b_lo_z") < F.col("a_lo_z")) & (F.col("a_lo_z") < F.col("b_hi_z") - skin)
    p = _centred(objects, "a", cell).join(_sided(objects, "b", cell, 0).hint("merge"), _same_cell("a", "b") & inside, "left")
    return p.groupBy(F.col("a_scene").alias("scene"), F.col("a").alias("obj")).agg(F.coalesce(F.max(F.col("b_hi_z") - F.col("a_lo_z")), F.lit(0)).cast("long").alias("depth"))


def contacts(objects: DataFrame, cell: int) -> DataFrame:
    """scene, a, b (a < b) of boxes that overlap in all three axes; boxes stand in for meshes."""
    p = pairs(objects, objects, cell).where(F.col("a") < F.col("b"))
    return p.where((_overlap("a", "b", "x") > 0) & (_overlap("a", "b", "y") > 0) & (_overlap("a", "b", "z") > 0)).select("scene", "a", "b")


def new_contacts(after: DataFrame, before: DataFrame, cell: int) -> DataFrame:
    """Contacts after an edit that were not there before it."""
    return contacts(after, cell).join(contacts(before, cell), ["scene", "a", "b"], "left_anti")


def supports(objects: DataFrame, cell: int, ground: int, low: int, high: int, margin: int, reach: int, raised: int) -> DataFrame:
    """scene, obj, support, elevated: objects whose top can take ``obj``.

    The top lies in (ground+low, ground+high], the half extents are at least 1.4 times the object's plus ``margin``,
    the centres are at most ``reach`` apart; elevated if the support's own base is above ground+raised. Everything is
    compared in whole units (fives for the factor 1.4).
    """
    wide_cell = max(cell, 2 * reach)  # so that a support is copied to four cells at most, however far it reaches
    p = _centred(objects, "a", wide_cell).join(_near(objects, "b", wide_cell, reach).hint("merge"), _same_cell("a", "b"))
    top = (F.col("b_hi_z") > ground + low) & (F.col("b_hi_z") <= ground + high)
    wide = lambda axis: 5 * (F.col(f"b_hi_{axis}") - F.col(f"b_lo_{axis}")) >= 7 * (F.col(f"a_hi_{axis}") - F.col(f"a_lo_{axis}")) + 10 * margin
    apart = lambda axis: (F.col(f"a_lo_{axis}") + F.col(f"a_hi_{axis}") - F.col(f"b_lo_{axis}") - F.col(f"b_hi_{axis}")).cast("double")  # whole up to 2^53 when squared
    near = apart("x") * apart("x") + apart("y") * apart("y") <= 4 * reach * reach
    return p.where(top & wide("x") & wide("y") & near).select(F.col("a_scene").alias("scene"), F.col("a").alias("obj"), F.col("b").alias("support"), (F.col("b_lo_z") > ground + raised).alias("elevated"))


def describe_peers(objects: DataFrame, group: list[str], x: str, distance: str) -> DataFrame:
    """``objects`` with ``phrase``: how one of several alike objects can be told apart, null if it can't.

    Alone in its group: ''. Else the only leftmost, rightmost, nearest or farthest, in this order. The extremes and how
    many hold them are aggregates joined back, so a large group is not gathered. Group columns that are null are equal.
    """
    def joined(left: DataFrame, aggs: list[Column]) -> DataFrame:
        right = left.groupBy(*group).agg(*aggs)
        for g in group:
            right = right.withColumnRenamed(g, f"__pl_g_{g}")
        on = F.lit(True)
        for g in group:
            on = on & F.col(g).eqNullSafe(F.col(f"__pl_g_{g}"))
        return left.join(right, on).drop(*[f"__pl_g_{g}" for g in group])

    ends = {"__pl_x0": (F.min, x), "__pl_x1": (F.max, x), "__pl_d0": (F.min, distance), "__pl_d1": (F.max, distance)}
    at = joined(objects, [F.count("*").alias("__pl_n"), *[f(c).alias(e) for e, (f, c) in ends.items()]])
    full = joined(at, [F.count_if(F.col(c) == F.col(e)).alias(f"{e}n") for e, (_, c) in ends.items()])
    only = lambda c, e: (F.col(c) == F.col(e)) & (F.col(f"{e}n") == 1)
    phrase = F.when(F.col("__pl_n") == 1, "").when(only(x, "__pl_x0"), "on the left").when(only(x, "__pl_x1"), "on the right").when(only(distance, "__pl_d0"), "nearest").when(only(distance, "__pl_d1"), "farthest")
    return full.withColumn("phrase", phrase).select(*objects.columns, "phrase")
