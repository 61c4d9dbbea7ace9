"""Gates over samples and objects: thresholds with their reasons, and pools that fall back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default thresholds.
QUALITY = {"min_change_ratio": 0.0, "max_change_ratio": 0.85, "min_sharpness": 3.0, "min_brightness": 10.0, "max_background_diff": 3.0}


def quality_reasons(limits: Mapping[str, float] | None = None, change="change_ratio", sharp="sharpness", bright="brightness", background="background_diff") -> Column:
    """Why a pair fails, joined by ``;`` in the order size, blur, darkness, background; '' if it passes.

    ``limits`` overrides single thresholds. A score that is null, or a column named None, is not judged; NaN is larger
    than any limit, as in Spark's ordering.
    """
    q = QUALITY | dict(limits or {})
    at = lambda name: F.col(name) if name else F.lit(None).cast("double")
    return F.concat_ws(
        ";",
        F.when(at(change) < q["min_change_ratio"], "change_too_small"),
        F.when(at(change) > q["max_change_ratio"], "change_too_large"),
        F.when(at(sharp) < q["min_sharpness"], "too_blurry"),
        F.when(at(bright) < q["min_brightness"], "too_dark"),
        F.when(at(background) > q["max_background_diff"], "background_unstable"),
    )


def screen_flags(op: Column, change: Column, move: Column, placement: Column, factor: Column, dropped: Column, background: Column, brightness: Column) -> Column:
    """array<struct<code, severity>> of the nine screening flags, in their order."""
    flag = lambda cond, code, sev: F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity")))
    moved, scaled = op == "object_move", op == "object_scale"
    return F.array_compact(F.array(
        flag(change < 0.0015, "imperceptible", 3),
        flag(moved & (move > 3), "far_move", 3),
        flag(moved & (move > 2) & ~(move > 3), "long_move", 1),
        flag(moved & placement.isin("ceiling", "wall", "floating"), "odd_placement", 2),
        flag(scaled & (factor != 0) & ((factor > 2.5) | (factor < 0.35)), "extreme_scale", 2),
        flag(dropped != 0, "dropped_objects", 1),
        flag(change > 0.55, "huge_change", 2),
        flag(background > 2, "bg_drift", 2),
        flag(brightness < 15, "dark", 2),
    ))


def max_severity(flags: Column, none: int = 0) -> Column:
    return F.coalesce(F.array_max(F.transform(flags, lambda f: f["severity"])), F.lit(none))


def camera_verdict(visible: Column, area: Column, min_visible: float = 0.1, min_area: float = 0.005, max_area: float = 0.9) -> Column:
    """``occluded``, ``too_small``, ``too_large``, or ok with or without a known area."""
    return F.when(visible < min_visible, "occluded").when(area.isNull(), "area_unchecked").when(area < min_area, "too_small").when(area > max_area, "too_large").otherwise("ok")


def penetrates(floor: Column, obj: Column, op: Column, limit: float = 0.02) -> Column:
    return (F.greatest(F.coalesce(floor, F.lit(0.0)), F.coalesce(obj, F.lit(0.0))) > limit) & (F.coalesce(op, F.lit("")) != "object_delete")


def first_nonempty_pool(df: DataFrame, group: Sequence[str], tests: Sequence[Column]) -> DataFrame:
    """Per group the rows that pass the first test which any row passes; without one, all rows.

    A row's tier is its first passed test; the group's least tier comes from an aggregate with map-side combine and is
    joined back, so no group is sorted or gathered.
    """
    tier = F.lit(len(tests))
    for i, t in reversed(list(enumerate(tests))):
        tier = F.when(F.coalesce(t, F.lit(False)), i).otherwise(tier)
    tiered = df.withColumn("tier", tier)
    best = tiered.groupBy(*group).agg(F.min("tier").alias("__pl_best"))
    return tiered.join(best, list(group)).where("tier = __pl_best").drop("__pl_best")
