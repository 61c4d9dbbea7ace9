"""Vectors, cameras, rotations and projected boxes as native column expressions over ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """Length; 0 for null and empty."""
    return F.coalesce(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)), F.lit(0.0))


def unit(v: Column) -> Column:
    """Length 1; a vector of (almost) no length stays."""
    n = norm(v)
    return F.when(n > 1e-9, F.transform(v, lambda x: x / n)).otherwise(v)


def camera_basis(m: Column) -> Column:
    """struct<right, up, forward> of a 4x4 camera matrix (rows): columns 0 and 1, and the opposite of column 2."""
    column = lambda j, sign: unit(F.transform(F.slice(m, 1, 3), lambda r: r[j] * sign))
    return F.struct(column(0, 1.0).alias("right"), column(1, 1.0).alias("up"), column(2, -1.0).alias("forward"))


def direction_words(delta: Column, right: Column, up: Column, forward: Column, share: float = 0.15, most: int = 2) -> Column:
    """At most two words for a move as the camera sees it, the largest part first; of equal parts the later word of the alphabet."""
    length = F.when(norm(delta) > 0, norm(delta)).otherwise(1e-9)
    part = lambda axis, plus, minus: F.transform(F.array(dot(delta, unit(axis))), lambda d: F.struct((F.abs(d) / length).alias("r"), F.when(d > 0, plus).otherwise(minus).alias("w")))[0]
    parts = F.array(part(right, "right", "left"), part(up, "up", "down"), part(forward, "farther", "closer"))
    kept = F.filter(F.sort_array(parts, asc=False), lambda p: p["r"] >= share)
    return F.slice(F.transform(kept, lambda p: p["w"]), 1, most)


def camera_components(delta: Column, right: Column, up: Column, forward: Column) -> Column:
    at = lambda axis: F.bround(dot(delta, unit(axis)), 4)
    return F.struct(at(right).alias("right"), at(up).alias("up"), at(forward).alias("forward"))


# How a direction is said.
PLANAR = ("left", "right", "up", "down")
SAID = {"closer": "closer to the camera", "farther": "away from the camera"}


def direction_phrase(words: Column) -> Column:
    said = F.transform(words, lambda w: F.when(w == "closer", SAID["closer"]).when(w == "farther", SAID["farther"]).otherwise(w))
    planar = F.forall(words, lambda w: w.isin(*PLANAR))
    return (
        F.when(words.isNull() | (F.size(words) == 0), "slightly")
        .when(planar, F.concat(F.lit("to the "), F.concat_ws(" ", F.reverse(words))))
        .otherwise(F.concat_ws(", ", said))
    )


def direction_consistent(words: Column, dx: Column, dy: Column) -> Column:
    """Whether the pixel move agrees with every planar word (y points down); depth words and no words agree."""
    return F.forall(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.when(w == "left", dx < 0).when(w == "right", dx > 0).when(w == "up", dy < 0).when(w == "down", dy > 0).otherwise(F.lit(True)))


def axis_angle_quat(axis: Column, degrees: Column) -> Column:
    half = F.radians(degrees) / 2
    return F.concat(F.array(F.cos(half)), F.transform(unit(axis), lambda a: a * F.sin(half)))


def quat_matrix(q: Column) -> Column:
    """3x3 rows of a quaternion (w, x, y, z); a zero quaternion is divided by 1."""
    n = F.when(norm(q) == 0, 1.0).otherwise(norm(q))
    w, x, y, z = (q[i] / n for i in range(4))
    row = lambda *c: F.array(*c)
    return F.array(
        row(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        row(2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        row(2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )


def view_change(axis: Column, degrees: Column) -> Column:
    turned = F.pmod(F.abs(degrees), F.lit(360.0))
    d = F.when(turned > 180, 360 - turned).otherwise(turned)
    return F.when(axis != "Z", "tipped").when(d >= 135, "opposite_side").when(d >= 45, "side_face").otherwise("partial_turn")


def turn_direction(degrees: Column, axis_dot_view: Column, sure: float = 0.7) -> Column:
    return F.when(F.abs(axis_dot_view) >= sure, F.when(degrees * axis_dot_view > 0, "clockwise").otherwise("counterclockwise"))


def floor_depth(floor: Column, lo_z: Column) -> Column:
    return F.greatest(F.lit(0), floor - lo_z)


def match_scale(reference: Column, longest: Column, most: float = 1.5) -> Column:
    """The factor that brings an object's longest side to the reference's, itself at most ``most``."""
    return F.least(reference, F.lit(most)) / F.when(longest == 0, 1e-6).otherwise(longest)


def clipped(lo: Column, hi: Column, size: Column) -> Column:
    """The length of [lo, hi] inside [0, size]."""
    return F.greatest(F.least(hi, size) - F.greatest(lo, F.lit(0)), F.lit(0))


def area_ratio(x0: Column, y0: Column, x1: Column, y1: Column, w: Column, h: Column) -> Column:
    """The share of the image that a box covers."""
    return (clipped(x0, x1, w) * clipped(y0, y1, h)).cast("double") / (w * h)


def projected_change(a: tuple[Column, ...], b: tuple[Column, ...], w: Column, h: Column) -> Column:
    """(union - intersection) of two clipped boxes as a share of the image."""
    area = lambda p: clipped(p[0], p[2], w) * clipped(p[1], p[3], h)
    both = clipped(F.greatest(a[0], b[0]), F.least(a[2], b[2]), w) * clipped(F.greatest(a[1], b[1]), F.least(a[3], b[3]), h)
    return (area(a) + area(b) - 2 * both).cast("double") / (w * h)


# followers of a changed object; the pose is a snapshot [x, y, z] taken before the change
def follow_move(pose: Column, delta: Column) -> Column:
    return F.zip_with(pose, delta, lambda p, d: p + d)


def follow_drop(pose: Column, dz: Column) -> Column:
    return F.array(pose[0], pose[1], pose[2] - dz)


def follow_scale(pose: Column, centre: Column, factor: Column, dz: Column) -> Column:
    return F.array(centre[0] + (pose[0] - centre[0]) * factor, centre[1] + (pose[1] - centre[1]) * factor, pose[2] - dz)


def follow_turn(pose: Column, centre: Column, degrees: Column) -> Column:
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    x, y = pose[0] - centre[0], pose[1] - centre[1]
    return F.array(centre[0] + x * c - y * s, centre[1] + x * s + y * c, pose[2])


def rounded_pose(location: Column, rotation: Column, quat: Column) -> Column:
    """A pose as it is written down: four decimals, six for the quaternion, half to even."""
    to = lambda v, n: F.transform(v, lambda x: F.bround(x, n))
    return F.struct(to(location, 4).alias("location"), to(rotation, 4).alias("rotation_euler"), to(quat, 6).alias("rotation_quat"))
