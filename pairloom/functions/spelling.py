"""One canonical spelling for each identifier that upstream writers spell in several ways.

All are native column expressions; null stays null, and a value that is blank after trimming becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks at either end, with the invisible ones that survive copy and paste.
_EDGE = r"^[\s\p{Z}\x{200B}\x{FEFF}]+|[\s\p{Z}\x{200B}\x{FEFF}]+$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: Column | str) -> Column:
    """Trimmed and lower-cased; blank becomes null."""
    return F.nullif(F.lower(F.regexp_replace(_c(x), _EDGE, "")), F.lit(""))


def source_name(x: Column | str) -> Column:
    """`` HSSD ``, ``dataset:hssd`` -> ``hssd``."""
    return F.nullif(F.regexp_replace(clean(x), r"^dataset\s*:\s*", ""), F.lit(""))


def edit_op(x: Column | str) -> Column:
    """``OBJECT_ADD``, ``add`` -> ``object_add``."""
    short = F.regexp_replace(clean(x), r"^object[_\s-]*", "")
    return F.when(short != "", F.concat(F.lit("object_"), short))


def version(x: Column | str) -> Column:
    """``pipeline-0.10.0``, ``V0.10.0`` -> ``0.10.0``; without three numbers null."""
    return F.nullif(F.regexp_extract(_c(x), r"(\d+\.\d+\.\d+)", 1), F.lit(""))


def scene_id(x: Column | str) -> Column:
    """``scenes/HS-1A.json``, ``hs_1a``, ``hs-1a.scene_instance.json`` -> ``hs-1a``."""
    name = F.regexp_replace(clean(x), r"^.*[/\\]", "")
    name = F.regexp_replace(name, r"(\.scene_instance)?\.json$", "")
    return F.nullif(F.translate(name, "_", "-"), F.lit(""))


def asset_uid(x: Column | str) -> Column:
    """``objaverse/AB.glb``, ``a-b`` -> ``ab``; a source other than objaverse stays as ``source:id``."""
    name = F.regexp_replace(F.regexp_replace(clean(x), r"\.glb$", ""), r"^objaverse\s*[:/]\s*", "")
    name = F.regexp_replace(name, r"^([a-z0-9]+)\s*[:/]\s*", "$1:")
    return F.nullif(F.translate(name, "-", ""), F.lit(""))


def shard(x: Column | str) -> Column:
    """Batch folder and file name of a shard path, lower-cased; null and blank are no shard."""
    path = F.translate(clean(x), "\\", "/")
    tail = F.regexp_extract(path, r"((?:[^/]+/+)?[^/]+)/*$", 1)
    return F.nullif(F.regexp_replace(tail, r"/+", "/"), F.lit(""))


def job_number(job_id: Column | str, key: Column | str) -> Column:
    """The seven digits of a job id, or of the key where the job id is null."""
    return F.nullif(F.regexp_extract(F.coalesce(_c(job_id), _c(key)), r"(\d{7})", 1), F.lit(""))


def version_rank(v: Column | str) -> Column:
    """A canonical version as ``array<int>``, which orders numerically."""
    return F.transform(F.split(_c(v), r"\."), lambda p: p.cast("int"))
