"""Base instructions of edits from patterns, one of several chosen by a hash of the row.

Missing words read as ``object``; an unknown operation has no instruction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns by case. ref: how the subject is told apart; noun, to, support: nouns; phrase: a direction.
PATTERNS = {
    "object_delete": ("remove the {ref}", "delete the {ref}", "erase the {ref} from the scene"),
    "object_add": ("add a {noun} to the scene", "place a {noun} in the image", "insert a {noun}"),
    "object_add on a support": ("add a {noun} on top of the {support}", "place a {noun} on the {support}", "put a {noun} on the {support}"),
    "object_replace": ("replace the {ref} with a {to}", "swap the {ref} for a {to}", "change the {ref} into a {to}"),
    "object_replace by the same noun": ("replace the {ref} with a different {to}", "swap the {ref} for another {to}", "change the {ref} to a different one"),
    "object_move": ("move the {ref} {phrase}",),
    "object_scale up": ("make the {ref} bigger", "enlarge the {ref}"),
    "object_scale down": ("make the {ref} smaller", "shrink the {ref}"),
    "object_rotate": ("rotate the {ref}", "turn the {ref} around"),
}


def instruction(op: Column, draw: Column, *, ref: Column, noun: Column, to: Column | None = None, support: Column | None = None, phrase: Column | None = None, factor: Column | None = None) -> Column:
    """``draw``: a non-negative whole number that picks the pattern. A factor of 1 or more enlarges."""
    none = F.lit(None).cast("string")
    to, support, phrase, factor = to if to is not None else none, support if support is not None else none, phrase if phrase is not None else none, factor if factor is not None else F.lit(1.0)
    case = (
        F.when((op == "object_add") & (F.coalesce(support, F.lit("")) != ""), "object_add on a support")
        .when((op == "object_replace") & (to == noun), "object_replace by the same noun")
        .when(op == "object_scale", F.when(factor >= 1, "object_scale up").otherwise("object_scale down"))
        .otherwise(op)
    )
    table = F.create_map(*[x for name, ps in PATTERNS.items() for x in (F.lit(name), F.array(*map(F.lit, ps)))])
    options = table[case]
    out = F.get(options, F.pmod(draw, F.size(options)).cast("int"))
    for name, value in (("{ref}", ref), ("{noun}", noun), ("{to}", to), ("{support}", support), ("{phrase}", F.coalesce(phrase, F.lit("slightly")))):
        out = F.replace(out, F.lit(name), F.coalesce(F.nullif(value, F.lit("")), F.lit("object")))
    return out
