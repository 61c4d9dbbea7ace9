"""The edit operators: their parameters, the gates that discard a subject, and the instruction and record of each edit.

A subject is a row with noun, category, phrase (how it is told apart: '' if its noun is enough, null if it can't be),
to_noun, support_noun and words (the directions of a move). A draw, a whole number, makes all choices, so an edit can be
made again. Missing words read as ``object``; a subject that a gate discards has no instruction.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import geometry, instructions, text

#: How many steps a draw is cut into where it stands for a share.
STEPS = 10_000


def gate(name: str) -> Column:
    """Whether a subject is discarded: it is ambiguous, part of a wall by category or noun, or a floor covering."""
    return {
        "ambiguous": F.col("phrase").isNull(),
        "wall_integrated": text.is_wall_integrated("category") | text.is_wall_integrated("noun"),
        "floor_cover": text.is_floor_cover("noun"),
    }[name]


def told_apart(noun: Column, phrase: Column) -> Column:
    """``nearest chair``, ``chair on the left``, ``chair``."""
    return F.when(phrase.isin("nearest", "farthest"), F.concat_ws(" ", phrase, noun)).when(phrase != "", F.concat_ws(" ", noun, phrase)).otherwise(noun)


@dataclass(frozen=True)
class EditOperator:
    name: str
    defaults: Mapping[str, Any] = field(default_factory=dict)
    gates: tuple[str, ...] = ()
    params: Mapping[str, Any] = field(default_factory=dict)

    def prepare(self, **params: Any) -> EditOperator:
        """The operator with parameters: unknown names, negative numbers and ranges the wrong way round are errors."""
        for k, v in params.items():
            if k not in self.defaults:
                raise ValueError(f"{self.name} has no parameter {k}; there are: {', '.join(sorted(self.defaults))}")
            if isinstance(v, (int, float)) and v < 0 or k.endswith("_range") and v[0] > v[1]:
                raise ValueError(f"{self.name}: {k} can't be {v}")
        return replace(self, params=dict(self.params) | params)

    def _of(self, name: str) -> Any:
        return self.params.get(name, self.defaults[name])

    def meta(self, draw: Column) -> dict[str, Column]:
        """What the record tells besides the operation: a factor that is far enough from 1, degrees within bounds, strategies."""
        share = F.pmod(draw, F.lit(STEPS)) / F.lit(float(STEPS))
        if self.name == "object_scale":
            low, high = self._of("scale_range")
            far = [float(c) for c in self._of("scale_choices") if low <= c <= high and abs(c - 1) >= self._of("min_factor_delta")]
            factor = F.element_at(F.array(*map(F.lit, far)), (F.pmod(draw, F.lit(len(far))) + 1).cast("int")) if far else F.lit(None).cast("double")
            return {"factor": factor, "factor_is_round": F.lit(bool(far))}
        if self.name == "object_rotate":
            low, high = float(self._of("min_degrees")), float(self._of("max_degrees"))
            axes = list(self._of("axes"))
            return {"degrees": F.bround((low + share * (high - low)) * F.when(F.pmod(draw, F.lit(2)) == 0, 1).otherwise(-1), 2), "axis": F.element_at(F.array(*map(F.lit, axes)), (F.pmod(draw, F.lit(len(axes))) + 1).cast("int"))}
        if self.name == "object_add":
            return {"strategy": F.when(F.lit(bool(self._of("prefer_on_object"))) & F.col("support_noun").isNotNull(), "surface").otherwise("scene_build")}
        return {}

    def apply(self, subjects: DataFrame, draw: Column) -> DataFrame:
        """``subjects`` with op, discard (the first gate that discards, else null), instruction and meta (JSON)."""
        discard = F.coalesce(*[F.when(gate(g), g) for g in self.gates]) if self.gates else F.lit(None).cast("string")
        meta = self.meta(draw)
        to = F.coalesce(F.nullif("to_noun", F.lit("")), F.lit("object"))
        said = instructions.instruction(
            F.lit(self.name), draw, ref=told_apart(F.col("noun"), F.coalesce("phrase", F.lit(""))), noun=F.col("noun"), to=to, support=F.col("support_noun") if self.name == "object_add" else None,
            phrase=geometry.direction_phrase(F.col("words")), factor=meta.get("factor"),
        )
        record = F.to_json(F.struct(F.lit(self.name).alias("op"), F.col("noun"), *[c.alias(k) for k, c in meta.items()]))
        out = subjects.withColumns({"op": F.lit(self.name), "discard": discard})
        kept = F.col("discard").isNull()
        return out.withColumns({"instruction": F.when(kept, said), "meta": F.when(kept, record)})


# The operators' parameters with their defaults, and their gates in order.
OPERATORS = {
    o.name: o
    for o in (
        EditOperator("object_move", {"min_distance": 0.8, "min_visible_area": 0.004}, ("ambiguous", "wall_integrated")),
        EditOperator("object_scale", {"scale_range": (0.5, 1.8), "min_factor_delta": 0.25, "scale_choices": (0.5, 0.75, 1.25, 1.5), "continuous_fraction": 0.3}, ("ambiguous",)),
        EditOperator("object_rotate", {"max_degrees": 180, "min_degrees": 15, "axes": "XYZ", "continuous_fraction": 0.3}, ("ambiguous", "wall_integrated")),
        EditOperator("object_delete", {}, ("ambiguous",)),
        EditOperator("object_add", {"spawn": False, "prefer_on_object": True}),
        EditOperator("object_replace", {"same_category_prob": 0.0, "min_new_visible_area": 0.01}, ("ambiguous", "wall_integrated", "floor_cover")),
    )
}
