"""Declarative rule tables that become ``when`` chains, so they stay inside whole-stage codegen."""

from __future__ import annotations

import operator
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "==": operator.eq,
}


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Rules:
    """Ordered ``(comparison, cut, result)`` steps; the first step that holds wins.

    A NULL input matches no step and so takes ``otherwise``.
    """

    steps: tuple[tuple[str, object, object], ...]
    otherwise: object = None

    def on(self, value: str | Column) -> Column:
        value = as_column(value)
        chain = None
        for compare, cut, result in self.steps:
            condition = _COMPARE[compare](value, F.lit(cut))
            chain = F.when(condition, F.lit(result)) if chain is None else chain.when(condition, F.lit(result))
        fallback = F.lit(self.otherwise)
        return fallback if chain is None else chain.otherwise(fallback)


@dataclass(frozen=True)
class Scorecard:
    """Named inputs with one rule table each; the score is the sum of the points."""

    parts: dict[str, Rules]
    base: float = 0
    inputs: dict[str, str] = field(default_factory=dict)

    def total(self) -> Column:
        score = F.lit(self.base)
        for name, rules in self.parts.items():
            score = score + rules.on(self.inputs.get(name, name))
        return score


def weighted_sum(weights: dict[str, float]) -> Column:
    """Sum of ``weight * column`` where NULL counts as zero."""
    total = F.lit(0)
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name), F.lit(0)) * F.lit(weight)
    return total


def flag_sum(columns: list[str]) -> Column:
    """Number of set flags in a row; NULL counts as not set."""
    return weighted_sum({name: 1 for name in columns})


def clamp(value: str | Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; NULL stays NULL."""
    value = as_column(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))
