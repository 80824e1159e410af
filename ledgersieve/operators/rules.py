"""Row rules compiled into one array column, so all rules cost a single pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_NONE = "cast(array() AS array<struct<rule_name:string,reason:string>>)"


@dataclass(frozen=True)
class Rule:
    """SQL text over the row: a row breaks the rule when `broken` is true, not when unknown."""

    name: str
    broken: str
    reason: str


def no_findings() -> Column:
    return F.expr(_NONE)


def findings(rules: Sequence[Rule]) -> Column:
    """The broken rules of a row, as (rule_name, reason).

    Built from conditionals, which compile, unlike array lambdas; clean rows skip the list.
    """
    listed = ", ".join(
        f"if({r.broken}, array(named_struct('rule_name', '{r.name}', 'reason', {r.reason})), {_NONE})" for r in rules
    )
    return F.expr(f"if({_any_broken(rules)}, concat({listed}), {_NONE})")


def _any_broken(rules: Sequence[Rule]) -> str:
    return "coalesce(" + " OR ".join(f"({r.broken})" for r in rules) + ", false)"
