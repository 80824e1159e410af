"""Outputs that depend on each other: a failed one stops only what needs it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def at_once(spark: SparkSession, works: Sequence[Callable[[], Any]]) -> list[Any]:
    """Results of works that do not need each other, run side by side: a small table's few tasks keep no core waiting.

    All of them come to an end before the first failure is raised.
    """
    with ThreadPoolExecutor(max(1, len(works))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
    return [done.result() for done in running]


class StepFailed(RuntimeError):
    """An output is not to be trusted. What led to it is stored already."""


@dataclass(frozen=True)
class Step:
    """`work` gets the results of earlier steps by name; `needs` are the steps it cannot do without."""

    name: str
    work: Callable[[dict[str, Any]], Any]
    needs: tuple[str, ...] = ()


@dataclass
class Outcome:
    results: dict[str, Any] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def raise_if_failed(self) -> None:
        if self.failed:
            left_out = f"; not built: {', '.join(self.skipped)}" if self.skipped else ""
            error = StepsFailed("; ".join(self.failed.values()) + left_out)
            error.outcome = self
            raise error


class StepsFailed(RuntimeError):
    """Some steps failed. Everything that does not need them is built; `outcome` has all of it."""

    outcome: Outcome


def run_steps(steps: Sequence[Step]) -> Outcome:
    """Do the steps in the order given, which must list a step after all it needs."""
    outcome = Outcome()
    known: set[str] = set()
    for step in steps:
        if unknown := set(step.needs) - known:
            raise ValueError(f"{step.name} needs {', '.join(sorted(unknown))}, not listed before it")
        known.add(step.name)
        if missing := tuple(n for n in step.needs if n not in outcome.results):
            outcome.skipped[step.name] = missing
            continue
        try:
            outcome.results[step.name] = step.work(outcome.results)
        except StepFailed as error:
            outcome.failed[step.name] = str(error)
    return outcome
