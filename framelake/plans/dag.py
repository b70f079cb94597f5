"""Orchestration: a registry of operators over work rows, stages by dependency, error policy, fan-out, pending work.

An operator is a function of a DataFrame of work (`work string`, further columns) that returns rows of RESULT. Stages run
in the order of their dependencies among the enabled operators; results and statuses are rows, and no state is kept on
the driver beyond the list of operators.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.sources.sinks import kept

RESULT = "work string, operator string, status string, outputs array<string>, metrics map<string,string>, errors array<string>, notes array<string>"
STATUSES = ("ok", "error", "skipped", "pending", "fail")


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[DataFrame], DataFrame]
    after: tuple[str, ...] = ()
    collect: Callable[[DataFrame], DataFrame] | None = None
    fan_out: bool = False


@dataclass
class Registry:
    steps: dict[str, Step] = field(default_factory=dict)

    def add(self, step: Step) -> None:
        if step.name in self.steps:
            raise ValueError(f"{step.name} is registered twice")
        self.steps[step.name] = step

    def stages(self, enabled: Iterable[str] | None = None) -> list[list[Step]]:
        return levels([s for n, s in self.steps.items() if enabled is None or n in set(enabled)])


def levels(steps: list[Step]) -> list[list[Step]]:
    """Stages: each step comes after those it depends on, as far as these are enabled. In a circle, the first that is left goes next."""
    names, placed, left, out = {s.name for s in steps}, set(), list(steps), []
    while left:
        ready = [s for s in left if all(a in placed for a in s.after if a in names)] or left[:1]
        out.append(ready)
        placed |= {s.name for s in ready}
        left = [s for s in left if s not in ready]
    return out


def run(registry: Registry, work: DataFrame, enabled: Iterable[str] | None = None, fail_fast: bool = False, parallel: int = 4) -> DataFrame:
    """All results, one row a work item and step (pending ones as collected), with the step's seconds in its metrics.

    A step runs once: its rows are written to the shared folder before results, errors and fan-out read them. Steps of a
    stage are written side by side, up to `parallel` at a time. The outputs of a stage's fan-out steps, of all of them, are
    the work of the stages after it. With fail_fast, items with an error leave later stages.
    """

    def done(step: Step, work: DataFrame) -> DataFrame:
        began = time.monotonic()
        got = kept(step.run(work))
        if step.collect is not None:
            late = got.where("status = 'pending'")
            got = kept(got.where("status <> 'pending'").unionByName(step.collect(late)))
        took = F.map_from_arrays(F.array(F.lit("step_sec")), F.array(F.lit(f"{time.monotonic() - began:.3f}")))
        return got.withColumn("metrics", F.map_concat(F.map_filter("metrics", lambda k, _: k != "step_sec"), took))

    results: DataFrame | None = None
    for stage in registry.stages(enabled):
        with ThreadPoolExecutor(max(1, min(parallel, len(stage)))) as pool:
            all_ = list(pool.map(inheritable_thread_target(work.sparkSession)(done), stage, [work] * len(stage)))
        union = all_[0]
        for got in all_[1:]:
            union = union.unionByName(got)
        results = union if results is None else results.unionByName(union)
        if fail_fast:
            work = work.join(union.where("status = 'error'").select("work").distinct(), "work", "left_anti")
        split = [got.where("status = 'ok'").select(F.explode("outputs").alias("work")) for step, got in zip(stage, all_, strict=True) if step.fan_out]
        if split:
            work = split[0]
            for more in split[1:]:
                work = work.union(more)
            work = work.distinct()
    return results


def report(results: DataFrame) -> DataFrame:
    """Counts by operator; the exit code is 1 if there is an error."""
    return results.groupBy("operator").agg(F.countDistinct("work").alias("items"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "error").alias("errors"), F.count_if(~F.col("status").isin("ok", "error")).alias("other")).withColumn("exit_code", (F.col("errors") > 0).cast("int"))


def result(work: str = "work", operator: str = "", status: str = "'ok'", outputs: str = "array()", errors: str = "array()") -> list:
    """Columns of RESULT by SQL expressions."""
    return [F.expr(f"{work} AS work"), F.lit(operator).alias("operator"), F.expr(f"{status} AS status"), F.expr(f"CAST({outputs} AS array<string>) AS outputs"), F.expr("CAST(map() AS map<string,string>) AS metrics"), F.expr(f"CAST({errors} AS array<string>) AS errors"), F.expr("CAST(array() AS array<string>) AS notes")]
