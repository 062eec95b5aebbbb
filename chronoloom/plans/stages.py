"""Stages with inputs and outputs; a run writes each stage's table and skips what is complete."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Stage:
    name: str
    inputs: tuple[str, ...]
    output: str
    run: Callable[[SparkSession, str], DataFrame]


class Plan:
    """An ordered registry of stages over one warehouse folder."""

    def __init__(self, stages: list[Stage]):
        self.stages = {s.name: s for s in stages}

    def sequence(self, run_all: bool = False, start: str | None = None, only: list[str] | None = None) -> list[Stage]:
        """All stages, those from one on, or exactly the named ones in the order given."""
        names = list(self.stages)
        if only:
            missing = [o for o in only if o not in self.stages]
            if missing:
                raise KeyError(f"no such stages: {missing}")
            return [self.stages[o] for o in only]
        if start:
            if start not in self.stages:
                raise KeyError(f"no such stage: {start}")
            names = names[names.index(start) :]
        elif not run_all:
            raise ValueError("name stages, a first stage, or ask for all")
        return [self.stages[n] for n in names]

    def missing_inputs(self, spark: SparkSession, folder: str, chosen: list[Stage]) -> dict[str, list[str]]:
        """Inputs that neither exist nor are planned before they are needed, by stage."""
        planned: set[str] = set()
        out = {}
        for s in chosen:
            lost = [i for i in s.inputs if i not in planned and not exists(spark, f"{folder}/{i}.parquet")]
            if lost:
                out[s.name] = lost
            planned.add(s.output)
        return out

    def run(self, spark: SparkSession, folder: str, chosen: list[Stage], force: bool = False, dry: bool = False) -> dict[str, str]:
        """What was done with each stage: run, skipped, or planned."""
        if lost := self.missing_inputs(spark, folder, chosen):
            raise FileNotFoundError(f"inputs are missing: {lost}")
        done = {}
        for s in chosen:
            path = f"{folder}/{s.output}.parquet"
            if dry:
                done[s.name] = "planned"
            elif not force and exists(spark, f"{path}/_SUCCESS"):
                done[s.name] = "skipped"
            else:
                s.run(spark, folder).write.mode("overwrite").parquet(path)
                done[s.name] = "run"
        return done


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remaining(tasks: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Tasks whose key isn't stored yet."""
    return tasks.join(stored.select(key).distinct(), key, "left_anti")


def incomplete(requests: DataFrame, results: DataFrame, key: str = "custom_id") -> DataFrame:
    """Requests without a result."""
    return requests.select(key).distinct().join(results.select(key).distinct(), key, "left_anti")
