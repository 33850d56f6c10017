"""Queries by name, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


class Registry(dict[str, Query]):
    def add(self, name: str, sql: str | None = None) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            if name in self:
                raise ValueError(f"{name} is registered twice")
            self[name] = Query(run, sql)
            return run

        return register
