"""Named queries: a plan builder over the tables of a folder, and SQL for another engine where it can express the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Builder] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
        def add(fn: Builder) -> Builder:
            if name in self.queries:
                raise ValueError(f"query {name} exists")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return add


core = Registry()
query = core.query
