"""Named queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    sql: str | None = None


class Catalogue:
    def __init__(self) -> None:
        self.items: dict[str, Query] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
        def add(fn: Builder) -> Builder:
            assert name not in self.items, name
            self.items[name] = Query(fn, sql)
            return fn

        return add
