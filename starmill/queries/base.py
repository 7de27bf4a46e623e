"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[name] = query
            if sql is not None:
                self.oracles[name] = sql
            return query

        return keep


REGISTRY = Registry()
query = REGISTRY.add


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")
