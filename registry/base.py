"""Registration of queries with the operators they cover and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from registry.views import Tables, expand


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function of :class:`Tables` under its own name."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} registered twice")
        QUERIES[fn.__name__] = Query(fn.__name__, covers, fn, expand(sql) if sql else None)
        return fn

    return add
