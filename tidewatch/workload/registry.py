"""The register of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources.tables import read_raw
from tidewatch.workload import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables and to the shapes bound onto them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.root, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in bindings.SPARK:
            raise AttributeError(name)
        return bindings.SPARK[name](self)


def query(name: str, sql: str | None = None, uses: str = "") -> Callable:
    """Register a query. ``uses`` names the bound shapes its SQL needs (their definitions are prepended)."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql is not None:
            ORACLES[name] = bindings.with_definitions(sql, uses.split())
        return fn

    return register
