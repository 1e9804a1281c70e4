"""Reading, writing and naming tables. Parquet folders under one root, or catalog tables."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewatch.session import scratch_path
from tidewatch.sources import schemas


@dataclass(frozen=True)
class TableRef:
    """``<root>/<prefix>_<name>``: one place that knows how table names are put together."""

    root: str
    prefix: str
    name: str

    @property
    def table(self) -> str:
        return f"{self.prefix}_{self.name}" if self.prefix else self.name

    @property
    def path(self) -> str:
        return os.path.join(self.root, self.table)


def read(spark: SparkSession, root: str, table: str, stored_as: str | None = None) -> DataFrame:
    """A source table with its fixed schema (no inference). ``stored_as`` names a differently named folder."""
    return spark.read.schema(schemas.schema(table)).parquet(os.path.join(root, stored_as or table))


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A single-file table ``<root>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))


def write(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite"
) -> None:
    """Write parquet. Partition by the period or year that queries select, so scans can skip the rest."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_audit(df: DataFrame, path: str) -> None:
    """Audit rows are only ever added."""
    write(df, path, mode="append")


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write, then read back with the same schema: cuts the lineage and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """A ``stage(df, name)`` hook that keeps intermediate tables in one new folder of the shared scratch folder.

    ``drop`` removes tables once what was made from them is stored, and has the driver collect garbage, upon which Spark
    removes the shuffle files of plans that nothing refers to any more; what a returned frame still reads stays until the cluster
    clears its checkpoint folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, os.path.join(self.base, name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(os.path.join(self.base, name) if name else self.base)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()

    def end(self) -> None:
        """Remove all tables of this folder, once nothing that is returned reads them."""
        self.drop("")


def staging(spark: SparkSession, label: str) -> Staging:
    return Staging(spark, label)


def rows_to_frame(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Small literal rows (rules, fixtures) with an explicit schema, so an empty list works too."""
    return spark.createDataFrame(list(rows), schema)


def register_views(spark: SparkSession, root: str, tables: Sequence[str]) -> list[str]:
    """Make tables available to SQL by name; returns the names now listed in the catalog."""
    for t in tables:
        path = os.path.join(root, t)
        df = read(spark, root, t) if t in schemas.TABLE_NAMES and os.path.isdir(path) else read_raw(spark, root, t)
        df.createOrReplaceTempView(t)
    listed = {t.name for t in spark.catalog.listTables()}
    return [t for t in tables if t in listed]
