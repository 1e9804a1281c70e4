"""Data-quality checks: all rules of a table in one pass, and keys that do not resolve."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows (rule, failed, total). A rule holds where its condition is true; NULL counts as failed."""
    names = list(rules)
    bad = [F.count_if(~F.coalesce(cond, F.lit(False))).alias(f"_r{i}") for i, cond in enumerate(rules.values())]
    one = df.agg(F.count(F.lit(1)).alias("_total"), *bad)
    rows = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("failed"), F.col("_total").alias("total"))
          for i, n in enumerate(names)]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def referential_gaps(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with their row counts. Child rows fold to keys before the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return keys.join(known, key, "left_anti")


def row_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, n_rows) for each table; counts come from the file footers where Spark can use them."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
