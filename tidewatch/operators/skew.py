"""Joins and ranks that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def salted_join(
    big: DataFrame, per_key: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "left", salts: int = 16
) -> DataFrame:
    """Join rows to a table with ONE row per key. Each key is served from ``salts`` places.

    The salt is a hash of the row's own columns, never a random number, so a retried task sends its
    rows to the same place.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts).cast("bigint")))
    right = per_key.withColumn("_salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def shuffled(per_entity: DataFrame) -> DataFrame:
    """A table that grows with its entities, marked so that a join shuffles it.

    Spark guesses a table's size from its files, and a few MB of repeating parquet can be a GB in memory; a broadcast would
    put all of it into the driver and into every task. Joins see the mark through projections, filters and folds.
    """
    return per_entity.hint("merge")


def dealt(df: DataFrame, keys: Sequence[str], rows: int, per_task: int) -> DataFrame:
    """Deal rows by key, about ``per_task`` of ``rows`` to a task, before steps that hold a task's rows in memory.

    Spark merges shuffle partitions by their compressed bytes, and rows that compress well may then be a GB to a task; a
    given number of partitions is left as it is. Few rows are dealt without a number.
    """
    n = rows // per_task
    if n < 8:
        return df.repartition(*keys)
    return df.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def global_rank(df: DataFrame, order: Sequence[Column], buckets: Sequence[Column], out: str = "rank") -> DataFrame:
    """Exact 1..n rank over the whole table without sorting it in one task.

    ``buckets`` are ascending expressions that agree with ``order`` (a row in a lower bucket always
    ranks first). Rows are numbered inside their bucket; the offset of a bucket is the running total
    of the counts before it, taken over the small bucket table only.
    """
    names = [f"_b{i}" for i in range(len(buckets))]
    tagged = df.select("*", *[b.alias(n) for b, n in zip(buckets, names)])
    counts = tagged.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy(*names).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(n).alias(f"_o{n}") for n in names], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = tagged.withColumn("_rn", F.row_number().over(W.partitionBy(*names).orderBy(*order)))
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"_o{n}"))
    ranked = inside.join(offsets, cond)
    return ranked.select(*df.columns, (F.col("_offset") + F.col("_rn")).cast("bigint").alias(out))
