"""Per-entity history: persistence, latest value, runs, gaps, slopes, rollups.

Every operator here either folds with a map-side combine, or windows over (key, time slice)
so that one entity holding a large share of the rows is spread over its slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.scalars import DAY_US, wall_us

DAY_S = 86_400


def compare(col: Column, op: str, limit: float) -> Column:
    ops = {
        "<": lambda c: c < limit,
        "<=": lambda c: c <= limit,
        ">": lambda c: c > limit,
        ">=": lambda c: c >= limit,
    }
    if op not in ops:
        raise ValueError(f"unknown comparison {op!r}")
    return ops[op](col)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], r_prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{r_prefix}{k}"])
    return cond


def persistent_breach(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    op: str = "<",
    threshold: float = 60.0,
    min_gap_days: int = 90,
    strict: bool = False,
) -> DataFrame:
    """Entities with two breaching values at least ``min_gap_days`` apart.

    A qualifying pair exists exactly when the first and the last breach are that far apart, so one
    aggregate replaces the self-join. With ``strict`` a normal value in between starts a new run.
    """
    hit = compare(F.col(value), op, threshold)
    day = F.col(time).cast("date")
    summary = [
        F.count(F.lit(1)).alias("n_breach"),
        F.min(day).alias("first_breach"),
        F.max(day).alias("last_breach"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    ]
    wide_enough = F.datediff("last_breach", "first_breach") >= min_gap_days
    if not strict:
        return df.where(hit).groupBy(key).agg(*summary).where(wide_enough)

    from tidewatch.operators.matching import asof_join

    normal = df.where(F.col(value).isNotNull() & ~hit).select(
        key, F.col(time).cast("date").cast("timestamp_ntz").alias("_normal_at")
    )
    breaches = df.where(hit).select(key, value, day.cast("timestamp_ntz").alias("_at"))
    anchored = asof_join(
        breaches, normal, [key], "_at", "_normal_at", {"_run_anchor": F.col("_normal_at")},
        direction="backward", tolerance_s=None, slice_s=90 * DAY_S,
    )
    at = F.col("_at").cast("date")
    runs = anchored.groupBy(key, "_run_anchor").agg(
        F.count(F.lit(1)).alias("n_breach"),
        F.min(at).alias("first_breach"),
        F.max(at).alias("last_breach"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    ).where(wide_enough)
    return runs.groupBy(key).agg(
        F.sum("n_breach").alias("n_breach"),
        F.min("first_breach").alias("first_breach"),
        F.max("last_breach").alias("last_breach"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` columns per key. ``row_number() = 1`` lets Spark drop all but
    one row per key before the shuffle (window group limit), so a hot key costs nothing extra."""
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key; the same group limit runs before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def history_summary(df: DataFrame, key: str, time: str, value: str, tie: str) -> DataFrame:
    """One row per entity: count, range, first, latest and lowest value. Fixed size whatever the history."""
    t, v = F.col(time), F.col(value)
    at = F.struct(t, F.col(tie))
    return df.where(v.isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.min(t).alias("first_date"),
        F.max(t).alias("latest_date"),
        F.min_by(v, at).alias("first_value"),
        F.max_by(v, at).alias("latest_value"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
    )


def trend_slope(
    df: DataFrame, key: str, time: str, value: str, min_points: int = 3, min_span_days: int = 90
) -> DataFrame:
    """Least-squares change per year; NULL where there are too few points or too short a span."""
    days = F.unix_date(F.col(time).cast("date"))
    g = df.where(F.col(value).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_points"),
        (F.max(days) - F.min(days)).alias("span_days"),
        F.regr_slope(F.col(value), days / F.lit(365.25)).alias("_slope"),
    )
    enough = (F.col("n_points") >= min_points) & (F.col("span_days") >= max(min_span_days, 1))
    return g.select(key, "n_points", "span_days", F.when(enough, F.col("_slope")).alias("slope_per_year"))


def consecutive_runs(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Unbroken runs of calendar days per key.

    Days are made distinct first (combined map-side), so a key holds at most one row per calendar day.
    """
    days = df.select(*keys, F.col(date).cast("date").alias("_day")).distinct()
    w = W.partitionBy(*keys).orderBy("_day")
    island = F.date_sub(F.col("_day"), F.row_number().over(w))
    return (
        days.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(
            F.min("_day").alias("run_start"),
            F.max("_day").alias("run_end"),
            F.count(F.lit(1)).alias("run_days"),
        )
        .drop("_island")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], cols: Mapping[str, str], slice_s: int = DAY_S
) -> DataFrame:
    """Add values of the previous row of the same key, ordered by (time, tie).

    ``cols`` maps a source column to the new column. The window runs per (key, time slice); the first
    row of a slice takes the last row of the nearest earlier slice from a one-row-per-slice summary.
    Choose the slice so that a busy key fills many of them and a quiet key has several rows in one.
    """
    cut = F.floor(wall_us(time) / F.lit(slice_s * 1_000_000)).cast("bigint")
    sliced = df.withColumn("_slice", cut).withColumn("_row", F.struct(*[F.col(s).alias(d) for s, d in cols.items()]))
    order = [F.col(time), *[F.col(t) for t in tie]]
    w = W.partitionBy(*keys, "_slice").orderBy(*order)
    inside = sliced.withColumn("_prev", F.lag("_row").over(w)).withColumn("_first", F.row_number().over(w) == 1)

    last_of = sliced.groupBy(*keys, "_slice").agg(F.max_by("_row", F.struct(*order)).alias("_last"))
    wk = W.partitionBy(*keys).orderBy("_slice")
    carry = last_of.withColumn("_carry", F.lag("_last").over(wk)).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_k_slice"), "_carry"
    )
    cond = same_key(inside, carry, keys, "_k_") & (inside["_slice"] == carry["_k_slice"])
    joined = inside.join(carry, cond, "left")
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))
    return joined.select(*[F.col(c) for c in df.columns], *[prev[d].alias(d) for d in cols.values()])


def previous_gap(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    tie: Sequence[str],
    extra: Mapping[str, str] | None = None,
    slice_s: int = DAY_S,
) -> DataFrame:
    """Hours between the end of the previous interval and the start of this one."""
    cols = {end: "prev_end", **(extra or {})}
    out = with_previous(df, keys, start, tie, cols, slice_s)
    return out.withColumn("gap_hours", (wall_us(start) - wall_us("prev_end")) / F.lit(3_600_000_000.0))


def trailing_rollup(
    df: DataFrame, keys: Sequence[str], time: str, as_of: str, months: int, aggs: Sequence[Column]
) -> DataFrame:
    """Aggregate rows in ``(as_of - months, as_of]``; both limits are literals and reach the scan."""
    end = F.lit(as_of).cast("date")
    t = F.col(time)
    return df.where((t > F.add_months(end, -months)) & (t <= end)).groupBy(*keys).agg(*aggs)


def recently_active(df: DataFrame, activity: DataFrame, key: str, time: str, as_of: str, days: int) -> DataFrame:
    """Keep entities with activity in the last ``days`` days before ``as_of``."""
    end = F.lit(as_of).cast("date")
    t = F.col(time)
    seen = activity.where((t > F.date_sub(end, days)) & (t <= end)).select(key).distinct()
    return df.join(seen, key, "left_semi")
