"""Governed metrics: defined once, evaluated at any grain. Ratios are ratios of sums at every grain."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import cents


@dataclass(frozen=True)
class Sketch:
    """A part that is no sum: ``first`` folds rows to a sketch of bounded size, ``again`` folds sketches to one."""

    first: Column
    again: Callable[[str], Column]


@dataclass(frozen=True)
class Metric:
    """``parts`` are additive per-row amounts (summed at the grain) or sketches; ``value`` combines what they fold to."""

    name: str
    parts: Mapping[str, Column | Sketch]
    value: Column


def count_of(name: str, when: Column | None = None) -> Metric:
    one = F.lit(1) if when is None else F.when(when, 1).otherwise(0)
    return Metric(name, {f"{name}__n": one.cast("bigint")}, F.col(f"{name}__n"))


def money_of(name: str, amount: Column) -> Metric:
    return Metric(name, {f"{name}__cents": cents(amount)}, F.col(f"{name}__cents") / F.lit(100.0))


def ratio_of(name: str, num: Column, den: Column, scale: float = 1.0) -> Metric:
    top, bottom = f"{name}__num", f"{name}__den"
    return Metric(
        name, {top: num, bottom: den}, F.when(F.col(bottom) != 0, F.lit(scale) * F.col(top) / F.col(bottom))
    )


def percent_of(name: str, when: Column) -> Metric:
    hit = F.when(when, 1).otherwise(0).cast("bigint")
    return ratio_of(name, hit, F.lit(1).cast("bigint"), 100.0)


def mean_of(name: str, value: Column) -> Metric:
    known = F.when(value.isNotNull(), 1).otherwise(0).cast("bigint")
    return ratio_of(name, F.coalesce(value, F.lit(0)), known)


def distinct_of(name: str, key: Column, lg_size: int = 12) -> Metric:
    """Number of distinct keys (integers or strings) by a HyperLogLog sketch, at any grain from the finest one. Its relative
    standard error is about 1.04 / sqrt(2 ** lg_size), 1.6 % by default."""
    part = f"{name}__hll"
    sketch = Sketch(F.hll_sketch_agg(key, F.lit(lg_size)), lambda p: F.hll_union_agg(p))
    return Metric(name, {part: sketch}, F.hll_sketch_estimate(part))


def quantile_of(name: str, value: Column, q: float, k: int = 200) -> Metric:
    """A quantile by a KLL sketch, at any grain from the finest one. Its rank is off by about 1.33 % for k = 200."""
    part = f"{name}__kll"
    sketch = Sketch(F.kll_sketch_agg_double(value.cast("double"), F.lit(k)), lambda p: F.kll_merge_agg_double(p))
    return Metric(name, {part: sketch}, F.when(F.kll_sketch_get_n_double(part) > 0, F.kll_sketch_get_quantile_double(part, F.lit(q))))


def _sums(df: DataFrame, metrics: Sequence[Metric], dims: Sequence[str]) -> DataFrame:
    folded = [(c.first if isinstance(c, Sketch) else F.sum(c)).alias(p) for m in metrics for p, c in m.parts.items()]
    return df.groupBy(*dims).agg(*folded)


def evaluate(df: DataFrame, metrics: Sequence[Metric], dims: Sequence[str]) -> DataFrame:
    return _sums(df, metrics, dims).select(*dims, *[m.value.alias(m.name) for m in metrics])


def evaluate_cube(df: DataFrame, metrics: Sequence[Metric], dims: Sequence[str]) -> DataFrame:
    """All grain combinations. The facts are folded to the finest grain once; only that is cubed, so the
    2^n row expansion never touches the facts. ``grain`` = grouping id, telling totals from NULL values."""
    finest = _sums(df, metrics, dims)
    again = [(c.again(p) if isinstance(c, Sketch) else F.sum(p)).alias(p) for m in metrics for p, c in m.parts.items()]
    cubed = finest.cube(*dims).agg(*again, F.grouping_id().cast("int").alias("grain"))
    return cubed.select(*dims, "grain", *[m.value.alias(m.name) for m in metrics])


def heatmap(df: DataFrame, row: str, col: str, values: Sequence[str], metric: Metric) -> DataFrame:
    """Rows by columns. Folded to the cell grain first; the pivot then only lays out the cells."""
    cells = evaluate(df, [metric], [row, col])
    return cells.groupBy(row).pivot(col, list(values)).agg(F.first(metric.name))
