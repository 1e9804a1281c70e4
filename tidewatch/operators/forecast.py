"""Per-series forecasts from aggregates: a linear trend, and a trend with Fourier terms by its normal equations."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def linear_forecast(
    df: DataFrame, keys: Sequence[str], seq: str, y: str, horizon: int, floor: float = 0.0, width: float = 1.96
) -> DataFrame:
    """Trend of ``y`` over ``seq`` per key, continued ``horizon`` steps past the key's last point.

    Rows without a value or a seq are left out. A series of one point (or one seq) repeats its last value. The band comes from the residual
    standard deviation and needs three points.
    """
    x, v = F.col(seq).cast("double"), F.col(y).cast("double")
    fit = df.where(v.isNotNull() & x.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.max(seq).alias("_last"),
        F.max_by(v, F.col(seq)).alias("_last_y"),
        F.regr_slope(v, x).alias("_slope"),
        F.regr_intercept(v, x).alias("_intercept"),
        F.regr_sxx(v, x).alias("_sxx"),
        F.regr_sxy(v, x).alias("_sxy"),
        F.regr_syy(v, x).alias("_syy"),
    )
    line = (F.col("n_points") >= 2) & (F.col("_sxx") > 0)
    left_over = F.greatest(F.col("_syy") - F.col("_slope") * F.col("_sxy"), F.lit(0.0))
    sd = F.when(line & (F.col("n_points") >= 3), F.sqrt(left_over / (F.col("n_points") - 2)))
    steps = F.sequence(F.col("_last") + F.lit(1), F.col("_last") + F.lit(horizon))
    out = fit.withColumn("_sd", sd).withColumn(seq, F.explode(steps))
    at = F.when(line, F.col("_intercept") + F.col("_slope") * F.col(seq)).otherwise(F.col("_last_y"))

    def band(k: float) -> Column:
        edge = F.greatest(at + F.lit(k) * F.col("_sd"), F.lit(floor))  # greatest() alone would skip a NULL
        return F.when(F.col("_sd").isNotNull(), edge)

    return out.select(
        *keys,
        F.col(seq),
        F.greatest(at, F.lit(floor)).alias("forecast"),
        band(-width).alias("lower"),
        band(width).alias("upper"),
        "n_points",
    )


def backtest(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], seq: str, y: str) -> DataFrame:
    """Mean absolute error, and percentage error over the points with a non-zero actual."""
    j = forecast.select(*keys, seq, "forecast").join(actual.select(*keys, seq, y), [*keys, seq])
    err = F.abs(F.col("forecast") - F.col(y))
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_held_out"),
        F.avg(err).alias("mae"),
        F.avg(F.when(F.col(y) != 0, err / F.abs(F.col(y)))).alias("mape"),
    )


def _basis(x: Column, period: float, harmonics: int) -> list[Column]:
    """Constant, trend, and one cosine and sine for each harmonic of the period."""
    turn = x * F.lit(2.0 * math.pi / period)
    waves = [f(turn * F.lit(float(h))) for h in range(1, harmonics + 1) for f in (F.cos, F.sin)]
    return [F.lit(1.0), x / F.lit(float(period)), *waves]


def _solved(sums: DataFrame, size: int) -> DataFrame:
    """Solve the normal equations held in ``_m_i_j`` (column ``size`` is the right side): coefficients ``_c_i``.

    ``_full`` is false where the columns of a series depend on each other. Every pivot step is a projection of its own, so
    no expression is written out twice.
    """
    m = lambda i, j: F.col(f"_m_{i}_{j}")
    first = {f"_d_{i}": m(i, i) for i in range(size)}
    cur = sums.withColumns({**first, "_full": F.lit(True)})
    for k in range(size):
        cur = cur.withColumn("_full", F.col("_full") & (m(k, k) > F.lit(1e-9) * F.col(f"_d_{k}")))
        cur = cur.withColumns({f"_f_{i}": F.try_divide(m(i, k), m(k, k)) for i in range(size) if i != k})
        cur = cur.withColumns({f"_m_{i}_{j}": m(i, j) - F.col(f"_f_{i}") * m(k, j) for i in range(size) if i != k for j in range(k, size + 1)})
    return cur.withColumns({f"_c_{i}": F.try_divide(m(i, size), m(i, i)) for i in range(size)})


def seasonal_forecast(
    df: DataFrame, keys: Sequence[str], seq: str, y: str, horizon: int, period: float, harmonics: int = 1, floor: float = 0.0,
    width: float = 1.96,
) -> DataFrame:
    """Trend plus Fourier terms of ``y`` over ``seq`` per key, continued ``horizon`` steps past the key's last point.

    A series needs two periods and more points than terms; a shorter one, or one whose terms depend on each other, gets the
    linear trend (``method`` says which). Rows without a value or a seq are left out. A series is one group, as long as its
    calendar; all of it is sums, so one aggregate fits all series.
    """
    size = 2 + 2 * harmonics
    rows = df.where(F.col(y).isNotNull() & F.col(seq).isNotNull()).select(*keys, F.col(seq), F.col(y).cast("double").alias("_y"))
    # Counted from the series' first point: large seq numbers would cost digits.
    rows = rows.withColumn("_from", F.min(seq).over(W.partitionBy(*keys)))
    rows = rows.withColumn("_x", (F.col(seq) - F.col("_from")).cast("double"))
    terms = [f"_b_{i}" for i in range(size)]
    rows = rows.withColumns(dict(zip(terms, _basis(F.col("_x"), period, harmonics), strict=True)))
    moments = [F.sum(F.col(terms[i]) * F.col(terms[j])).alias(f"_m_{i}_{j}") for i in range(size) for j in range(size)]
    right = [F.sum(F.col(terms[i]) * F.col("_y")).alias(f"_m_{i}_{size}") for i in range(size)]
    fit = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"), F.min("_from").alias("_from"), F.max(seq).alias("_last"), F.max("_x").alias("_span"),
        F.max_by("_y", F.col(seq)).alias("_last_y"), F.regr_slope("_y", "_x").alias("_slope"), F.regr_intercept("_y", "_x").alias("_intercept"),
        F.regr_sxx("_y", "_x").alias("_sxx"), F.regr_sxy("_y", "_x").alias("_sxy"), F.regr_syy("_y", "_x").alias("_syy"),
        F.sum(F.col("_y") * F.col("_y")).alias("_yy"), *moments, *right,
    )
    keep_right = fit.withColumns({f"_r_{i}": F.col(f"_m_{i}_{size}") for i in range(size)})
    solved = _solved(keep_right, size)
    seasonal = (F.col("n_points") > size) & (F.col("_span") + 1 >= 2 * period) & F.col("_full")
    line = (F.col("n_points") >= 2) & (F.col("_sxx") > 0)
    explained = sum((F.col(f"_c_{i}") * F.col(f"_r_{i}") for i in range(size)), F.lit(0.0))
    sse = F.when(seasonal, F.col("_yy") - explained).otherwise(F.col("_syy") - F.col("_slope") * F.col("_sxy"))
    free = F.col("n_points") - F.when(seasonal, size).otherwise(2)
    solved = solved.withColumn("_seasonal", seasonal).withColumn(
        "_sd", F.when((F.col("_seasonal") | line) & (free >= 1), F.sqrt(F.greatest(sse, F.lit(0.0)) / free))
    )
    out = solved.withColumn(seq, F.explode(F.sequence(F.col("_last") + F.lit(1), F.col("_last") + F.lit(horizon))))
    x = (F.col(seq) - F.col("_from")).cast("double")
    wave = sum((F.col(f"_c_{i}") * b for i, b in enumerate(_basis(x, period, harmonics))), F.lit(0.0))
    at = F.when(F.col("_seasonal"), wave).when(line, F.col("_intercept") + F.col("_slope") * x).otherwise(F.col("_last_y"))
    out = out.withColumn("_at", at)
    edge = lambda k: F.when(F.col("_sd").isNotNull(), F.greatest(F.col("_at") + F.lit(k) * F.col("_sd"), F.lit(floor)))
    return out.select(
        *keys, F.col(seq), F.greatest("_at", F.lit(floor)).alias("forecast"), edge(-width).alias("lower"), edge(width).alias("upper"),
        "n_points", F.when(F.col("_seasonal"), "seasonal").otherwise("trend").alias("method"),
    )


def rolling_origin(
    df: DataFrame, keys: Sequence[str], seq: str, y: str, origins: Sequence[int], fit: Callable[[DataFrame, list[str]], DataFrame]
) -> DataFrame:
    """Errors of a forecast made at each of ``origins`` from the points up to it: (keys, n_held_out, mae, mape).

    ``fit(points, keys)`` is the forecast of all series of a frame; every origin is a series of its own there, so all of them
    are fitted in one pass.
    """
    known = df.withColumn("_origin", F.explode(F.array(*[F.lit(o) for o in origins]))).where(F.col(seq) <= F.col("_origin"))
    ahead = fit(known, [*keys, "_origin"])
    return backtest(ahead, df, keys, seq, y)
