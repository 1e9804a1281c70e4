import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import forecast, metrics


def test_total_ratio_is_ratio_of_sums(spark, rows):
    data = [("A", True), ("A", False)] + [("B", False)] * 8
    df = spark.createDataFrame(data, "g string, hit boolean")
    share = metrics.ratio_of("share", F.when(F.col("hit"), 1).otherwise(0), F.lit(1))
    assert rows(metrics.evaluate(df, [share], ["g"])) == [("A", 0.5), ("B", 0.0)]
    assert rows(metrics.evaluate(df, [share], [])) == [(0.1,)]
    cube = metrics.evaluate_cube(df, [share], ["g"])
    assert rows(cube, "g", "grain", "share") == [("A", 0, 0.5), ("B", 0, 0.0), (None, 1, 0.1)]


def test_cube_tells_a_null_value_from_the_total(spark, rows):
    df = spark.createDataFrame([(None,), ("a",)], "g string")
    out = metrics.evaluate_cube(df, [metrics.count_of("n")], ["g"])
    assert rows(out, "g", "grain", "n") == [("a", 0, 1), (None, 0, 1), (None, 1, 2)]


def test_heatmap_lists_its_columns(spark, rows):
    df = spark.createDataFrame([("r", "x"), ("r", "x"), ("r", "y")], "a string, b string")
    assert rows(metrics.heatmap(df, "a", "b", ["x", "y", "z"], metrics.count_of("n"))) == [("r", 2, 1, None)]


def test_trend_continues_a_line(spark, rows):
    df = spark.createDataFrame([("a", i, 2.0 * i + 1) for i in range(4)] + [("b", 7, 5.0), ("c", 0, 9.0), ("c", 1, 1.0)], "k string, s int, y double")
    out = {(k, s): (round(f, 6), lo) for k, s, f, lo in rows(forecast.linear_forecast(df, ["k"], "s", "y", 2), "k", "s", "forecast", "lower")}
    assert out[("a", 4)][0] == 9.0 and out[("a", 5)][0] == 11.0
    assert out[("b", 8)] == (5.0, None)       # one point: its value, no band
    assert out[("c", 3)][0] == 0.0            # never below the floor


def test_backtest(spark, rows):
    f = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 10.0)], "k string, s int, forecast double")
    a = spark.createDataFrame([("a", 1, 8.0), ("a", 2, 0.0)], "k string, s int, y double")
    assert rows(forecast.backtest(f, a, ["k"], "s", "y")) == [("a", 2, 6.0, 0.25)]


def test_sketches_stay_within_their_bounds_at_every_grain(spark):
    r = random.Random(4)
    data = [(r.choice("AB"), r.choice("XYZ") if r.random() < 0.97 else None, r.randrange(40_000), r.random() ** 3) for _ in range(60_000)] + [("C", "X", None, None)]
    df = spark.createDataFrame(data, "a string, b string, k int, v double")
    out = metrics.evaluate_cube(df, [metrics.distinct_of("keys", F.col("k")), metrics.quantile_of("mid", F.col("v"), 0.5), metrics.count_of("n")], ["a", "b"])
    seen = 0
    for row in out.collect():
        own = [x for x in data if (row["grain"] & 2 or x[0] == row["a"]) and (row["grain"] & 1 or x[1] == row["b"])]
        keys, values = len({x[2] for x in own} - {None}), sorted(x[3] for x in own if x[3] is not None)
        assert abs(row["keys"] - keys) <= max(1, 5 * 0.0163 * keys) and row["n"] == len(own)
        if values:
            share = sum(v <= row["mid"] for v in values) / len(values)
            assert abs(share - 0.5) <= 0.03
        else:
            assert row["mid"] is None
        seen += 1
    assert seen == 15


def wave(n, noise=0.0, seed=1, period=12):
    r = random.Random(seed)
    return [50 + 0.5 * i + 20 * math.cos(2 * math.pi * (i - 3) / period) + r.gauss(0, noise) for i in range(n)]


def test_seasonal_forecast_goes_on_with_the_wave(spark):
    series = {"a": (24_000, wave(40)), "b": (0, wave(26, 1.0)), None: (7, wave(30, 0.5, 2))}
    rows = [(k, first + i, y) for k, (first, ys) in series.items() for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows + [("a", None, 1.0), ("a", 24_050, None)], "k string, s int, y double")
    got = {}
    for r in forecast.seasonal_forecast(df, ["k"], "s", "y", 12, period=12).collect():
        assert r["method"] == "seasonal" and r["lower"] <= r["forecast"] <= r["upper"]
        got.setdefault(r["k"], []).append((r["s"], r["forecast"]))
    for k, (first, ys) in series.items():
        x = np.arange(len(ys))
        basis = lambda t: np.stack([np.ones(len(t)), t, np.cos(2 * np.pi * t / 12), np.sin(2 * np.pi * t / 12)], axis=1)
        fit = np.linalg.lstsq(basis(x), np.array(ys), rcond=None)[0]
        ahead = len(ys) + np.arange(12)
        assert [s for s, _ in sorted(got[k])] == (first + ahead).tolist()
        assert np.allclose([f for _, f in sorted(got[k])], basis(ahead) @ fit, atol=1e-6)


def test_short_or_flat_series_get_the_trend(spark, rows):
    data = [("short", i, 2.0 * i + 1) for i in range(10)] + [("one", 3, 5.0)] + [("gaps", 12 * i, float(i)) for i in range(8)]
    df = spark.createDataFrame(data, "k string, s int, y double")
    out = forecast.seasonal_forecast(df, ["k"], "s", "y", 1, period=12)
    got = {k: (m, round(f, 6)) for k, m, f in rows(out, "k", "method", "forecast")}
    assert got == {"short": ("trend", 21.0), "one": ("trend", 5.0), "gaps": ("trend", round(85 / 12, 6))}
    assert forecast.seasonal_forecast(df.limit(0), ["k"], "s", "y", 1, period=12).count() == 0


def test_seasonal_beats_linear_from_every_origin(spark):
    data = [(k, i, y) for k in range(4) for i, y in enumerate(wave(60, 2.0, k))]
    df = spark.createDataFrame(data, "k int, s int, y double")
    origins = [30, 38, 46, 53]
    seasonal = forecast.rolling_origin(df, ["k"], "s", "y", origins, lambda d, k: forecast.seasonal_forecast(d, k, "s", "y", 6, period=12))
    linear = forecast.rolling_origin(df, ["k"], "s", "y", origins, lambda d, k: forecast.linear_forecast(d, k, "s", "y", 6))
    a, b = ({r["k"]: r for r in x.collect()} for x in (seasonal, linear))
    assert all(a[k]["n_held_out"] == b[k]["n_held_out"] == 24 and a[k]["mae"] < 0.4 * b[k]["mae"] for k in range(4))
    assert statistics.mean(r["mae"] for r in a.values()) == pytest.approx(1.7, abs=0.6)


def test_stages_with_their_assertions(spark):
    from tidewatch.functions import scalars as S

    notes = {
        "CKD stage 3a, stable": [("3a", "present")],
        "No evidence of CKD stage 4. CKD G2 today": [("4", "negated"), ("2", "present")],
        "denies CKD 1 or CKD 2, CKD 3 is new": [("1", "negated"), ("2", "negated"), ("3", "negated")],
        "no CKD 1; CKD 2": [("1", "negated"), ("2", "present")],
        "Mother had CKD stage 5. Patient has chronic kidney disease stage 3B.": [("5", "family"), ("3b", "present")],
        "history of CKD 2; possible CKD 3": [("2", "history"), ("3", "possible")],
        "CKD 4 was ruled out, CKD 2 resolved, now CKD 1": [("4", "negated"), ("2", "history"), ("1", "present")],
        "noted CKD 3": [("3", "present")],
        "not seen for a very long time in this clinic, CKD 3": [("3", "present")],
        "CKD 1, CKD 2": [("1", "present"), ("2", "present")],
        "nothing": [], "": [], None: None,
    }
    df = spark.createDataFrame([(t,) for t in notes], "t string")
    for r in df.select("t", S.stage_mentions("t").alias("m")).withColumn("now", S.current_stage("m")).collect():
        want = notes[r["t"]]
        assert (r["m"] if want is None else [tuple(m) for m in r["m"]]) == want, r["t"]
        present = [s for s, a in want or [] if a == "present"]
        assert r["now"] == (present[-1] if present else None)
