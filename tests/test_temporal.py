import datetime as dt
import random

from pyspark.sql import functions as F

from tidewatch.operators import temporal

D0 = dt.date(2024, 1, 1)


def labs(spark, data):
    return spark.createDataFrame(
        [(k, D0 + dt.timedelta(days=d), v, i) for i, (k, d, v) in enumerate(data)], "k string, d date, v double, i int"
    )


def test_persistent_breach_edges(spark, rows):
    df = labs(spark, [
        ("p1", 0, 55.0), ("p1", 90, 58.0),
        ("p2", 0, 55.0), ("p2", 89, 58.0),
        ("p3", 0, 60.0), ("p3", 200, 50.0),
        ("p4", 0, 50.0),
        ("p5", 0, None), ("p5", 10, 50.0), ("p5", 100, 51.0), ("p5", 100, 52.0),
    ])
    out = temporal.persistent_breach(df, "k", "d", "v")
    assert rows(out, "k", "n_breach") == [("p1", 2), ("p5", 3)]


def test_strict_breach_resets_on_a_normal_value(spark, rows):
    df = labs(spark, [
        ("a", 0, 50.0), ("a", 50, 70.0), ("a", 100, 50.0),          # interrupted
        ("b", 0, 50.0), ("b", 50, 55.0), ("b", 100, 50.0),          # unbroken
        ("c", 0, 70.0), ("c", 1, 50.0), ("c", 95, 50.0), ("c", 96, 80.0),
    ])
    loose = temporal.persistent_breach(df, "k", "d", "v")
    strict = temporal.persistent_breach(df, "k", "d", "v", strict=True)
    assert rows(loose, "k") == [("a",), ("b",), ("c",)]
    assert rows(strict, "k", "n_breach") == [("b", 3), ("c", 2)]


def test_breach_equals_self_join_on_random_data(spark, rows):
    rnd = random.Random(3)
    df = labs(spark, [(f"k{rnd.randrange(30)}", rnd.randrange(300), rnd.uniform(30, 90)) for _ in range(400)])
    low = df.where("v < 60")
    pairs = low.alias("a").join(low.alias("b"), (F.col("a.k") == F.col("b.k")) & (F.datediff("b.d", "a.d") >= 90))
    assert rows(temporal.persistent_breach(df, "k", "d", "v").select("k")) == rows(pairs.select("a.k").distinct())


def test_latest_breaks_ties_by_id(spark, rows):
    df = labs(spark, [("a", 1, 1.0), ("a", 1, 2.0), ("b", 0, 3.0)])
    assert rows(temporal.latest_per_key(df, ["k"], ["d", "i"]), "k", "v") == [("a", 2.0), ("b", 3.0)]


def test_runs_of_three_and_two(spark, rows):
    df = labs(spark, [("a", d, 0.0) for d in (1, 2, 3, 3, 5, 6)] + [("a", 30, 0.0), ("a", 31, 0.0)])
    assert sorted(r[0] for r in rows(temporal.consecutive_runs(df, ["k"], "d"), "run_days")) == [2, 2, 3]


def test_previous_row_crosses_time_slices(spark, rows):
    rnd = random.Random(5)
    data = [(f"k{rnd.randrange(3)}", D0 + dt.timedelta(days=rnd.randrange(400)), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, d date, i int")
    got = temporal.with_previous(df, ["k"], "d", ["i"], {"i": "prev_i"}, slice_s=7 * 86400)
    want, last = [], {}
    for k, d, i in sorted(data):
        want.append((k, i, last.get(k)))
        last[k] = i
    assert rows(got, "k", "i", "prev_i") == sorted(want, key=repr)


def test_trailing_window_edges(spark, rows):
    df = spark.createDataFrame(
        [("a", dt.date(1999, 1, 1)), ("a", dt.date(1999, 1, 2)), ("a", dt.date(2000, 1, 1)), ("a", dt.date(2000, 1, 2))],
        "k string, d date",
    )
    out = temporal.trailing_rollup(df, ["k"], "d", "2000-01-01", 12, [F.count(F.lit(1)).alias("n")])
    assert rows(out) == [("a", 2)]


def test_slope_needs_points_and_span(spark, rows):
    df = labs(spark, [("a", 0, 60.0), ("a", 365, 54.0), ("a", 730, 48.0), ("b", 0, 60.0), ("b", 365, 50.0)])
    got = {k: s for k, s in rows(temporal.trend_slope(df, "k", "d", "v"), "k", "slope_per_year")}
    assert abs(got["a"] + 6.0 * 365.25 / 365) < 1e-9 and got["b"] is None


def test_recent_activity(spark, rows):
    base = spark.createDataFrame([("a",), ("b",)], "k string")
    seen = spark.createDataFrame([("a", D0), ("b", D0 - dt.timedelta(days=90))], "k string, d date")
    assert rows(temporal.recently_active(base, seen, "k", "d", "2024-01-01", 90)) == [("a",)]
