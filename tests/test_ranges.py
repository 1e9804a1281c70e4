import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import ranges

D = dt.date


def test_one_day_leave_removes_that_day_only(spark, rows):
    work = spark.createDataFrame([("a", D(2024, 1, 5)), ("a", D(2024, 1, 6))], "k string, day date")
    off = spark.createDataFrame([("a", D(2024, 1, 5), D(2024, 1, 5))], "k string, s date, e date")
    assert rows(ranges.drop_covered_days(work, ["k"], "day", off, "s", "e"), "day") == [(D(2024, 1, 6),)]


def test_open_end_runs_to_the_horizon(spark, rows):
    off = spark.createDataFrame([("a", D(2024, 1, 30), None)], "k string, s date, e date")
    got = ranges.explode_ranges(off, "s", "e", "day", F.lit("2024-02-02").cast("date"))
    assert got.count() == 4


def test_overlap_edges_are_inclusive(spark, rows):
    cal = ranges.PeriodCalendar("2024-01-01", 3, 14)
    ev = spark.createDataFrame(
        [("in", D(2024, 1, 14), D(2024, 1, 15)), ("long", D(2023, 12, 1), None), ("before", D(2023, 1, 1), D(2023, 12, 31)),
         ("after", D(2024, 2, 12), D(2024, 2, 13))],
        "k string, s date, e date",
    )
    out = ranges.overlap_join(ev, cal, "s", "e")
    assert rows(out, "k", "seq", "overlap_days") == [
        ("in", 0, 1), ("in", 1, 1), ("long", 0, 14), ("long", 1, 14), ("long", 2, 14)
    ]


def test_period_labels(spark, rows):
    cal = ranges.period_calendar(spark, "2024-12-16", 3)
    assert rows(cal, "seq", "pay_period", "start_date", "end_date") == [
        (0, "2024-PP26", D(2024, 12, 16), D(2024, 12, 29)),
        (1, "2024-PP27", D(2024, 12, 30), D(2025, 1, 12)),
        (2, "2025-PP01", D(2025, 1, 13), D(2025, 1, 26)),
    ]


def test_overlap_has_no_join(spark):
    cal = ranges.PeriodCalendar("2024-01-01", 3, 14)
    ev = spark.createDataFrame([("in", D(2024, 1, 14), D(2024, 1, 15))], "k string, s date, e date")
    plan = ranges.overlap_join(ev, cal, "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
