import datetime as dt

from tidewatch.operators.ranges import PeriodCalendar
from tidewatch.plans import workforce as N

D = dt.date
CAL = PeriodCalendar("2024-01-01", 4, 14)
ROSTER = "employee_id string, department string, fte double, hire_date date, term_date date"


def roster(spark, data):
    return N.placed_roster(spark.createDataFrame(data, ROSTER), None)


def test_employed_fte_by_period(spark, rows):
    r = roster(spark, [
        ("old", "A", 1.0, D(2020, 1, 1), None),
        ("in", "A", 1.0, D(2024, 1, 20), D(2024, 1, 22)),         # three days inside one period
        ("future", "A", 0.5, D(2024, 2, 5), None),                # starts in period 2, eight of... days
        ("gone", "A", 1.0, D(2019, 1, 1), D(2023, 12, 31)),
        ("late", "A", 1.0, D(2025, 1, 1), None),
        ("leaves", "A", 1.0, D(2020, 1, 1), D(2024, 1, 7)),       # half of period 0
    ])
    got = {s: round(v, 6) for s, v in rows(N.employed_fte(r, CAL), "seq", "employed_fte")}
    assert got == {0: 1.5, 1: round(1 + 3 / 14, 6), 2: round(1 + 0.5 * 7 / 14, 6), 3: 1.5}


def test_leave_is_not_counted_twice_and_is_capped(spark, rows):
    r = roster(spark, [("e", "A", 1.0, D(2020, 1, 1), None), ("p", "A", 0.5, D(2020, 1, 1), None)])
    leave = spark.createDataFrame(
        [("e", "LOA", D(2024, 1, 1), D(2024, 1, 10), None), ("e", "LOA", D(2024, 1, 5), D(2024, 1, 14), None),
         ("e", "PTO", D(2024, 1, 2), D(2024, 1, 3), 16.0), ("p", "PTO", D(2024, 1, 14), D(2024, 1, 15), 20.0),
         ("e", "LOA", D(2024, 2, 1), None, None)],
        "employee_id string, leave_type string, start_date date, end_date date, hours double",
    )
    got = {s: round(v, 6) for s, v in rows(N.lost_fte(r, leave, CAL), "seq", "lost_fte")}
    # period 0: e is away all 14 days (capped at 1), p loses 10 of 40 hours
    assert got[0] == round(1.0 + 0.5 * 10 / 40, 6)
    assert got[1] == round(0.5 * 10 / 40, 6)
    assert got[2] == round(11 / 14, 6) and got[3] == 1.0


def test_position_keeps_cells_of_any_fact(spark, rows):
    r = roster(spark, [("e", "a ", 1.0, D(2020, 1, 1), None)])
    leave = spark.createDataFrame([], "employee_id string, leave_type string, start_date date, end_date date, hours double")
    need = spark.createDataFrame([("B", "Day", 1, 2.0), ("B", "Day", 99, 2.0)], "department string, shift string, seq int, required_fte double")
    budget = spark.createDataFrame([("A", "Day", 1.0)], "department string, shift string, budgeted_fte double")
    out = N.position_control(r, leave, need, budget, CAL)
    got = {(d, s, q): n for d, s, q, n in rows(out, "department", "shift", "seq", "net_fte")}
    assert got[("A", "UNASSIGNED", 0)] == 1.0 and got[("B", "Day", 1)] == -2.0 and got[("A", "Day", 3)] == 0.0
    assert got[("B", "Day", 99)] == -2.0  # demand outside the calendar is kept
    assert len(got) == 4 + 1 + 4 + 1
    assert N.demand_outside(need, CAL).count() == 1


def test_forecast_shortage_and_surplus(spark, rows):
    p = spark.createDataFrame([("A", "Day", s, 10.0 - s, 5.0 + s) for s in range(4)], "department string, shift string, seq int, available_fte double, required_fte double")
    out = rows(N.staffing_forecast(p, 1), "seq", "available_fte", "required_fte", "shortage_fte", "surplus_fte")
    assert [tuple(round(float(x), 6) for x in r) for r in out] == [(4.0, 6.0, 9.0, 3.0, 0.0)]


def test_leave_is_dealt_by_employee_and_the_roster_shuffled(spark):
    staff = roster(spark, [("e", "A", 1.0, D(2020, 1, 1), None)])
    leave = spark.createDataFrame([("e", "LOA", D(2024, 1, 1), D(2024, 1, 7), None)], "employee_id string, leave_type string, start_date date, end_date date, hours double")
    lost = N.lost_fte(staff, leave, CAL)
    plan = lost._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "REPARTITION_BY_COL" in plan
    assert [(r["seq"], r["lost_fte"]) for r in lost.collect()] == [(0, 0.5)]
