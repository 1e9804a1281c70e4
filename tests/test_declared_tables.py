"""Packs on tables written in exactly the declared schema, read back, up to their last table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.ranges import PeriodCalendar
from tidewatch.plans import scheduling as H
from tidewatch.plans import workforce as N
from tidewatch.sources import adapters, schemas
from tidewatch.sources.tables import read

D = dt.date


@pytest.fixture
def stored(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, schemas.schema(name)).write.parquet(os.path.join(str(tmp_path), name))
        return read(spark, str(tmp_path), name)

    return put


def test_period_number_is_the_reverse_of_the_label(spark):
    calendar = PeriodCalendar("2023-12-18", 60, 14)
    back = calendar.frame(spark).withColumn("n", calendar.number(F.col("pay_period")))
    assert back.where("n <> seq").count() == 0
    assert spark.range(1).select(calendar.number(F.lit("2024-13"))).first()[0] is None


def test_position_control_from_declared_tables(stored):
    calendar = PeriodCalendar("2024-01-01", 4, 14)
    hr = stored("nursing_hr_roster", [
        ("E00001", "Robert", "Smith", "ICU", "4W", "RN", 1.0, D(2020, 1, 1), None, "ACTIVE"),
        ("E00002", "Ann", "Lee", "ICU", "4W", "RN", 0.5, D(2020, 1, 1), None, "ACTIVE"),
    ])
    tas = stored("nursing_tas_schedule", [
        ("TAS-0001", "Bob Smith RN", "icu", "Day", "2024-PP01", 80.0, 0.0), ("TAS-0002", "Ann Lee", "ICU", "Night", "2024-PP01", 40.0, 0.0),
    ])
    leave = stored("nursing_pto_loa", [("L1", "E00002", "LOA", D(2024, 1, 15), D(2024, 1, 28), None)])
    need = stored("nursing_demand_metrics", [
        ("ICU", "Day", f"2024-PP{n:02d}", 2.0, 10, "ACUITY") for n in range(1, 5)] + [("ICU", "Day", "2030-PP01", 2.0, 10, "ACUITY")])
    budget = stored("nursing_position_control", [("ICU", "Day", 2, 2.0, None), ("ICU", "Night", 1, 1.0, None)])
    links = N.crosswalk(hr, tas)
    assert {(r["employee_id"], r["tas_worker_id"]) for r in links.collect()} == {("E00001", "TAS-0001"), ("E00002", "TAS-0002")}
    placed = N.placed_roster(hr, N.shift_of_employee(links, tas))
    out = N.position_control(placed, leave, need, budget, calendar)
    got = {(r["shift"], r["seq"]): r for r in out.collect()}
    assert got["Day", 0]["net_fte"] == pytest.approx(-1.0) and got["Night", 0]["available_fte"] == pytest.approx(0.5)
    assert got["Night", 1]["available_fte"] == pytest.approx(0.0)
    assert N.demand_outside(need, calendar).count() == 1
    assert N.staffing_forecast(out.where("seq < 4"), 2).count() > 0


def test_schedule_from_declared_tables(stored):
    block = H.Block("2026-09-07", 7, 2)
    people = [(f"HOSP-{i:04d}", f"P {i}", 1.0, ["general"], i, "hospitalist", 5, 10, i % 2 == 0) for i in range(6)]
    providers = adapters.on_sites(stored("sched_providers", people))
    rules = stored("sched_pay_rules", [
        ("R1", "max_consecutive", "", "days", "5", "all"), ("R2", "min_rest_hours", "", "hours", "10", "all"),
        ("R3", "night_differential", "", "optin", "true", "all"), ("R4", "max_shifts_per_block", "", "n", "5", "all"),
        ("R5", "min_shifts_per_block", "", "n", "1", "all"), ("R6", "no_night_then_day", "", "on", "true", "all"),
    ])
    pto = stored("sched_pto_requests", [("T1", "HOSP-0001", D(2026, 9, 12), D(2026, 9, 16), "approved", "x")])
    prefs = stored("sched_preferences", [("HOSP-0002", "day", "Mon", 5, True, 4)])
    need = [(D(2026, 9, 7) + dt.timedelta(days=i), s, "general", 1, "general") for i in range(14) for s in ("day", "night")]
    coverage = adapters.on_sites(stored("sched_coverage_requirements", need))
    history = adapters.on_sites(stored("sched_existing_schedule", [("A1", "HOSP-0001", D(2026, 9, 14), "day", "general", "x")]))
    facts = H.provider_facts(providers, rules, pto, prefs, block)
    assert H.eligible(coverage, facts).count() > 0
    drafted = H.draft(coverage, facts, block, "r")
    found = H.audit(H.draft_as_assignments(drafted), facts, coverage, block)
    done = H.with_hard_ok(drafted, found)
    assert done.count() > 20 and done.where("NOT is_hard_ok").count() == 0
    assert dict(done.dtypes)["provider_id"] == "string"
    old = H.audit(history, facts, coverage, block).where("rule = 'on_approved_leave'")
    assert [r["entity_id"] for r in old.collect()] == ["HOSP-0001"]
    assert H.coverage_fill(coverage, H.draft_as_assignments(drafted)).where("shortfall > 0").count() >= 0
