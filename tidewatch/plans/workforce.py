"""Position control: who is who, what staff is available, what is needed, and what lies ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.scalars import clean_label
from tidewatch.operators import forecast as trend
from tidewatch.operators import identity
from tidewatch.operators.ranges import PeriodCalendar, overlap_join
from tidewatch.operators.skew import dealt, shuffled
from tidewatch.sources import adapters

UNASSIGNED = "UNASSIGNED"
HOURS_PER_FTE = 80.0
CELL = ["department", "shift", "seq"]


def crosswalk(hr: DataFrame, tas: DataFrame, stage: identity.Stage | None = None, **limits: float) -> DataFrame:
    """Roster ids against schedule ids; every id of both sides is kept."""
    rows = identity.build_crosswalk(
        identity.people(adapters.roster(hr), "employee_id", "worker_name", "department"),
        identity.people(tas, "tas_worker_id", "worker_name", "department"),
        stage=stage,
        **limits,
    )
    return rows.withColumnRenamed("left_id", "employee_id").withColumnRenamed("right_id", "tas_worker_id")


def naive_vs_reconciled(hr: DataFrame, tas: DataFrame, xwalk: DataFrame) -> DataFrame:
    """What a plain join on the ids gives beside what the crosswalk gives: heads and FTE."""
    roster = hr.select("employee_id", "fte")
    naive_ids = tas.select(F.col("tas_worker_id").alias("employee_id")).distinct()
    naive = roster.join(naive_ids, "employee_id", "left_semi").withColumn("method", F.lit("naive id join"))
    matched = xwalk.where("employee_id IS NOT NULL AND tas_worker_id IS NOT NULL").select("employee_id").distinct()
    found = roster.join(matched, "employee_id", "left_semi").withColumn("method", F.lit("crosswalk"))
    everyone = roster.withColumn("method", F.lit("roster"))
    milli = F.round(F.col("fte") * 1000).cast("bigint")
    methods = F.explode(F.array(F.lit("naive id join"), F.lit("crosswalk"), F.lit("roster")))
    frame = hr.sparkSession.range(1).select(methods.alias("method"))
    g = naive.unionByName(found).unionByName(everyone).groupBy("method").agg(
        F.count(F.lit(1)).alias("headcount"), (F.sum(milli) / F.lit(1000.0)).alias("fte")
    )
    return frame.join(g, "method", "left").select(
        "method", F.coalesce("headcount", F.lit(0)).alias("headcount"), F.coalesce("fte", F.lit(0.0)).alias("fte")
    )


def difficulty(hr: DataFrame, tas: DataFrame) -> DataFrame:
    h = hr.agg(F.count(F.lit(1)).alias("n_roster")).withColumn("_j", F.lit(1))
    t = tas.select("tas_worker_id").distinct().agg(F.count(F.lit(1)).alias("n_schedule_ids")).withColumn("_j", F.lit(1))
    n = hr.select(F.col("employee_id").alias("_id")).join(
        tas.select(F.col("tas_worker_id").alias("_id")).distinct(), "_id", "left_semi"
    ).agg(F.count(F.lit(1)).alias("n_naive_matches")).withColumn("_j", F.lit(1))
    return h.join(t, "_j").join(n, "_j").drop("_j")


def shift_of_employee(xwalk: DataFrame, tas: DataFrame) -> DataFrame:
    """The shift an employee is scheduled on most, through the crosswalk."""
    hours = tas.groupBy("tas_worker_id", "shift").agg(F.sum("scheduled_hours").alias("_h"))
    main = hours.groupBy("tas_worker_id").agg(F.min(F.struct((-F.col("_h")).alias("h"), "shift"))["shift"].alias("shift"))
    linked = xwalk.where("employee_id IS NOT NULL AND tas_worker_id IS NOT NULL").select("employee_id", "tas_worker_id")
    return shuffled(linked).join(main, "tas_worker_id").groupBy("employee_id").agg(F.min("shift").alias("shift"))


def placed_roster(hr: DataFrame, shifts: DataFrame | None) -> DataFrame:
    """Roster with cleaned department and shift; staff without a shift are shown as UNASSIGNED."""
    base = hr.select("employee_id", clean_label("department").alias("department"), "fte", "hire_date", "term_date")
    if shifts is None:
        return base.withColumn("shift", F.lit(UNASSIGNED))
    return shuffled(base).join(shifts, "employee_id", "left").withColumn("shift", F.coalesce("shift", F.lit(UNASSIGNED)))


def employed_fte(roster: DataFrame, calendar: PeriodCalendar) -> DataFrame:
    """FTE employed per department, shift and period, without one row per employee and period.

    Each hire adds and each termination takes away FTE-days at two period numbers; the changes fold to
    (department, shift, period) and a running total over the few periods of a cell gives the level.
    Amounts are whole thousandths of FTE-days, so the totals are exact.
    """
    days, n = calendar.days, calendar.n
    first, last = calendar.start(F.lit(0)), calendar.end(F.lit(n - 1))
    milli = F.round(F.col("fte") * 1000).cast("bigint")
    hire = F.greatest(F.col("hire_date"), first)
    term = F.col("term_date")
    inside = roster.where(
        (F.col("hire_date") <= last) & (term.isNull() | ((term >= first) & (term >= F.col("hire_date"))))
    )
    h, e = calendar.index(hire), calendar.index(term)
    from_hire = F.datediff(calendar.end(h), hire) + 1
    to_term = F.datediff(term, calendar.start(e)) + 1
    change = lambda seq, amount: F.struct(seq.cast("int").alias("seq"), amount.cast("bigint").alias("amount"))
    leaves = term.isNotNull() & (term <= last)
    changes = F.array_compact(
        F.array(
            change(h, milli * from_hire),
            change(h + 1, milli * (days - from_hire)),
            F.when(leaves, change(e, -milli * (days - to_term))),
            F.when(leaves, change(e + 1, -milli * to_term)),
        )
    )
    moved = inside.select("department", "shift", F.explode(changes).alias("_c")).select(
        "department", "shift", F.col("_c.seq").alias("seq"), F.col("_c.amount").alias("amount")
    ).groupBy(*CELL).agg(F.sum("amount").alias("amount"))
    cells = moved.select("department", "shift").distinct()
    grid = cells.select("department", "shift", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("seq")).withColumn(
        "amount", F.lit(0).cast("bigint")
    )
    run = W.partitionBy("department", "shift").orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    level = grid.unionByName(moved.where(F.col("seq") < n)).groupBy(*CELL).agg(F.sum("amount").alias("amount"))
    return level.select(*CELL, (F.sum("amount").over(run) / F.lit(1000.0 * days)).alias("employed_fte"))


def lost_fte(roster: DataFrame, leave: DataFrame, calendar: PeriodCalendar) -> DataFrame:
    """FTE lost to leave per department, shift and period.

    Only employees with leave are spread over periods. Leave of absence counts distinct days, so two
    overlapping leaves are not counted twice; paid time off counts its hours, spread over its days.
    The share lost is capped at the whole.
    """
    last = calendar.end(F.lit(calendar.n - 1))
    first = calendar.start(F.lit(0))
    leave = dealt(leave, ["employee_id"], leave.count(), 100_000)  # every step up to the roster is per employee
    absence = leave.where(F.col("leave_type") == "LOA").select(
        "employee_id",
        F.greatest(F.col("start_date"), first).alias("start_date"),
        F.least(F.coalesce("end_date", last), last).alias("end_date"),
    )
    # A leave counts from the day after all earlier ones of the person: overlaps count once, in rows per leave and period.
    before = W.partitionBy("employee_id").orderBy("start_date", "end_date").rowsBetween(W.unboundedPreceding, -1)
    reached = F.date_add(F.max("end_date").over(before), 1)
    own = absence.where("end_date >= start_date").withColumn("start_date", F.greatest("start_date", reached))
    loa = overlap_join(own, calendar, "start_date", "end_date").groupBy("employee_id", "seq").agg(
        F.sum("overlap_days").alias("loa_days")
    )
    off = leave.where((F.col("leave_type") == "PTO") & F.col("hours").isNotNull())
    whole = F.datediff(F.coalesce("end_date", "start_date"), F.col("start_date")) + 1
    pto = (
        overlap_join(off.withColumn("_days", whole), calendar, "start_date", "end_date", F.col("start_date"))
        .groupBy("employee_id", "seq")
        .agg(F.sum(F.col("hours") * F.col("overlap_days") / F.col("_days")).alias("pto_hours"))
    )
    both = loa.unionByName(pto, allowMissingColumns=True).groupBy("employee_id", "seq").agg(
        F.coalesce(F.sum("loa_days"), F.lit(0)).alias("loa_days"), F.coalesce(F.sum("pto_hours"), F.lit(0.0)).alias("pto_hours")
    )
    seq = F.col("seq")
    worked = F.datediff(
        F.least(F.coalesce("term_date", calendar.end(seq)), calendar.end(seq)),
        F.greatest(F.col("hire_date"), calendar.start(seq)),
    ) + 1
    employed = F.greatest(worked, F.lit(0)) / F.lit(float(calendar.days))
    share = F.least(
        F.lit(1.0), F.col("pto_hours") / (F.lit(HOURS_PER_FTE) * F.col("fte")) + F.col("loa_days") / F.lit(float(calendar.days))
    )
    return both.join(shuffled(roster), "employee_id").groupBy(*CELL).agg(
        F.sum(F.col("fte") * employed * share).alias("lost_fte")
    )


def position_control(
    roster: DataFrame, leave: DataFrame, demand: DataFrame, budget: DataFrame, calendar: PeriodCalendar
) -> DataFrame:
    """Budgeted, available, required and net FTE per department, shift and period.

    The facts are stacked in one long table and folded once, so a cell known to only one of them is
    kept, and no grid of all departments, shifts and periods is joined. Demand outside the calendar is kept with its own
    period number; ``demand_outside`` lists it.
    """
    spread = budget.select(
        clean_label("department").alias("department"), "shift",
        F.explode(F.sequence(F.lit(0), F.lit(calendar.n - 1))).alias("seq"), "budgeted_fte",
    )
    wanted = adapters.demand(demand, calendar).select(
        clean_label("department").alias("department"), "shift", "seq", "required_fte"
    )
    rows = (
        employed_fte(roster, calendar)
        .unionByName(lost_fte(roster, leave, calendar), allowMissingColumns=True)
        .unionByName(wanted, allowMissingColumns=True)
        .unionByName(spread, allowMissingColumns=True)
    )
    zero = F.lit(0.0)
    g = rows.groupBy(*CELL).agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("budgeted_fte", "employed_fte", "lost_fte", "required_fte")]
    )
    available = F.col("employed_fte") - F.col("lost_fte")
    return g.select(
        *CELL,
        calendar.label(F.col("seq")).alias("pay_period"),
        "budgeted_fte",
        available.alias("available_fte"),
        "required_fte",
        (available - F.col("required_fte")).alias("net_fte"),
    )


def demand_outside(demand: DataFrame, calendar: PeriodCalendar) -> DataFrame:
    """Demand rows of periods that the calendar does not have, or of none."""
    return adapters.demand(demand, calendar).where(F.col("seq").isNull() | ~F.col("seq").between(0, calendar.n - 1))


def staffing_forecast(position: DataFrame, horizon: int = 3) -> DataFrame:
    """Available and required FTE continued per department and shift, with shortage and surplus."""
    by = ["department", "shift"]
    have = trend.linear_forecast(position, by, "seq", "available_fte", horizon).select(
        *by, "seq", F.col("forecast").alias("available_fte")
    )
    want = trend.linear_forecast(position, by, "seq", "required_fte", horizon).select(
        *by, "seq", F.col("forecast").alias("required_fte")
    )
    net = F.col("available_fte") - F.col("required_fte")
    return (
        have.join(want, [*by, "seq"])
        .withColumn("shortage_fte", F.greatest(-net, F.lit(0.0)))
        .withColumn("surplus_fte", F.greatest(net, F.lit(0.0)))
    )


def actual_and_forecast(position: DataFrame, horizon: int = 3) -> DataFrame:
    net = F.col("net_fte")
    past = position.select(
        *CELL, "available_fte", "required_fte",
        F.greatest(-net, F.lit(0.0)).alias("shortage_fte"), F.greatest(net, F.lit(0.0)).alias("surplus_fte"),
        F.lit(False).alias("is_forecast"),
    )
    return past.unionByName(staffing_forecast(position, horizon).withColumn("is_forecast", F.lit(True)))


def short_units(forecast: DataFrame, seq: int, shift: str | None = None) -> DataFrame:
    short = forecast.where((F.col("seq") == seq) & (F.col("shortage_fte") > 0))
    if shift is not None:
        short = short.where(F.col("shift") == shift)
    return short.orderBy(F.col("shortage_fte").desc(), "department", "shift")


def role_mix_gap(budget: DataFrame, actual: DataFrame) -> DataFrame:
    """Budgeted headcount by role (from the JSON mix) against the headcount on the roster."""
    planned = budget.select(
        clean_label("department").alias("department"), F.explode(F.from_json("role_mix", "map<string,int>")).alias("role", "_n")
    ).groupBy("department", "role").agg(F.sum("_n").alias("budgeted"))
    present = actual.groupBy(clean_label("department").alias("department"), "role").agg(F.count(F.lit(1)).alias("actual"))
    rows = planned.unionByName(present, allowMissingColumns=True).groupBy("department", "role").agg(
        F.coalesce(F.sum("budgeted"), F.lit(0)).alias("budgeted"), F.coalesce(F.sum("actual"), F.lit(0)).alias("actual")
    )
    return rows.withColumn("gap", F.col("actual") - F.col("budgeted"))
