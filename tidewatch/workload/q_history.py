"""Per-entity history operators on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import matching, ranges, temporal
from tidewatch.workload.bindings import BLOCK_DAYS, BLOCK_START
from tidewatch.workload.registry import query

_PAIRS = "SELECT DISTINCT a.patient_id FROM low a JOIN low b ON a.patient_id = b.patient_id AND date_diff('day', a.lab_date, b.lab_date) >= 90"
_LOW = "low AS (SELECT patient_id, lab_date, value FROM lab WHERE value < 60)"


@query(
    "persistent_low_values",
    f"WITH {_LOW}, chronic AS ({_PAIRS}) SELECT patient_id, count(*) AS n_breach, min(lab_date) AS first_breach, max(lab_date) AS last_breach, "
    "min(value) AS min_value, max(value) AS max_value FROM low WHERE patient_id IN (SELECT patient_id FROM chronic) GROUP BY patient_id",
    "lab",
)
def _(t):
    return temporal.persistent_breach(t.lab, "patient_id", "lab_date", "value")


@query(
    "persistent_low_values_unbroken",
    "WITH s AS (SELECT patient_id, lab_date, value, max(CASE WHEN value >= 60 THEN lab_date END) OVER (PARTITION BY patient_id ORDER BY lab_date) AS anchor FROM lab), "
    "runs AS (SELECT patient_id, anchor, count(*) AS n, min(lab_date) AS a, max(lab_date) AS b, min(value) AS lo, max(value) AS hi FROM s WHERE value < 60 GROUP BY 1, 2 "
    "HAVING date_diff('day', min(lab_date), max(lab_date)) >= 90) SELECT patient_id, CAST(sum(n) AS BIGINT) AS n_breach, min(a) AS first_breach, max(b) AS last_breach, "
    "min(lo) AS min_value, max(hi) AS max_value FROM runs GROUP BY patient_id",
    "lab",
)
def _(t):
    return temporal.persistent_breach(t.lab, "patient_id", "lab_date", "value", strict=True)


@query(
    "latest_value_per_patient",
    "SELECT patient_id, lab_id, lab_date, value FROM lab QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY lab_date DESC, lab_id DESC) = 1",
    "lab",
)
def _(t):
    return temporal.latest_per_key(t.lab, ["patient_id"], ["lab_date", "lab_id"])


@query(
    "patient_history_summary",
    "SELECT patient_id, count(*) AS n_values, min(lab_date) AS first_date, max(lab_date) AS latest_date, "
    "arg_min(value, struct_pack(a := lab_date, b := lab_id)) AS first_value, arg_max(value, struct_pack(a := lab_date, b := lab_id)) AS latest_value, "
    "min(value) AS min_value, max(value) AS max_value FROM lab GROUP BY patient_id",
    "lab",
)
def _(t):
    return temporal.history_summary(t.lab, "patient_id", "lab_date", "value", "lab_id")


@query(
    "yearly_slope_per_patient",
    "WITH g AS (SELECT patient_id, count(*) AS n_points, CAST(date_diff('day', min(lab_date), max(lab_date)) AS INTEGER) AS span_days, "
    "regr_slope(value, date_diff('day', DATE '1970-01-01', lab_date) / 365.25) AS s FROM lab GROUP BY 1) "
    "SELECT patient_id, n_points, span_days, CASE WHEN n_points >= 3 AND span_days >= 90 THEN round(s, 4) END AS slope_per_year FROM g",
    "lab",
)
def _(t):
    out = temporal.trend_slope(t.lab, "patient_id", "lab_date", "value")
    return out.withColumn("slope_per_year", F.round("slope_per_year", 4))


@query(
    "worked_day_runs",
    "WITH d AS (SELECT DISTINCT provider_id, work_date FROM asg), i AS (SELECT *, work_date - CAST(row_number() OVER "
    "(PARTITION BY provider_id ORDER BY work_date) AS INTEGER) AS g FROM d) SELECT provider_id, min(work_date) AS run_start, max(work_date) AS run_end, "
    "count(*) AS run_days FROM i GROUP BY provider_id, g",
    "asg",
)
def _(t):
    return temporal.consecutive_runs(t.asg, ["provider_id"], "work_date")


@query(
    "gap_since_previous_event",
    "SELECT event_id, user_id, lag(ts) OVER w AS prev_end, lag(event_type) OVER w AS prev_type, "
    "CAST(date_diff('microsecond', lag(ts) OVER w, ts) AS DOUBLE) / 3600000000 AS gap_hours FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
)
def _(t):
    ev = t.raw("events").select("event_id", "user_id", "ts", "event_type").withColumn("done", F.col("ts"))
    out = temporal.previous_gap(ev, ["user_id"], "ts", "done", ["event_id"], {"event_type": "prev_type"})
    return out.select("event_id", "user_id", "prev_end", "prev_type", "gap_hours")


@query(
    "dispense_to_administration_nearest",
    "WITH p AS (SELECT t.txn_id, m.mar_id, m.admin_time, date_diff('microsecond', t.ts, m.admin_time) AS us FROM txn t JOIN mar m "
    "ON m.staff_id = t.staff_id AND m.admin_time > t.ts AND date_diff('microsecond', t.ts, m.admin_time) <= 86400000000 WHERE t.txn_type = 'dispense'), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY us, mar_id) AS a, row_number() OVER (PARTITION BY mar_id ORDER BY us, txn_id) AS b FROM p) "
    "SELECT t.txn_id, r.mar_id, r.admin_time, CAST(r.us AS DOUBLE) / 1000000 AS gap_s FROM txn t LEFT JOIN (SELECT * FROM r WHERE a = 1 AND b = 1) r "
    "ON r.txn_id = t.txn_id WHERE t.txn_type = 'dispense'",
    "txn mar",
)
def _(t):
    m = matching.interval_match(
        t.txn.where("txn_type = 'dispense'").select("txn_id", "staff_id", "ts"), t.mar,
        ["staff_id"], "ts", "admin_time", "txn_id", "mar_id", 0, 86_400, nearest_only=True,
    )
    return m.select("txn_id", F.col("match_id").alias("mar_id"), F.col("match_time").alias("admin_time"), "gap_s")


#: The match taken literally: per staff member a list of events, from which neighbouring pairs are removed until none is left.
_TAKEN = "items[{i}].side = 1 AND items[{i} + 1].side = 0 AND items[{i} + 1].us - items[{i}].us <= 86400000000"
MATCH_SQL = (
    "ev AS (SELECT staff_id, 1 AS side, epoch_us(ts) AS us, txn_id AS id FROM txn WHERE txn_type = 'dispense' UNION ALL "
    "SELECT staff_id, 0, epoch_us(admin_time), mar_id FROM mar), "
    "seq AS (SELECT staff_id, list({'side': side, 'us': us, 'id': id} ORDER BY us, side, CASE side WHEN 1 THEN -id ELSE id END) AS items "
    "FROM ev GROUP BY staff_id), "
    "rest(staff_id, items, pairs) AS (SELECT staff_id, items, CAST([] AS STRUCT(txn_id BIGINT, mar_id BIGINT, us BIGINT)[]) FROM seq UNION ALL "
    f"SELECT staff_id, list_filter(items, lambda x, i: NOT coalesce({_TAKEN.format(i='i')}, false) AND NOT (i > 1 AND coalesce({_TAKEN.format(i='(i - 1)')}, false))), "
    f"list_transform(list_filter(range(1, len(items)), lambda i: coalesce({_TAKEN.format(i='i')}, false)), "
    "lambda i: {'txn_id': items[i].id, 'mar_id': items[i + 1].id, 'us': items[i + 1].us - items[i].us}) "
    f"FROM rest WHERE len(list_filter(range(1, len(items)), lambda i: coalesce({_TAKEN.format(i='i')}, false))) > 0), "
    "matched AS (SELECT u.txn_id, u.mar_id, u.us FROM (SELECT unnest(pairs) AS u FROM rest) x)"
)


@query(
    "dispense_to_administration",
    f"WITH RECURSIVE {MATCH_SQL} SELECT t.txn_id, r.mar_id, CAST(r.us AS DOUBLE) / 1000000 AS gap_s FROM txn t LEFT JOIN matched r "
    "ON r.txn_id = t.txn_id WHERE t.txn_type = 'dispense'",
    "txn mar",
)
def _(t):
    m = matching.interval_match(
        t.txn.where("txn_type = 'dispense'").select("txn_id", "staff_id", "ts"), t.mar,
        ["staff_id"], "ts", "admin_time", "txn_id", "mar_id", 0, 86_400,
    )
    return m.select("txn_id", F.col("match_id").alias("mar_id"), "gap_s")


@query(
    "last_pain_score_before",
    "WITH b AS (SELECT m.mar_id, p.score, p.documented_time, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time DESC, p.pain_id DESC) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time <= m.admin_time AND date_diff('microsecond', p.documented_time, m.admin_time) <= 43200000000) "
    "SELECT m.mar_id, b.score, b.documented_time FROM mar m LEFT JOIN b ON b.mar_id = m.mar_id AND b.rn = 1",
    "mar pain",
)
def _(t):
    return matching.asof_join(
        t.mar.select("mar_id", "patient_id", "admin_time"), t.pain, ["patient_id"], "admin_time", "documented_time",
        {"score": F.col("score"), "documented_time": F.col("documented_time")}, "backward", 43_200, tie="pain_id",
    ).select("mar_id", "score", "documented_time")


@query(
    "first_pain_score_after",
    "WITH b AS (SELECT m.mar_id, p.score, p.documented_time, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time, p.pain_id) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time > m.admin_time AND date_diff('microsecond', m.admin_time, p.documented_time) <= 43200000000) "
    "SELECT m.mar_id, b.score, b.documented_time FROM mar m LEFT JOIN b ON b.mar_id = m.mar_id AND b.rn = 1",
    "mar pain",
)
def _(t):
    return matching.asof_join(
        t.mar.select("mar_id", "patient_id", "admin_time"), t.pain, ["patient_id"], "admin_time", "documented_time",
        {"score": F.col("score"), "documented_time": F.col("documented_time")}, "forward", 43_200, tie="pain_id",
    ).select("mar_id", "score", "documented_time")


@query(
    "last_pain_score_ever",
    "WITH b AS (SELECT m.mar_id, p.score, p.pain_id, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time DESC, p.pain_id DESC) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time <= m.admin_time) "
    "SELECT m.mar_id, b.score, b.pain_id FROM mar m LEFT JOIN b ON b.mar_id = m.mar_id AND b.rn = 1",
    "mar pain",
)
def _(t):
    return matching.asof_join(
        t.mar.select("mar_id", "patient_id", "admin_time"), t.pain, ["patient_id"], "admin_time", "documented_time",
        {"score": F.col("score"), "pain_id": F.col("pain_id")}, "backward", None, tie="pain_id",
    ).select("mar_id", "score", "pain_id")


@query(
    "pain_change_around_administration",
    "WITH b AS (SELECT m.mar_id, p.score, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time DESC, p.pain_id DESC) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time <= m.admin_time AND date_diff('microsecond', p.documented_time, m.admin_time) <= 86400000000), "
    "a AS (SELECT m.mar_id, p.score, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time, p.pain_id) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time > m.admin_time AND date_diff('microsecond', m.admin_time, p.documented_time) <= 86400000000) "
    "SELECT m.mar_id, b.score AS score_before, a.score AS score_after, b.score - a.score AS pain_drop, b.score - a.score < 2 AS pain_not_dropping "
    "FROM mar m LEFT JOIN b ON b.mar_id = m.mar_id AND b.rn = 1 LEFT JOIN a ON a.mar_id = m.mar_id AND a.rn = 1",
    "mar pain",
)
def _(t):
    from tidewatch.plans.diversion import Windows, describe_administrations

    w = Windows(pain_before_s=86_400, pain_after_s=86_400)
    return describe_administrations(t.mar, t.rx, t.pain, windows=w).select(
        "mar_id", "score_before", "score_after", "pain_drop", "pain_not_dropping"
    )


@query(
    "days_off_not_worked",
    "WITH off AS (SELECT provider_id, unnest(generate_series(start_date, coalesce(end_date, DATE '2026-09-28'), INTERVAL 1 DAY))::DATE AS work_date FROM pto WHERE status = 'approved') "
    "SELECT a.assignment_id, a.provider_id, a.work_date FROM asg a WHERE NOT EXISTS (SELECT 1 FROM off o WHERE o.provider_id = a.provider_id AND o.work_date = a.work_date)",
    "asg pto",
)
def _(t):
    last = F.date_add(F.lit(BLOCK_START).cast("date"), BLOCK_DAYS - 1)
    kept = ranges.drop_covered_days(
        t.asg.select("assignment_id", "provider_id", "work_date"), ["provider_id"], "work_date",
        t.pto.where("status = 'approved'"), "start_date", "end_date", last,
    )
    return kept.select("assignment_id", "provider_id", "work_date")


@query(
    "leave_days_by_period",
    "WITH cal AS (SELECT CAST(i AS INTEGER) AS seq, CAST(DATE '1994-12-19' + CAST(i * 14 AS INTEGER) AS DATE) AS a, CAST(DATE '1994-12-19' + CAST(i * 14 + 13 AS INTEGER) AS DATE) AS b FROM range(190) r(i)), "
    "e AS (SELECT employee_id, start_date AS s, coalesce(end_date, (SELECT max(b) FROM cal)) AS e FROM leave) "
    "SELECT seq, count(*) AS n_events, CAST(sum(date_diff('day', greatest(s, a), least(e, b)) + 1) AS BIGINT) AS overlap_days FROM e JOIN cal ON s <= b AND e >= a GROUP BY seq",
    "leave",
)
def _(t):
    from tidewatch.workload.bindings import CALENDAR

    spread = ranges.overlap_join(t.leave, CALENDAR, "start_date", "end_date")
    return spread.groupBy("seq").agg(F.count(F.lit(1)).alias("n_events"), F.sum("overlap_days").alias("overlap_days"))


@query(
    "order_days_by_pay_period",
    "SELECT o_orderpriority, CAST(floor(date_diff('day', DATE '1994-12-19', CAST(o_orderdate AS DATE)) / 14.0) AS INTEGER) AS seq, count(*) AS n FROM orders "
    "GROUP BY 1, 2",
)
def _(t):
    from tidewatch.workload.bindings import CALENDAR

    cal = CALENDAR.frame(t.spark).select("seq", F.explode(F.sequence("start_date", "end_date")).alias("day"))
    days = t.raw("orders").select("o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    per_day = days.groupBy("o_orderpriority", "day").agg(F.count(F.lit(1)).alias("_n"))
    return per_day.join(cal, "day").groupBy("o_orderpriority", "seq").agg(F.sum("_n").alias("n"))


@query(
    "recently_seen_patients",
    "SELECT DISTINCT patient_id FROM lab WHERE patient_id IN (SELECT patient_id FROM enc WHERE encounter_date > DATE '2001-08-01' - 90 AND encounter_date <= DATE '2001-08-01')",
    "lab enc",
)
def _(t):
    seen = temporal.recently_active(t.lab.select("patient_id").distinct(), t.enc, "patient_id", "encounter_date", "2001-08-01", 90)
    return seen


@query(
    "work_orders_last_12_months",
    "SELECT asset_number, count(*) AS wo_count, CAST(sum(CAST(round(cost * 100) AS BIGINT)) FILTER (wo_type = 'Repair') AS BIGINT) / CAST(100 AS DOUBLE) AS repair_cost, "
    "sum(downtime_hours) AS downtime_hours FROM wo WHERE wo_date > DATE '1999-01-01' AND wo_date <= DATE '2000-01-01' GROUP BY asset_number",
    "wo",
)
def _(t):
    from tidewatch.functions.scalars import money_sum

    return temporal.trailing_rollup(
        t.wo, ["asset_number"], "wo_date", "2000-01-01", 12,
        [
            F.count(F.lit(1)).alias("wo_count"),
            money_sum(F.when(F.col("wo_type") == "Repair", F.col("cost"))).alias("repair_cost"),
            F.sum("downtime_hours").alias("downtime_hours"),
        ],
    )
