"""Shift-scheduling pack on whole tables: all customers as providers, all orders as demand, duty or leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import rules
from tidewatch.plans import scheduling as H
from tidewatch.sources.tables import staging
from tidewatch.workload.bindings import BLOCK_DAYS, BLOCK_START
from tidewatch.workload.registry import query

BLOCK = H.Block(BLOCK_START, BLOCK_DAYS // 2, 2)
USES = "prov asg cov pto pref rul"

_RULES = (
    "tr AS (SELECT rule_id, rule_type, applies_to, CASE WHEN rule_type IN ('no_night_then_day', 'night_differential') THEN CASE param_value WHEN 'true' THEN 1.0::DOUBLE WHEN 'false' THEN 0.0::DOUBLE END "
    "ELSE try_cast(param_value AS DOUBLE) END AS value FROM rul), "
    "rv AS (SELECT p.provider_id, r.rule_type, r.rule_id, r.value, CASE WHEN r.applies_to = 'all' THEN 'all' WHEN r.applies_to = p.service_line THEN 'group' ELSE 'entity' END AS scope_used FROM prov p "
    "JOIN tr r ON r.applies_to IN ('all', p.service_line, CAST(p.provider_id AS VARCHAR)) WHERE r.value IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY p.provider_id, r.rule_type ORDER BY CASE WHEN r.applies_to = CAST(p.provider_id AS VARCHAR) THEN 1 WHEN r.applies_to = p.service_line THEN 2 ELSE 3 END, "
    "CASE WHEN r.rule_type LIKE 'max%' THEN r.value ELSE -r.value END, r.rule_id) = 1)"
)
_OFF = (
    "unnest(generate_series(start_date, least(coalesce(end_date, DATE '2026-09-28'), DATE '2026-09-28'), INTERVAL 1 DAY))::DATE AS d"
)
_FACTS = (
    f"{_RULES}, offd AS (SELECT DISTINCT provider_id, {_OFF} FROM pto WHERE status = 'approved'), wish AS (SELECT DISTINCT provider_id, {_OFF} FROM pto WHERE status = 'requested'), "
    "pm AS (SELECT provider_id, min(max_shifts_per_block) AS own, bool_or(wants_consecutive) AS wc FROM pref GROUP BY 1), "
    "fx AS (SELECT p.*, least((SELECT value FROM rv WHERE rv.provider_id = p.provider_id AND rule_type = 'max_consecutive'), max_consecutive_shifts) AS max_run, "
    "greatest((SELECT value FROM rv WHERE rv.provider_id = p.provider_id AND rule_type = 'min_rest_hours'), min_rest_hours) AS rest_hours, "
    "least((SELECT value FROM rv WHERE rv.provider_id = p.provider_id AND rule_type = 'max_shifts_per_block') * fte, own) AS block_max, "
    "(SELECT value FROM rv WHERE rv.provider_id = p.provider_id AND rule_type = 'min_shifts_per_block') * fte AS block_min, wc FROM prov p LEFT JOIN pm USING (provider_id)), "
    "cv AS (SELECT *, CASE WHEN unit IN ('icu', 'cardiology') THEN unit ELSE 'general' END AS req FROM cov), "
    "el AS (SELECT c.*, f.provider_id, f.seniority_years, coalesce(w.preference_weight, 0) AS preference_weight, "
    "EXISTS (SELECT 1 FROM wish x WHERE x.provider_id = f.provider_id AND x.d = c.work_date) AS asked_off FROM cv c JOIN fx f ON f.site = c.site AND list_contains(f.credentials, c.req) "
    "LEFT JOIN pref w ON w.provider_id = f.provider_id AND w.shift_type = c.shift_type AND w.weekday = strftime(c.work_date, '%a') "
    "WHERE (c.shift_type <> 'night' OR f.wants_night_differential) AND NOT EXISTS (SELECT 1 FROM offd o WHERE o.provider_id = f.provider_id AND o.d = c.work_date)), "
    "sc AS (SELECT *, preference_weight * (1 + 0.01::DOUBLE * seniority_years) - CASE WHEN asked_off THEN 3 ELSE 0 END AS score FROM el)"
)


def _facts(t):
    """Provider facts are read by every rule, so they are written once and read back."""
    return staging(t.spark, "providers")(H.provider_facts(t.prov, t.rul, t.pto, t.pref, BLOCK), "facts")


@query("rules_in_force", f"WITH {_RULES} SELECT provider_id, rule_type, rule_id, value, scope_used FROM rv", "prov rul")
def _(t):
    return rules.resolve_rules(t.rul, t.prov, "provider_id", "service_line")


@query(
    "providers_per_credential",
    "SELECT credential, count(*) AS n_providers FROM (SELECT unnest(credentials) AS credential FROM prov) GROUP BY 1",
    "prov",
)
def _(t):
    return t.prov.select(F.explode("credentials").alias("credential")).groupBy("credential").agg(
        F.count(F.lit(1)).alias("n_providers")
    )


@query(
    "required_heads_by_shift",
    "SELECT shift_type, CAST(sum(required_headcount) AS BIGINT) AS total_slots FROM cov GROUP BY 1 ORDER BY 1",
    "cov",
)
def _(t):
    return t.cov.groupBy("shift_type").agg(F.sum("required_headcount").alias("total_slots")).orderBy("shift_type")


@query(
    "eligible_providers_per_slot",
    f"WITH {_FACTS} SELECT site, work_date, shift_type, unit, count(*) AS n_eligible, CAST(sum(provider_id) AS BIGINT) AS id_sum FROM el GROUP BY 1, 2, 3, 4",
    USES,
)
def _(t):
    return H.eligible(t.cov, _facts(t)).groupBy(*H.SLOT).agg(
        F.count(F.lit(1)).alias("n_eligible"), F.sum("provider_id").alias("id_sum")
    )


@query(
    "best_candidates_per_slot",
    f"WITH {_FACTS} SELECT site, work_date, shift_type, unit, provider_id, preference_weight, asked_off, round(score, 6) AS score, "
    "CAST(row_number() OVER (PARTITION BY site, work_date, shift_type, unit ORDER BY score DESC, provider_id) AS INTEGER) AS candidate_rank FROM sc "
    "QUALIFY row_number() OVER (PARTITION BY site, work_date, shift_type, unit ORDER BY score DESC, provider_id) <= required_headcount",
    USES,
)
def _(t):
    top = H.top_candidates(H.scored_candidates(t.cov, _facts(t)))
    return top.drop("required_headcount").withColumn("score", F.round("score", 6))


@query(
    "coverage_fill",
    "SELECT c.site, c.work_date, c.shift_type, c.unit, c.required_headcount, coalesce(a.n, 0) AS assigned, greatest(c.required_headcount - coalesce(a.n, 0), 0) AS shortfall "
    "FROM cov c LEFT JOIN (SELECT site, work_date, shift_type, unit, count(*) AS n FROM asg GROUP BY 1, 2, 3, 4) a USING (site, work_date, shift_type, unit)",
    "asg cov",
)
def _(t):
    return H.coverage_fill(t.cov, t.asg).drop("required_credential")


@query(
    "site_tightness",
    "SELECT site, d.demand, c.capacity, d.demand / c.capacity AS tightness FROM (SELECT site, CAST(sum(required_headcount) AS BIGINT) AS demand FROM cov GROUP BY 1) d "
    "FULL JOIN (SELECT site, round(sum(fte) * 20, 6) AS capacity FROM prov GROUP BY 1) c USING (site)",
    "cov prov",
)
def _(t):
    out = H.tightness(t.cov, t.prov).withColumn("capacity", F.round("capacity", 6))
    return out.withColumn("tightness", F.try_divide(F.col("demand"), F.col("capacity")))


_CHAIN = (
    "tm AS (SELECT a.*, CAST(work_date AS TIMESTAMP) + INTERVAL 1 HOUR * (CASE shift_type WHEN 'day' THEN 7 WHEN 'night' THEN 19 ELSE 12 END) AS s FROM asg a), "
    "ch AS (SELECT *, lag(s) OVER w + INTERVAL 12 HOUR AS pe, lag(shift_type) OVER w AS ps, lag(work_date) OVER w AS pd FROM tm WINDOW w AS (PARTITION BY provider_id ORDER BY s, assignment_id)), "
    "en AS (SELECT ch.*, date_diff('microsecond', pe, s) / 3600000000::DOUBLE AS gap, f.credentials, f.rest_hours, f.wants_night_differential AS opted, "
    "CASE WHEN ch.unit IN ('icu', 'cardiology') THEN ch.unit ELSE 'general' END AS req FROM ch JOIN fx f ON f.provider_id = ch.provider_id)"
)


def _v(rule: str, src: str, cond: str, ref: str, at: str, m: str = "NULL", lim: str = "NULL", ent: str = "CAST(provider_id AS VARCHAR)") -> str:
    return (
        f"SELECT '{rule}' AS rule, {ent} AS entity_id, CAST({ref} AS VARCHAR) AS ref_id, CAST({at} AS TIMESTAMP) AS event_time, CAST({m} AS DOUBLE) AS measure, CAST({lim} AS DOUBLE) AS limit_value FROM {src} WHERE {cond}"
    )


_VIOLATIONS = {
    "credential_missing": _v("credential_missing", "en", "NOT list_contains(credentials, req)", "assignment_id", "work_date"),
    "min_rest": _v("min_rest", "en", "gap < rest_hours", "assignment_id", "work_date", "gap", "rest_hours"),
    "night_then_day": _v("night_then_day", "en", "shift_type = 'day' AND ps = 'night' AND date_diff('day', pd, work_date) = 1", "assignment_id", "work_date"),
    "night_without_optin": _v("night_without_optin", "en", "shift_type = 'night' AND NOT opted", "assignment_id", "work_date"),
    "on_approved_leave": _v("on_approved_leave", "asg", "EXISTS (SELECT 1 FROM offd o WHERE o.provider_id = asg.provider_id AND o.d = asg.work_date)", "assignment_id", "work_date"),
    "max_consecutive": _v(
        "max_consecutive",
        "(SELECT i.provider_id, min(work_date) AS a, count(*) AS n, any_value(f.max_run) AS lim FROM (SELECT *, work_date - CAST(row_number() OVER (PARTITION BY provider_id ORDER BY work_date) AS INTEGER) AS g "
        "FROM (SELECT DISTINCT provider_id, work_date FROM asg)) i JOIN fx f ON f.provider_id = i.provider_id GROUP BY i.provider_id, g)",
        "n > lim", "a", "a", "n", "lim",
    ),
    "above_block_max": _v("above_block_max", "bc", "n > block_max", "block", "CAST(DATE '2026-09-01' + block * 14 AS DATE)", "n", "block_max"),
    "below_block_min": _v("below_block_min", "bc", "n < block_min", "block", "CAST(DATE '2026-09-01' + block * 14 AS DATE)", "n", "block_min"),
    "two_shifts_one_date": _v("two_shifts_one_date", "(SELECT provider_id, work_date, count(*) AS n FROM asg GROUP BY 1, 2)", "n > 1", "work_date", "work_date", "n", "1"),
    "coverage_shortfall": _v(
        "coverage_shortfall",
        "(SELECT c.*, coalesce(a.n, 0) AS n FROM cov c LEFT JOIN (SELECT site, work_date, shift_type, unit, count(*) AS n FROM asg GROUP BY 1, 2, 3, 4) a USING (site, work_date, shift_type, unit))",
        "n < required_headcount", "work_date", "work_date", "n", "required_headcount", "concat(site, '|', shift_type, '|', unit)",
    ),
}
_AUDIT = (
    f"{_FACTS}, {_CHAIN}, bc AS (SELECT f.provider_id, f.block_max, f.block_min, b.block, coalesce(a.n, 0) AS n FROM fx f CROSS JOIN (VALUES (0), (1)) b(block) LEFT JOIN (SELECT provider_id, CAST(work_date - DATE '2026-09-01' AS INTEGER) // 14 AS block, count(*) AS n FROM asg GROUP BY 1, 2) a ON a.provider_id = f.provider_id AND a.block = b.block), "
    f"au AS ({' UNION ALL '.join(_VIOLATIONS.values())})"
)


def _audit(t):
    return H.audit(H.by_provider(t.asg), _facts(t), t.cov, BLOCK)


@query("schedule_audit", f"WITH {_AUDIT} SELECT * FROM au", USES)
def _(t):
    return _audit(t)


@query("schedule_audit_counts", f"WITH {_AUDIT} SELECT rule, count(*) AS n FROM au GROUP BY 1", USES)
def _(t):
    return _audit(t).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


_PARTS = {
    "assignment": (
        ("credential_missing", "min_rest", "night_then_day", "night_without_optin", "on_approved_leave"),
        lambda t: rules.fire(H.enriched_assignments(H.by_provider(t.asg), _facts(t)), "provider_id", H.assignment_rules()),
    ),
    "run": (("max_consecutive",), lambda t: H.run_violations(H.by_provider(t.asg), _facts(t))),
    "block": (("above_block_max", "below_block_min"), lambda t: H.block_violations(H.by_provider(t.asg), _facts(t), BLOCK)),
    "double_booking": (("two_shifts_one_date",), lambda t: H.double_bookings(t.asg)),
    "coverage": (("coverage_shortfall",), lambda t: H.coverage_violations(t.cov, t.asg)),
}
for _part, (_names, _frame) in _PARTS.items():
    _in = ", ".join(f"'{n}'" for n in _names)
    query(f"violations_{_part}", f"WITH {_AUDIT} SELECT * FROM au WHERE rule IN ({_in})", USES)(_frame)


@query(
    "rest_before_each_shift",
    f"WITH {_FACTS}, {_CHAIN} SELECT assignment_id, provider_id, gap AS gap_hours, ps AS prev_shift FROM en",
    USES,
)
def _(t):
    return H.enriched_assignments(H.by_provider(t.asg), _facts(t)).select("assignment_id", "provider_id", "gap_hours", "prev_shift")


@query(
    "night_and_weekend_equity",
    "WITH p AS (SELECT a.site, a.provider_id, max(fte) AS fte, count(*) FILTER (shift_type = 'night') AS n, count(*) FILTER (dayofweek(work_date) IN (0, 6)) AS w FROM asg a JOIN prov USING (provider_id) GROUP BY 1, 2) "
    "SELECT site, count(*) AS n_entities, CAST(sum(n) AS BIGINT) AS nights_total, round(avg(n / fte), 6) AS nights_mean, round(stddev_samp(n / fte), 6) AS nights_sd, round(max(n / fte) - min(n / fte), 6) AS nights_range, "
    "CAST(sum(w) AS BIGINT) AS weekends_total, round(avg(w / fte), 6) AS weekends_mean, round(stddev_samp(w / fte), 6) AS weekends_sd, round(max(w / fte) - min(w / fte), 6) AS weekends_range FROM p GROUP BY 1",
    "asg prov",
)
def _(t):
    out = H.equity(t.asg, t.prov, ["site"])
    for c in ("nights_mean", "nights_sd", "nights_range", "weekends_mean", "weekends_sd", "weekends_range"):
        out = out.withColumn(c, F.round(c, 6))
    return out


_SOFT = (
    f"{_FACTS}, sj AS (SELECT a.*, coalesce(w.preference_weight, 0) AS pw, f.fte FROM asg a JOIN fx f ON f.provider_id = a.provider_id LEFT JOIN pref w ON w.provider_id = a.provider_id AND w.shift_type = a.shift_type "
    "AND w.weekday = strftime(a.work_date, '%a')), "
    "sb AS (SELECT site, count(*) AS n_shifts, CAST(sum(pw) AS BIGINT) AS preference_points, round(avg(CASE WHEN pw > 0 THEN 1 ELSE 0 END), 6) AS liked_share, "
    "count(*) FILTER (EXISTS (SELECT 1 FROM wish x WHERE x.provider_id = sj.provider_id AND x.d = sj.work_date)) AS asked_off_worked FROM sj GROUP BY 1), "
    "si AS (SELECT site, count(*) FILTER (n = 1 AND wc) AS isolated_shifts FROM (SELECT i.site, i.provider_id, count(*) AS n, any_value(f.wc) AS wc FROM (SELECT *, work_date - CAST(row_number() OVER (PARTITION BY provider_id ORDER BY work_date) AS INTEGER) AS g "
    "FROM (SELECT DISTINCT site, provider_id, work_date FROM asg)) i JOIN fx f ON f.provider_id = i.provider_id GROUP BY i.site, i.provider_id, g) GROUP BY 1)"
)


@query(
    "schedule_soft_score",
    f"WITH {_SOFT} SELECT site, n_shifts, preference_points, liked_share, asked_off_worked, isolated_shifts FROM sb LEFT JOIN si USING (site)",
    USES,
)
def _(t):
    out = H.soft_score(H.by_provider(t.asg), _facts(t)).withColumn("liked_share", F.round("liked_share", 6))
    return out.select("site", "n_shifts", "preference_points", "liked_share", "asked_off_worked", "isolated_shifts")


# --- drafts: an auction to a fixed point, so rows only; its audit and its blocking pairs are checked here and in the tests ------


def _draft(t, facts, run_id="run-1"):
    return H.draft(t.cov, facts, BLOCK, run_id)


@query("draft_schedule")
def _(t):
    facts = _facts(t)
    rows = _draft(t, facts)
    return H.with_hard_ok(rows, H.audit(H.by_provider(H.draft_as_assignments(rows)), facts, t.cov, BLOCK))


@query(
    "draft_hard_rule_violations",
    "SELECT rule, CAST(0 AS BIGINT) AS n FROM (VALUES ('credential_missing'), ('min_rest'), ('night_then_day'), ('night_without_optin'), ('on_approved_leave'), ('max_consecutive'), "
    "('above_block_max'), ('two_shifts_one_date')) v(rule)",
)
def _(t):
    """A draft may leave seats open, but must break no other hard rule: every count is zero."""
    facts = _facts(t)
    found = H.audit(H.by_provider(H.draft_as_assignments(_draft(t, facts))), facts, t.cov, BLOCK).groupBy("rule").agg(
        F.count(F.lit(1)).alias("_n")
    )
    hard = ["credential_missing", "min_rest", "night_then_day", "night_without_optin", "on_approved_leave",
            "max_consecutive", "above_block_max", "two_shifts_one_date"]
    names = t.spark.range(1).select(F.explode(F.array(*[F.lit(h) for h in hard])).alias("rule"))
    return names.join(found, "rule", "left").select("rule", F.coalesce("_n", F.lit(0)).alias("n"))


@query("draft_blocking_pairs", "SELECT CAST(0 AS BIGINT) AS n_blocking, CAST(0 AS BIGINT) AS n_overfilled")
def _(t):
    """No slot and provider are left apart that would both rather have each other; no slot has more heads than it needs."""
    facts = _facts(t)
    drafted = _draft(t, facts)
    over = drafted.groupBy(*H.SLOT).agg(F.count(F.lit(1)).alias("n")).join(
        t.cov.groupBy(*H.SLOT).agg(F.max("required_headcount").alias("heads")), H.SLOT
    ).where("n > heads")
    blocking = H.blocking_pairs(drafted, t.cov, facts, BLOCK)
    both = blocking.select(F.lit(1).alias("b"), F.lit(0).alias("o")).union(over.select(F.lit(0), F.lit(1)))
    return both.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("n_blocking"), F.coalesce(F.sum("o"), F.lit(0)).alias("n_overfilled"))


@query("draft_run_record")
def _(t):
    facts = _facts(t)
    drafted = _draft(t, facts)
    rows = H.by_provider(H.draft_as_assignments(drafted))
    return H.run_record(
        drafted, H.audit(rows, facts, t.cov, BLOCK), H.soft_score(rows, facts), "run-1", {"block_start": BLOCK_START}
    )


@query("draft_what_if_leave")
def _(t):
    """Requested leave granted as well: redraft and list what changes."""
    facts = _facts(t)
    granted = t.pto.withColumn("status", F.when(F.col("status") == "requested", "approved").otherwise(F.col("status")))
    after = staging(t.spark, "providers")(H.provider_facts(t.prov, t.rul, granted, t.pref, BLOCK), "granted")
    return H.diff(_draft(t, facts), H.draft(t.cov, after, BLOCK, "run-2"))


@query("draft_against_history")
def _(t):
    facts = _facts(t)
    return H.compare_soft(H.by_provider(t.asg), H.by_provider(H.draft_as_assignments(_draft(t, facts))), facts)


@query("draft_reasons")
def _(t):
    return H.why_text(H.draft(t.cov, _facts(t), BLOCK, "run-1"))
