"""Controlled-substance pack on whole tables. Match window 24 h, pain windows 24 h, five peers at least."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import cohort, metrics, rules
from tidewatch.plans import diversion as D
from tidewatch.sources.tables import staging
from tidewatch.workload.q_history import MATCH_SQL
from tidewatch.workload.registry import query

W = D.Windows(dispense_s=86_400, pain_before_s=86_400, pain_after_s=86_400, slow_gap_s=43_200)
MIN_PEERS = 10
SHAPES = "staff txn mar pain risk rx"

# --- the same chain in SQL: pairs removed until none is left, pain by ranked joins ---------------
_LINK = (
    MATCH_SQL
    + ", link AS (SELECT t.*, r.mar_id, CAST(r.us AS DOUBLE) / 1000000 AS gap_s FROM txn t LEFT JOIN matched r ON r.txn_id = t.txn_id WHERE t.txn_type = 'dispense')"
)
_ADMIN = (
    "pb AS (SELECT m.mar_id, p.score, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time DESC, p.pain_id DESC) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time <= m.admin_time AND date_diff('microsecond', p.documented_time, m.admin_time) <= 86400000000), "
    "pa AS (SELECT m.mar_id, p.score, row_number() OVER (PARTITION BY m.mar_id ORDER BY p.documented_time, p.pain_id) AS rn "
    "FROM mar m JOIN pain p ON p.patient_id = m.patient_id AND p.documented_time > m.admin_time AND date_diff('microsecond', m.admin_time, p.documented_time) <= 86400000000), "
    "adm AS (SELECT m.*, rx.dose, m.admin_amount / rx.dose AS dose_ratio, b.score AS score_before, a.score AS score_after, b.score IS NOT NULL AND a.score IS NOT NULL AS documented "
    "FROM mar m LEFT JOIN rx ON rx.order_id = m.order_id LEFT JOIN pb b ON b.mar_id = m.mar_id AND b.rn = 1 LEFT JOIN pa a ON a.mar_id = m.mar_id AND a.rn = 1)"
)
_FEATURES = (
    "c AS (SELECT staff_id, strftime(ts, '%Y-%m') AS period, count(*) FILTER (txn_type = 'dispense') AS nd, count(*) FILTER (txn_type = 'waste') AS nw, "
    "CAST(sum(CAST(round(amount * 1000) AS BIGINT)) FILTER (txn_type = 'dispense') AS DOUBLE) AS ad, CAST(sum(CAST(round(amount * 1000) AS BIGINT)) FILTER (txn_type = 'waste') AS DOUBLE) AS aw, "
    "count(*) FILTER (txn_type = 'waste' AND witness_id IS NULL) AS nww, count(*) FILTER (txn_type = 'dispense' AND (hour(ts) < 7 OR hour(ts) >= 19)) AS nah, "
    "count(*) FILTER (txn_type = 'dispense' AND is_override) AS nov FROM txn GROUP BY 1, 2), "
    "l AS (SELECT staff_id, strftime(ts, '%Y-%m') AS period, count(*) FILTER (mar_id IS NULL) AS nna, quantile_cont(CAST(round(gap_s) AS BIGINT), 0.5) AS med FROM link GROUP BY 1, 2), "
    "a AS (SELECT staff_id, strftime(admin_time, '%Y-%m') AS period, count(*) AS na, count(*) FILTER (documented) AS np, count(*) FILTER (documented AND score_before - score_after < 2) AS nf, "
    "avg(abs(dose_ratio - 1)) AS dev FROM adm GROUP BY 1, 2), "
    "keys AS (SELECT staff_id, period FROM c UNION SELECT staff_id, period FROM a), "
    "feat AS (SELECT k.staff_id, k.period, coalesce(nd, 0) AS n_dispense, coalesce(nw, 0) AS n_waste, coalesce(na, 0) AS n_admin, "
    "CASE WHEN nd > 0 THEN nw / nd::DOUBLE END AS waste_count_ratio, CASE WHEN ad > 0 THEN coalesce(aw, 0) / ad END AS waste_amount_ratio, "
    "CASE WHEN nw > 0 THEN nww / nw::DOUBLE END AS waste_no_witness_pct, coalesce(nna, 0) AS dispense_no_admin, CASE WHEN np > 0 THEN nf / np::DOUBLE END AS pain_not_dropping_pct, "
    "CASE WHEN nd > 0 THEN nah / nd::DOUBLE END AS after_hours_pct, CASE WHEN nd > 0 THEN nov / nd::DOUBLE END AS override_pct, dev AS dose_deviation, med AS median_gap_s "
    "FROM keys k LEFT JOIN c USING (staff_id, period) LEFT JOIN l USING (staff_id, period) LEFT JOIN a USING (staff_id, period))"
)
_FEAT_COLS = ", ".join(f"('{f}', {f}::DOUBLE)" for f in D.FEATURES)
_SCORES = (
    f"lng AS (SELECT f.staff_id, f.period, s.role, s.unit, v.feature, v.value FROM feat f JOIN staff s USING (staff_id) CROSS JOIN LATERAL (VALUES {_FEAT_COLS}) AS v(feature, value)), "
    "l1 AS (SELECT x.staff_id, x.period, x.feature, count(y.value) AS n, avg(y.value) AS mu, CASE WHEN count(y.value) > 1 THEN stddev_samp(y.value) END AS sd, min(y.value) AS lo, max(y.value) AS hi "
    "FROM lng x LEFT JOIN lng y ON y.role = x.role AND y.unit = x.unit AND y.period = x.period AND y.feature = x.feature AND y.staff_id <> x.staff_id GROUP BY 1, 2, 3), "
    "l2 AS (SELECT x.staff_id, x.period, x.feature, count(y.value) AS n, avg(y.value) AS mu, CASE WHEN count(y.value) > 1 THEN stddev_samp(y.value) END AS sd, min(y.value) AS lo, max(y.value) AS hi "
    "FROM lng x LEFT JOIN lng y ON y.role = x.role AND y.period = x.period AND y.feature = x.feature AND y.staff_id <> x.staff_id GROUP BY 1, 2, 3), "
    "pk AS (SELECT g.staff_id, g.period, g.feature, g.value, CASE WHEN a.n >= 10 THEN 'role+unit+period' ELSE 'role+period' END AS cohort_level, CASE WHEN a.n >= 10 THEN a.n ELSE b.n END AS n_peers, "
    "CASE WHEN a.n >= 10 THEN a.mu ELSE b.mu END AS mu, CASE WHEN a.n >= 10 THEN a.sd ELSE b.sd END AS sd, CASE WHEN a.n >= 10 THEN a.lo ELSE b.lo END AS lo, CASE WHEN a.n >= 10 THEN a.hi ELSE b.hi END AS hi "
    "FROM lng g JOIN l1 a USING (staff_id, period, feature) JOIN l2 b USING (staff_id, period, feature)), "
    "sc AS (SELECT staff_id, period, feature, value, cohort_level, n_peers, mu, CASE WHEN lo = hi THEN 0 ELSE sd END AS sd, CASE WHEN lo < hi AND sd > 0 THEN (value - mu) / sd END AS z, "
    "coalesce(lo = hi AND value <> lo, false) AS const_peers FROM pk), "
    "bl AS (SELECT g.*, r.risk_score, 0.8::DOUBLE * coalesce(mean_positive_z, 0) + 0.2::DOUBLE * coalesce(risk_score, 0) / 100 AS blended FROM (SELECT staff_id, period, "
    "avg(CASE WHEN const_peers THEN CASE WHEN value > mu THEN 3.0::DOUBLE ELSE 0 END WHEN z IS NOT NULL THEN greatest(z, 0) END) AS mean_positive_z, max(z) AS max_z, count(*) FILTER (const_peers) AS n_const_peers FROM sc GROUP BY 1, 2) g LEFT JOIN risk r USING (staff_id, period))"
)


def _linked(t):
    return D.link_dispenses(t.txn, t.mar, ["staff_id"], "ts", W)


def _admin(t):
    return D.describe_administrations(t.mar, t.rx, t.pain, windows=W)


def _features(t):
    return D.features(t.txn, _linked(t), _admin(t), "ts")


def _scores(t):
    """The feature table feeds five aggregates, so it is written once and read back."""
    feats = staging(t.spark, "features")(_features(t), "staff_month")
    return D.peer_scores(feats, t.staff, MIN_PEERS)


def _blended(t):
    return D.blended_score(_scores(t), t.risk)


def _flags(t):
    return D.flags(t.txn, _linked(t), _admin(t), "ts", W)


@query(
    "linked_dispenses",
    f"WITH RECURSIVE {_LINK}, {_ADMIN} SELECT l.txn_id, l.staff_id, l.mar_id, l.gap_s, a.dose, a.dose_ratio, a.score_before, a.score_after FROM link l LEFT JOIN adm a ON a.mar_id = l.mar_id",
    SHAPES,
)
def _(t):
    return D.link(t.txn, t.mar, t.rx, t.pain, ["staff_id"], "ts", W).select(
        "txn_id", "staff_id", "mar_id", "gap_s", "dose", "dose_ratio", "score_before", "score_after"
    )


@query(
    "given_against_ordered_dose",
    "SELECT r.order_id, r.dose, count(g.order_id) AS n_given, count(*) FILTER (g.admin_amount > r.dose) AS n_above, max(g.admin_amount / r.dose) AS max_ratio "
    "FROM given g LEFT JOIN rx r ON r.order_id = g.order_id GROUP BY 1, 2",
    "rx given",
)
def _(t):
    j = t.given.join(t.rx.select("order_id", "dose"), "order_id", "left")
    return j.groupBy("order_id", "dose").agg(
        F.count(F.lit(1)).alias("n_given"),
        F.count_if(F.col("admin_amount") > F.col("dose")).alias("n_above"),
        F.max(F.col("admin_amount") / F.col("dose")).alias("max_ratio"),
    )


@query(
    "staff_month_features",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES} SELECT * REPLACE (round(dose_deviation, 6) AS dose_deviation) FROM feat",
    SHAPES,
)
def _(t):
    return _features(t).withColumn("dose_deviation", F.round("dose_deviation", 6))


def _flag_sql(rule: str, source: str, cond: str, ref: str, time: str, measure: str, limit: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, CAST(staff_id AS VARCHAR) AS entity_id, CAST({ref} AS VARCHAR) AS ref_id, {time} AS event_time, "
        f"CAST({measure} AS DOUBLE) AS measure, CAST({limit} AS DOUBLE) AS limit_value FROM {source} WHERE {cond}"
    )


RULE_SQL = {
    "waste_without_witness": _flag_sql("waste_without_witness", "txn", "txn_type = 'waste' AND witness_id IS NULL", "txn_id", "ts", "amount", "NULL"),
    "dispense_without_admin": _flag_sql("dispense_without_admin", "link", "mar_id IS NULL", "txn_id", "ts", "amount", "NULL"),
    "pain_not_dropping": _flag_sql("pain_not_dropping", "adm", "documented AND score_before - score_after < 2", "mar_id", "admin_time", "score_before - score_after", "2"),
    "pain_not_documented": _flag_sql("pain_not_documented", "adm", "NOT documented", "mar_id", "admin_time", "NULL", "NULL"),
    "slow_administration": _flag_sql("slow_administration", "link", "gap_s > 43200", "txn_id", "ts", "gap_s", "43200"),
    "after_hours": _flag_sql("after_hours", "txn", "txn_type = 'dispense' AND (hour(ts) < 7 OR hour(ts) >= 19)", "txn_id", "ts", "hour(ts)", "NULL"),
    "above_ordered_dose": _flag_sql("above_ordered_dose", "adm", "dose_ratio > 1.05::DOUBLE", "mar_id", "admin_time", "dose_ratio", "1.05"),
    "override_pull": _flag_sql("override_pull", "txn", "txn_type = 'dispense' AND is_override", "txn_id", "ts", "amount", "NULL"),
}
_ALL_FLAGS = f"fl AS ({' UNION ALL '.join(RULE_SQL.values())})"

def _one_rule(source, make):
    """Each rule on its own: the same specification, fired alone."""
    return {r: (lambda t, i=i: rules.fire(source(t), "staff_id", [make()[i]])) for i, r in enumerate(_NAMES[make])}


def _cabinet():
    return D.cabinet_rules("ts")


def _link_rules():
    return D.link_rules("ts", W)


def _administration():
    return D.administration_rules(W)


_NAMES = {
    _cabinet: ["waste_without_witness", "after_hours", "override_pull"],
    _link_rules: ["dispense_without_admin", "slow_administration"],
    _administration: ["pain_not_dropping", "pain_not_documented", "above_ordered_dose"],
}
_RULE_FRAMES = {
    **_one_rule(lambda t: t.txn, _cabinet),
    **_one_rule(_linked, _link_rules),
    **_one_rule(_admin, _administration),
}
for _name, _frame in _RULE_FRAMES.items():
    query(f"flag_{_name}", f"WITH RECURSIVE {_LINK}, {_ADMIN} {RULE_SQL[_name]}", SHAPES)(_frame)


@query("all_flags_with_evidence", f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_ALL_FLAGS} SELECT * FROM fl", SHAPES)
def _(t):
    return _flags(t)


@query(
    "flag_counts_per_staff",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_ALL_FLAGS} SELECT entity_id, " + ", ".join(f"count(*) FILTER (rule = '{n}') AS {n}" for n in RULE_SQL) + " FROM fl GROUP BY 1",
    SHAPES,
)
def _(t):
    return D.rule_counts(_flags(t))


@query(
    "override_share_per_staff",
    "SELECT staff_id, 100.0::DOUBLE * CAST(sum(CASE WHEN is_override THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS override_pct FROM txn WHERE txn_type = 'dispense' GROUP BY 1",
    "txn",
)
def _(t):
    dispenses = t.txn.where("txn_type = 'dispense'")
    return metrics.evaluate(dispenses, [metrics.percent_of("override_pct", F.col("is_override"))], ["staff_id"])


@query(
    "peer_scores",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES}, {_SCORES} SELECT staff_id, period, feature, round(value, 6) AS value, cohort_level, n_peers, round(mu, 6) AS peer_mean, round(sd, 6) AS peer_sd, "
    "round(z, 4) AS z, const_peers FROM sc",
    SHAPES,
)
def _(t):
    s = _scores(t)
    for c, n in (("value", 6), ("peer_mean", 6), ("peer_sd", 6), ("z", 4)):
        s = s.withColumn(c, F.round(c, n))
    return s.drop("role", "unit")


@query(
    "blended_staff_scores",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES}, {_SCORES} SELECT staff_id, period, round(mean_positive_z, 4) AS mean_positive_z, round(max_z, 4) AS max_z, n_const_peers, risk_score, "
    "round(blended, 4) AS blended FROM bl",
    SHAPES,
)
def _(t):
    b = _blended(t)
    for c in ("mean_positive_z", "max_z", "blended"):
        b = b.withColumn(c, F.round(c, 4))
    return b


@query(
    "top_staff_for_review",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES}, {_SCORES} SELECT staff_id, period, round(blended, 4) AS blended FROM bl ORDER BY bl.blended DESC, staff_id, period LIMIT 10",
    SHAPES,
)
def _(t):
    return D.top_staff(_blended(t), 10).select("staff_id", "period", F.round("blended", 4).alias("blended"))


@query(
    "planted_staff_in_top",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES}, {_SCORES}, b AS (SELECT staff_id, max(blended) AS s, any_value(is_planted_diverter) AS p FROM bl JOIN staff USING (staff_id) GROUP BY 1), "
    "top AS (SELECT * FROM b ORDER BY s DESC, staff_id LIMIT 10) SELECT count(*) FILTER (p) AS hits, count(*) AS k, (SELECT count(*) FILTER (p) FROM b) AS positives, "
    "count(*) FILTER (p) / count(*)::DOUBLE AS precision_at_k, count(*) FILTER (p) / (SELECT count(*) FILTER (p) FROM b)::DOUBLE AS recall_at_k FROM top",
    SHAPES,
)
def _(t):
    return D.planted_recall(_blended(t), t.staff, 10)


_TEXT = (
    "concat_ws('; ', CASE WHEN waste_without_witness > 0 THEN concat(waste_without_witness, ' waste records carry no witness') END, "
    "CASE WHEN dispense_without_admin > 0 THEN concat(dispense_without_admin, ' dispenses have no administration in the window') END, "
    "CASE WHEN pain_not_dropping > 0 THEN concat(pain_not_dropping, ' administrations were not followed by a lower pain score') END, "
    "CASE WHEN pain_not_documented > 0 THEN concat(pain_not_documented, ' administrations lack a pain score before or after') END, "
    "CASE WHEN slow_administration > 0 THEN concat(slow_administration, ' administrations came late after the dispense') END, "
    "CASE WHEN after_hours > 0 THEN concat(after_hours, ' dispenses were outside day hours') END, "
    "CASE WHEN above_ordered_dose > 0 THEN concat(above_ordered_dose, ' administrations exceed the ordered dose') END, "
    "CASE WHEN override_pull > 0 THEN concat(override_pull, ' dispenses were override pulls') END)"
)
_COUNTS = f"cnt AS (SELECT entity_id, {', '.join(f'count(*) FILTER (rule = {chr(39)}{n}{chr(39)}) AS {n}' for n in RULE_SQL)} FROM fl GROUP BY 1)"


@query(
    "staff_narratives",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_ALL_FLAGS}, {_COUNTS} SELECT entity_id, {_TEXT} AS narrative FROM cnt",
    SHAPES,
)
def _(t):
    return D.narrate_all(_flags(t)).select("entity_id", "narrative")


@query(
    "staff_report",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES}, {_SCORES}, f0 AS ({' UNION ALL '.join(RULE_SQL.values())}), "
    "fl AS (SELECT * FROM f0 WHERE entity_id = '8' AND CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'), "
    f"{_COUNTS} SELECT c.*, round(s.max_z, 4) AS max_z, round(s.blended, 4) AS blended, s.risk_score, DATE '2024-01-05' AS window_start, DATE '2024-01-25' AS window_end, {_TEXT} AS narrative, "
    "'draft for human review' AS status FROM cnt c LEFT JOIN (SELECT CAST(staff_id AS VARCHAR) AS entity_id, max(max_z) AS max_z, max(blended) AS blended, max(risk_score) AS risk_score FROM bl WHERE period = '2024-01' GROUP BY 1) s USING (entity_id)",
    SHAPES,
)
def _(t):
    scores = _scores(t)
    r = D.report("8", "2024-01-05", "2024-01-25", _flags(t), D.blended_score(scores, t.risk), scores).drop("findings")
    return r.withColumn("max_z", F.round("max_z", 4)).withColumn("blended", F.round("blended", 4))


@query(
    "staff_report_scores",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_FEATURES}, {_SCORES} SELECT CAST(staff_id AS VARCHAR) AS entity_id, period, feature, round(value, 6) AS value, "
    "round(mu, 6) AS peer_mean, round(z, 4) AS z, const_peers FROM sc WHERE staff_id = 8 AND period = '2024-01'",
    SHAPES,
)
def _(t):
    out = D.report_scores("8", "2024-01-05", "2024-01-25", _scores(t))
    return out.withColumn("value", F.round("value", 6)).withColumn("peer_mean", F.round("peer_mean", 6)).withColumn("z", F.round("z", 4))


@query(
    "staff_report_evidence",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_ALL_FLAGS} SELECT * FROM fl WHERE entity_id = '8' AND CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'",
    SHAPES,
)
def _(t):
    return D.report_evidence("8", "2024-01-05", "2024-01-25", _flags(t))


@query(
    "narrative_audit_rows",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_ALL_FLAGS}, {_COUNTS} SELECT 'investigator' AS actor, TIMESTAMP '2024-02-01 00:00:00' AS produced_at, entity_id, sha256({_TEXT}) AS narrative_hash, "
    f"{', '.join(RULE_SQL)} FROM cnt",
    SHAPES,
)
def _(t):
    rows = D.audit_rows(D.narrate_all(_flags(t)), "investigator", "2024-02-01 00:00:00")
    read = F.from_json("evidence", ", ".join(f"{n} bigint" for n in D.RULE_NAMES))
    return rows.withColumn("_e", read).select("actor", "produced_at", "entity_id", "narrative_hash", "_e.*")


@query(
    "restricted_flag_view",
    f"WITH RECURSIVE {_LINK}, {_ADMIN}, {_ALL_FLAGS} SELECT rule, sha256(entity_id) AS entity_id, ref_id, event_time, CAST(NULL AS DOUBLE) AS measure FROM fl "
    "WHERE entity_id IN (SELECT CAST(staff_id AS VARCHAR) FROM staff WHERE role = 'RN')",
    SHAPES,
)
def _(t):
    held = t.staff.where("role = 'RN'").select(F.lit("lead").alias("user"), F.col("staff_id").cast("string").alias("entity_id"))
    shown = _flags(t).select("rule", "entity_id", "ref_id", "event_time", "measure")
    return D.restricted_view(shown, held, "lead", "entity_id", {"entity_id": "hash", "measure": "null"})


@query(
    "waste_share_equity",
    "WITH p AS (SELECT s.role, t.staff_id, count(*) FILTER (t.txn_type = 'waste') AS w FROM txn t JOIN staff s USING (staff_id) GROUP BY 1, 2) "
    "SELECT role, count(*) AS n_entities, CAST(sum(w) AS BIGINT) AS waste_total, avg(w) AS waste_mean, round(stddev_samp(w), 6) AS waste_sd, CAST(max(w) - min(w) AS DOUBLE) AS waste_range FROM p GROUP BY 1",
    "staff txn",
)
def _(t):
    rows = t.txn.join(t.staff.select("staff_id", "role"), "staff_id").withColumn("fte", F.lit(1.0))
    out = cohort.equity_spread(rows, ["role"], "staff_id", {"waste": F.col("txn_type") == "waste"}, "fte")
    return out.withColumn("waste_sd", F.round("waste_sd", 6))
