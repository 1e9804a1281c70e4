"""Chronic-disease pack on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import cohort
from tidewatch.plans import chronic
from tidewatch.workload.registry import query

_CHRONIC = (
    "chronic AS (SELECT patient_id, count(*) AS n_low, min(lab_date) AS a, max(lab_date) AS b, min(value) AS lo FROM lab WHERE value < 60 GROUP BY 1 "
    "HAVING date_diff('day', min(lab_date), max(lab_date)) >= 90), coded AS (SELECT DISTINCT patient_id FROM dx WHERE icd10_code LIKE 'N18%')"
)


@query(
    "care_gap_summary",
    "SELECT count(*) FILTER (proven) AS patients_with_ckd_lab_evidence, count(*) FILTER (named) AS patients_coded_n18, "
    "count(*) FILTER (proven AND NOT named) AS care_gap_patients FROM (SELECT "
    "EXISTS (SELECT 1 FROM lab x JOIN lab y ON y.patient_id = x.patient_id WHERE x.patient_id = p.patient_id AND greatest(x.value, y.value) < 60 AND y.lab_date - x.lab_date >= 90) AS proven, "
    "EXISTS (SELECT 1 FROM dx d WHERE d.patient_id = p.patient_id AND starts_with(d.icd10_code, 'N18')) AS named "
    "FROM (SELECT patient_id FROM lab UNION SELECT patient_id FROM dx) p) flagged",
    "lab dx",
)
def _(t):
    return chronic.care_gap_summary(t.lab, t.dx)


@query(
    "care_gap_patients",
    f"WITH {_CHRONIC} SELECT patient_id, n_low AS n_breach, a AS first_breach, b AS last_breach FROM chronic WHERE patient_id NOT IN (SELECT patient_id FROM coded)",
    "lab dx",
)
def _(t):
    return chronic.care_gap_patients(t.lab, t.dx).select("patient_id", "n_breach", "first_breach", "last_breach")


@query(
    "care_gap_flags",
    f"WITH {_CHRONIC} SELECT c.patient_id, n_low AS n_breach, a AS first_breach, b AS last_breach, d.patient_id IS NULL AS care_gap_flag "
    "FROM chronic c LEFT JOIN coded d ON d.patient_id = c.patient_id",
    "lab dx",
)
def _(t):
    return chronic.care_gap_flags(t.lab, t.dx)


@query(
    "latest_stated_stage",
    "WITH s AS (SELECT patient_id, note_id, note_date, lower(regexp_extract(note_text, '(?i)(?:CKD|chronic kidney disease)\\s+(?:stage\\s+)?G?([1-5][ab]?)', 1)) AS st FROM note) "
    "SELECT patient_id, st AS note_stage, note_date AS note_stage_date FROM s WHERE st <> '' "
    "QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY note_date DESC, note_id DESC) = 1",
    "note",
)
def _(t):
    return chronic.latest_stated_stage(t.note)


_STAGE = (
    "CASE WHEN {v} >= 90 THEN 'G1' WHEN {v} >= 60 THEN 'G2' WHEN {v} >= 45 THEN 'G3a' WHEN {v} >= 30 THEN 'G3b' WHEN {v} >= 15 THEN 'G4' ELSE 'G5' END"
)
_LATEST = (
    "SELECT patient_id, value FROM {src} QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY lab_date DESC, lab_id DESC, value DESC) = 1"
)
_CANDIDATES = (
    f"{_CHRONIC}, latest AS (SELECT patient_id, value AS latest_egfr, lab_date AS latest_egfr_date FROM lab QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY lab_date DESC, lab_id DESC) = 1), "
    "trend AS (SELECT patient_id, count(*) AS n, date_diff('day', min(lab_date), max(lab_date)) AS span, regr_slope(value, date_diff('day', DATE '1970-01-01', lab_date) / 365.25) AS s FROM lab GROUP BY 1), "
    f"u AS ({_LATEST.format(src='uacr')}), k AS ({_LATEST.format(src='crea')}), "
    "st AS (SELECT patient_id, lower(regexp_extract(note_text, '(?i)(?:CKD|chronic kidney disease)\\s+(?:stage\\s+)?G?([1-5][ab]?)', 1)) AS s, note_date, note_id FROM note), "
    "ns AS (SELECT patient_id, s AS note_stage FROM st WHERE s <> '' QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY note_date DESC, note_id DESC) = 1), "
    f"j AS (SELECT c.patient_id, {_STAGE.format(v='latest_egfr')} AS suggested_stage, CASE WHEN u.value < 30 THEN 'A1' WHEN u.value <= 300 THEN 'A2' WHEN u.value > 300 THEN 'A3' END AS suggested_albuminuria, "
    "latest_egfr, latest_egfr_date, CASE WHEN t.n >= 3 AND t.span >= 90 THEN t.s END AS slope, ns.note_stage, u.value AS uv, k.value AS kv, d.patient_id IS NULL AS care_gap_flag, "
    "c.n_low, c.a, c.b, c.lo, t.n AS n_values FROM chronic c "
    "JOIN latest USING (patient_id) JOIN trend t USING (patient_id) LEFT JOIN u USING (patient_id) LEFT JOIN k USING (patient_id) LEFT JOIN ns USING (patient_id) "
    "LEFT JOIN coded d ON d.patient_id = c.patient_id), "
    "cand AS (SELECT *, CASE WHEN suggested_stage IN ('G4', 'G5') OR coalesce(slope <= -5, false) THEN 'high' WHEN suggested_stage = 'G3b' OR (suggested_stage = 'G3a' AND "
    "coalesce(suggested_albuminuria IN ('A2', 'A3'), false)) THEN 'medium' ELSE 'low' END AS risk_tier, "
    "(1 + CASE WHEN latest_egfr < 60 THEN 1 ELSE 0 END + CASE WHEN kv > 1.3 THEN 1 ELSE 0 END + CASE WHEN uv >= 30 THEN 1 ELSE 0 END + "
    "CASE WHEN starts_with(suggested_stage, concat('G', note_stage)) AND note_stage IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE / "
    "(2 + CASE WHEN kv IS NULL THEN 0 ELSE 1 END + CASE WHEN uv IS NULL THEN 0 ELSE 1 END + CASE WHEN note_stage IS NULL THEN 0 ELSE 1 END) AS confidence FROM j)"
)


def _candidates(t):
    return chronic.candidates(t.lab, t.dx, t.note, t.uacr, t.crea)


@query(
    "review_candidates",
    f"WITH {_CANDIDATES} SELECT patient_id, suggested_stage, suggested_albuminuria, confidence, care_gap_flag, risk_tier, latest_egfr, latest_egfr_date, "
    "round(slope, 4) AS slope_per_year, note_stage, n_values, n_low, a AS first_low_date, b AS last_low_date, round(lo, 4) AS lowest_value FROM cand",
    "lab dx note uacr crea",
)
def _(t):
    """The evidence text is read back field by field, so that it is checked as well."""
    fields = F.from_json("evidence_json", "n_values bigint, n_low bigint, first_low_date date, last_low_date date, lowest_value double")
    return (
        _candidates(t)
        .withColumn("slope_per_year", F.round("slope_per_year", 4))
        .withColumn("_e", fields)
        .drop("evidence_json")
        .select("*", "_e.n_values", "_e.n_low", "_e.first_low_date", "_e.last_low_date", F.round("_e.lowest_value", 4).alias("lowest_value"))
        .drop("_e")
    )


@query(
    "candidate_evidence_rows",
    f"WITH {_CHRONIC} SELECT patient_id, lab_id, lab_date, value FROM lab WHERE value < 60 AND patient_id IN (SELECT patient_id FROM chronic)",
    "lab dx",
)
def _(t):
    return chronic.evidence_rows(chronic.candidates(t.lab, t.dx), t.lab)


@query(
    "review_worklist",
    f"WITH {_CANDIDATES} SELECT patient_id, risk_tier, confidence, latest_egfr, row_number() OVER (ORDER BY CASE risk_tier WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, "
    "confidence DESC, latest_egfr, patient_id) AS review_rank FROM cand",
    "lab dx note uacr crea",
)
def _(t):
    return chronic.worklist(_candidates(t)).select("patient_id", "risk_tier", "confidence", "latest_egfr", "review_rank")


@query(
    "review_worklist_recent_visits",
    f"WITH {_CANDIDATES}, c2 AS (SELECT * FROM cand WHERE patient_id IN (SELECT patient_id FROM enc WHERE encounter_date > DATE '2001-08-01' - 90 AND encounter_date <= DATE '2001-08-01')) "
    "SELECT patient_id, risk_tier, row_number() OVER (ORDER BY CASE risk_tier WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, "
    "confidence DESC, latest_egfr, patient_id) AS review_rank FROM c2",
    "lab dx note uacr crea enc",
)
def _(t):
    return chronic.worklist(_candidates(t), t.enc, "2001-08-01", 90).select("patient_id", "risk_tier", "review_rank")


@query(
    "review_worklist_top_25",
    f"WITH {_CANDIDATES} SELECT patient_id, risk_tier, confidence, latest_egfr FROM cand ORDER BY CASE risk_tier WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, "
    "confidence DESC, latest_egfr, patient_id LIMIT 25",
    "lab dx note uacr crea",
)
def _(t):
    tier = F.when(F.col("risk_tier") == "high", 1).when(F.col("risk_tier") == "medium", 2).otherwise(3)
    ordered = _candidates(t).orderBy(tier, F.col("confidence").desc(), "latest_egfr", "patient_id")
    return ordered.limit(25).select("patient_id", "risk_tier", "confidence", "latest_egfr")


@query(
    "reviewed_worklist",
    f"WITH {_CANDIDATES}, dec AS (SELECT o_custkey AS patient_id, CASE o_orderstatus WHEN 'F' THEN 'confirm' WHEN 'O' THEN 'adjust' ELSE 'dismiss' END AS decision, "
    "'G4' AS adjusted_stage FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) "
    "SELECT c.patient_id, coalesce(decision, 'open') AS review_status, CASE WHEN decision = 'adjust' THEN adjusted_stage WHEN coalesce(decision, '') <> 'dismiss' THEN suggested_stage END AS final_stage "
    "FROM cand c LEFT JOIN dec USING (patient_id)",
    "lab dx note uacr crea",
)
def _(t):
    decisions = t.raw("orders").where("o_orderdate >= TIMESTAMP_NTZ '2001-01-01 00:00:00'").selectExpr(
        "o_custkey patient_id",
        "CASE o_orderstatus WHEN 'F' THEN 'confirm' WHEN 'O' THEN 'adjust' ELSE 'dismiss' END decision",
        "'G4' adjusted_stage",
        "o_orderdate decided_at",
        "o_orderkey decision_id",
    )
    return chronic.apply_reviews(_candidates(t), decisions).select("patient_id", "review_status", "final_stage")


@query(
    "ambiguous_patients",
    "SELECT patient_id, count(*) FILTER (value < 60) AS n_low, min(value) AS min_value, max(value) AS max_value FROM lab GROUP BY patient_id "
    "HAVING count(*) FILTER (value < 60) >= 1 AND date_diff('day', min(lab_date) FILTER (value < 60), max(lab_date) FILTER (value < 60)) < 90 "
    "AND (count(*) FILTER (value < 60) = 1 OR (min(value) < 60 AND max(value) >= 60))",
    "lab",
)
def _(t):
    return chronic.ambiguous(t.lab)


_TRUTH = (
    "truth AS (SELECT patient_id, CASE patient_id % 6 WHEN 0 THEN 'G1' WHEN 1 THEN 'G2' WHEN 2 THEN 'G3a' WHEN 3 THEN 'G3b' WHEN 4 THEN 'G4' ELSE 'G5' END AS truth FROM pat)"
)


def _scored(t):
    truth = t.pat.selectExpr(
        "patient_id",
        "CASE patient_id % 6 WHEN 0 THEN 'G1' WHEN 1 THEN 'G2' WHEN 2 THEN 'G3a' WHEN 3 THEN 'G3b' WHEN 4 THEN 'G4' ELSE 'G5' END truth",
    )
    return chronic.candidates(t.lab, t.dx).select("patient_id", "suggested_stage").join(truth, "patient_id")


@query(
    "stage_confusion_matrix",
    f"WITH {_CANDIDATES}, {_TRUTH} SELECT suggested_stage AS pred, truth, count(*) AS n FROM cand JOIN truth USING (patient_id) GROUP BY 1, 2",
    "lab dx note uacr crea pat",
)
def _(t):
    return cohort.confusion(_scored(t), "suggested_stage", "truth")


@query(
    "stage_precision_recall",
    f"WITH {_CANDIDATES}, {_TRUTH}, s AS (SELECT suggested_stage AS p, truth AS q, list_position(['G1','G2','G3a','G3b','G4','G5'], suggested_stage) AS pi, "
    "list_position(['G1','G2','G3a','G3b','G4','G5'], truth) AS qi FROM cand JOIN truth USING (patient_id)), l AS (SELECT p AS label FROM s UNION SELECT q FROM s) "
    "SELECT label, count(*) FILTER (p = label AND q = label) AS tp, count(*) FILTER (p = label AND q <> label) AS fp, count(*) FILTER (p <> label AND q = label) AS fn, "
    "count(*) FILTER (q = label) AS support, CASE WHEN count(*) FILTER (p = label) > 0 THEN count(*) FILTER (p = label AND q = label) / count(*) FILTER (p = label)::DOUBLE END AS precision, "
    "CASE WHEN count(*) FILTER (q = label) > 0 THEN count(*) FILTER (p = label AND q = label) / count(*) FILTER (q = label)::DOUBLE END AS recall, "
    "count(*) FILTER (q = label AND abs(pi - qi) <= 1) AS within_one FROM s CROSS JOIN l GROUP BY label",
    "lab dx note uacr crea pat",
)
def _(t):
    return cohort.evaluate_labels(_scored(t), "suggested_stage", "truth", ["G1", "G2", "G3a", "G3b", "G4", "G5"])
