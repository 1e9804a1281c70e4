"""Ids, hashing, banding, dates and text on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import scalars as S
from tidewatch.operators import govern, rules
from tidewatch.workload.registry import query

_HASH = "('0x' || substr(md5(CAST(patient_id AS VARCHAR)), 1, 8))::BIGINT"


@query(
    "surrogate_ids",
    "SELECT concat('PAT-', lpad(CAST(patient_id AS VARCHAR), CAST(greatest(6, length(CAST(patient_id AS VARCHAR))) AS INTEGER), '0')) AS surrogate_id, "
    f"{_HASH} AS seed, patient_id % 8 AS bucket FROM pat",
    "pat",
)
def _(t):
    return t.pat.select(
        S.surrogate_id("PAT-", "patient_id", 6).alias("surrogate_id"),
        S.stable_seed("patient_id").alias("seed"),
        F.pmod(F.col("patient_id"), F.lit(8)).alias("bucket"),
    )


@query(
    "weighted_split",
    f"WITH u AS (SELECT {_HASH} / CAST(4294967296 AS DOUBLE) AS u FROM pat) SELECT CASE WHEN u < 0.2 THEN 'care_gap' WHEN u < 0.5 THEN 'coded' "
    "WHEN u < 0.9 THEN 'healthy' ELSE 'ambiguous' END AS split, count(*) AS n FROM u GROUP BY 1",
    "pat",
)
def _(t):
    split = S.weighted_bucket("patient_id", [("care_gap", 0.2), ("coded", 0.3), ("healthy", 0.4), ("ambiguous", 0.1)])
    return t.pat.select(split.alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cohort_age_and_birth_date",
    "WITH a AS (SELECT patient_id, cohort, CASE WHEN cohort IN ('BUILDING', 'MACHINERY') THEN 55 + patient_id % 30 "
    "WHEN cohort = 'HOUSEHOLD' THEN 40 + patient_id % 40 ELSE 20 + patient_id % 50 END AS age FROM pat) "
    "SELECT patient_id, CAST(age AS BIGINT) AS age, CAST(DATE '2001-08-01' - CAST(floor(age * 365.25) AS INTEGER) AS DATE) AS birth_date FROM a",
    "pat",
)
def _(t):
    pid = F.col("patient_id")
    age = (
        F.when(F.col("cohort").isin("BUILDING", "MACHINERY"), 55 + pid % 30)
        .when(F.col("cohort") == "HOUSEHOLD", 40 + pid % 40)
        .otherwise(20 + pid % 50)
    )
    return t.pat.withColumn("age", age).select(
        "patient_id", "age", S.birth_date(F.lit("2001-08-01"), "age").alias("birth_date")
    )


@query(
    "patient_projection",
    "SELECT patient_id, site FROM pat",
    "pat",
)
def _(t):
    return t.pat.drop("cohort")


@query(
    "cohort_by_site_counts",
    "SELECT cohort, site, count(*) AS n FROM pat GROUP BY cohort, site",
    "pat",
)
def _(t):
    return t.pat.groupBy("cohort", "site").agg(F.count(F.lit(1)).alias("n")).orderBy("cohort", "site")


@query(
    "service_line_counts",
    "SELECT service_line, count(*) AS n FROM prov GROUP BY service_line",
    "prov",
)
def _(t):
    return t.prov.groupBy("service_line").agg(F.count(F.lit(1)).alias("n"))


@query("low_values", "SELECT lab_id, patient_id, lab_date, value FROM lab WHERE value < 60", "lab")
def _(t):
    return t.lab.where(F.col("value") < 60)


@query("coded_by_prefix", "SELECT dx_id, patient_id, icd10_code FROM dx WHERE icd10_code LIKE 'N18%'", "dx")
def _(t):
    return t.dx.where(F.col("icd10_code").startswith("N18"))


@query(
    "abnormal_flags",
    "SELECT test_name, CASE WHEN test_name = 'eGFR' AND value < 60 THEN 'L' WHEN test_name = 'creatinine' AND value > 1.3 THEN 'H' "
    "WHEN test_name = 'UACR' AND value >= 30 THEN 'H' ELSE 'N' END AS abnormal_flag, count(*) AS n FROM labs GROUP BY 1, 2",
    "lab uacr crea labs",
)
def _(t):
    flagged = rules.flag_abnormal(t.labs, "test_name", "value", rules.KIDNEY_LIMITS)
    return flagged.groupBy("test_name", "abnormal_flag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filtration_stages",
    "SELECT lab_id, CASE WHEN value >= 90 THEN 'G1' WHEN value >= 60 THEN 'G2' WHEN value >= 45 THEN 'G3a' "
    "WHEN value >= 30 THEN 'G3b' WHEN value >= 15 THEN 'G4' ELSE 'G5' END AS stage FROM lab",
    "lab",
)
def _(t):
    return t.lab.select("lab_id", S.filtration_stage("value").alias("stage"))


@query(
    "albuminuria_stage_counts",
    "SELECT CASE WHEN value < 30 THEN 'A1' WHEN value <= 300 THEN 'A2' ELSE 'A3' END AS stage, count(*) AS n FROM uacr GROUP BY 1",
    "uacr",
)
def _(t):
    return t.uacr.groupBy(S.albuminuria_stage("value").alias("stage")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "stage_of_diagnosis_code",
    "SELECT icd10_code, CASE icd10_code WHEN 'N18.31' THEN 'G3a' END AS coded_stage, count(*) AS n FROM dx GROUP BY 1, 2",
    "dx",
)
def _(t):
    return t.dx.groupBy("icd10_code", S.stage_of_code("icd10_code").alias("coded_stage")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "stated_stage_in_notes",
    "SELECT note_id, nullif(lower(regexp_extract(note_text, '(?i)(?:CKD|chronic kidney disease)\\s+(?:stage\\s+)?G?([1-5][ab]?)', 1)), '') "
    "AS stated_stage FROM note",
    "note",
)
def _(t):
    return t.note.select("note_id", S.stated_stage("note_text").alias("stated_stage"))


@query(
    "stated_stage_in_documents",
    "SELECT doc_id, nullif(lower(regexp_extract(text, '(?i)(?:CKD|chronic kidney disease)\\s+(?:stage\\s+)?G?([1-5][ab]?)', 1)), '') "
    "AS stated_stage, length(text) AS n_read FROM documents",
)
def _(t):
    return t.raw("documents").select(
        "doc_id", S.stated_stage("text").alias("stated_stage"), F.length("text").cast("bigint").alias("n_read")
    )


@query(
    "clean_names",
    "SELECT tas_worker_id, regexp_replace(regexp_replace(trim(regexp_replace(upper(worker_name), '\\s+', ' ', 'g')), ' RN$', ''), "
    "' [A-Z]\\.? ', ' ', 'g') AS name, upper(trim(department)) AS dept FROM tas",
    "tas",
)
def _(t):
    return t.tas.select(
        "tas_worker_id", S.clean_name("worker_name").alias("name"), S.clean_label("department").alias("dept")
    )


@query(
    "formal_first_names",
    "WITH n AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'BOB' WHEN 'MACHINERY' THEN 'PEGGY' WHEN 'HOUSEHOLD' THEN 'JIM' "
    "ELSE 'ALICE' END AS first FROM customer) SELECT c_custkey, CASE first WHEN 'BOB' THEN 'ROBERT' WHEN 'PEGGY' THEN 'MARGARET' "
    "WHEN 'JIM' THEN 'JAMES' ELSE first END AS formal_first FROM n",
)
def _(t):
    nick = (
        F.when(F.col("c_mktsegment") == "BUILDING", "BOB")
        .when(F.col("c_mktsegment") == "MACHINERY", "PEGGY")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "JIM")
        .otherwise("ALICE")
    )
    return t.raw("customer").select("c_custkey", S.fold_nickname(nick).alias("formal_first"))


@query(
    "typed_rule_values",
    "SELECT p.provider_id, r.rule_id, CASE WHEN r.rule_type IN ('no_night_then_day', 'night_differential') "
    "THEN CASE r.param_value WHEN 'true' THEN 1.0::DOUBLE WHEN 'false' THEN 0.0::DOUBLE END ELSE try_cast(r.param_value AS DOUBLE) END AS value "
    "FROM prov p JOIN rul r ON r.applies_to = p.service_line",
    "prov rul",
)
def _(t):
    typed = rules.typed_rules(t.rul, ["no_night_then_day", "night_differential"])
    return t.prov.select("provider_id", F.col("service_line").alias("applies_to")).join(typed, "applies_to").select(
        "provider_id", "rule_id", "value"
    )


@query(
    "json_counts_by_key",
    "SELECT k, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM (SELECT unnest(json_keys(props)) AS k, "
    "CAST(json_extract(props, '$.k') AS BIGINT) AS v FROM events) GROUP BY k",
)
def _(t):
    entries = F.explode(F.from_json("props", "map<string,int>")).alias("k", "v")
    return t.raw("events").select(entries).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


@query(
    "after_hours_transactions",
    "SELECT txn_id, staff_id, ts FROM txn WHERE extract(hour FROM ts) < 7 OR extract(hour FROM ts) >= 19",
    "txn",
)
def _(t):
    return t.txn.where(S.after_hours("ts")).select("txn_id", "staff_id", "ts")


@query(
    "end_of_support_fields",
    "SELECT asset_number, end_of_support_date < DATE '2000-01-01' AS is_past_eos, "
    "date_diff('day', DATE '2000-01-01', end_of_support_date) / CAST(365.25 AS DOUBLE) AS years_to_eos, CAST(year(end_of_support_date) AS INTEGER) AS eos_year, "
    "CASE WHEN end_of_support_date < DATE '2000-01-01' THEN 'past' WHEN date_diff('day', DATE '2000-01-01', end_of_support_date) / 365.25 <= 1.5 "
    "THEN 'nearing' ELSE 'active' END AS support_phase, CAST(floor(date_diff('day', purchase_date, DATE '2000-01-01') / 365.25) AS INTEGER) AS age_years FROM ast",
    "ast",
)
def _(t):
    from tidewatch.plans.assets import support_phase

    now, eos = F.lit("2000-01-01").cast("date"), F.col("end_of_support_date")
    return t.ast.select(
        "asset_number",
        (eos < now).alias("is_past_eos"),
        (F.datediff(eos, now) / F.lit(365.25)).alias("years_to_eos"),
        F.year(eos).alias("eos_year"),
        support_phase(eos, now).alias("support_phase"),
        S.whole_years(now, "purchase_date").alias("age_years"),
    )


@query(
    "end_of_life_operating_systems",
    "SELECT operating_system, count(*) AS n FROM ast WHERE operating_system LIKE 'Windows 7%' OR operating_system LIKE 'Windows XP%' GROUP BY 1",
    "ast",
)
def _(t):
    return t.ast.where(S.end_of_life_os("operating_system")).groupBy("operating_system").agg(F.count(F.lit(1)).alias("n"))


@query(
    "weekday_load",
    "SELECT strftime(work_date, '%a') AS weekday, count(*) AS n FROM asg GROUP BY 1",
    "asg",
)
def _(t):
    return t.asg.groupBy(S.weekday_name("work_date").alias("weekday")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "masked_customers",
    "SELECT c_custkey, sha256(c_name) AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal, 'withheld' AS c_mktsegment FROM customer",
)
def _(t):
    customers = t.raw("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return govern.mask_columns(customers, {"c_name": "hash", "c_acctbal": "null", "c_mktsegment": "text:withheld"})


_ENTITLED = "SELECT r_name AS \"user\", n_nationkey AS c_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey"


@query(
    "rows_in_user_scope",
    f"SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM ({_ENTITLED}) e WHERE e.\"user\" = 'ASIA')",
)
def _(t):
    held = t.raw("nation").join(t.raw("region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("r_name").alias("user"), F.col("n_nationkey").alias("c_nationkey")
    )
    return govern.row_filter(t.raw("customer").select("c_custkey", "c_nationkey"), held, ["c_nationkey"], "ASIA")


#: Notes with several mentions, made from the bound notes: (condition on the key, text that goes before the note).
_EARLIER = [
    (0, "Family history of CKD stage 4 in mother. "), (1, "No evidence of CKD stage 2 or CKD stage 3; "), (2, "History of CKD 2, resolved. "),
    (3, "Possible chronic kidney disease stage 3a. "), (4, "CKD stage 5 was ruled out. "), (5, ""),
]
_NOTES = "concat(CASE note_id % 6 " + " ".join(f"WHEN {k} THEN '{text}'" for k, text in _EARLIER) + " END, note_text)"


def _assertion_sql() -> str:
    window, stage = S.WINDOW_PATTERN, S.STATED_STAGE_PATTERN
    before = " ".join(f"WHEN regexp_matches(w, '{p}') THEN '{n}'" for n, p in S.ASSERTION_BEFORE.items())
    behind = " ".join(f"WHEN regexp_matches(behind, '{p}') THEN '{n}'" for n, p in S.ASSERTION_BEHIND.items())
    return (
        f"WITH t AS (SELECT note_id, {_NOTES} AS text FROM note), "
        f"s AS (SELECT note_id, regexp_extract_all(text, '{stage}', 1) AS st, regexp_split_to_array(text, '{stage}') AS pc FROM t), "
        "e AS (SELECT note_id, unnest(range(1, len(st) + 1)) AS i, st, pc FROM s), "
        f"w AS (SELECT note_id, i, lower(st[i]) AS stage, pc[i] AS before, pc[i + 1] AS behind, regexp_extract(right(pc[i], 160), '{window}', 1) AS w FROM e), "
        f"a AS (SELECT *, CASE {before} {behind} WHEN regexp_matches(before, '{S.CARRY_PATTERN}') THEN NULL ELSE 'present' END AS own FROM w) "
        "SELECT note_id, CAST(i AS INTEGER) AS nth, stage, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY note_id ORDER BY i), 'present') AS assertion FROM a"
    )


@query("stage_assertions_in_notes", _assertion_sql(), "note")
def _(t):
    noted = t.note.select("note_id", S.stage_mentions(F.expr(_NOTES)).alias("m"))
    one = noted.select("note_id", F.posexplode("m").alias("at", "m"))
    return one.select("note_id", (F.col("at") + 1).alias("nth"), "m.stage", "m.assertion")
