"""The given tables seen as the shapes the operators work on.

Each shape is a projection of a whole table: no row is left out to make a check cheaper. Where a shape
holds one kind of row (dispenses, leave requests), the kind is read from an attribute of the row.
The same shape is defined once for Spark and once, independently, as SQL for the check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranges import PeriodCalendar
from tidewatch.operators.skew import dealt, shuffled

AS_OF_ASSETS = "2000-01-01"
AS_OF_LABS = "2001-08-01"
BLOCK_START = "2026-09-01"
BLOCK_DAYS = 28
#: Pay periods that cover every date of the given tables.
CALENDAR = PeriodCalendar("1994-12-19", 190, 14)
SITE_SIZE = 40

SPARK: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def shape(name: str, sql: str) -> Callable:
    def register(fn: Callable) -> Callable:
        SPARK[name] = fn
        SQL[name] = sql
        return fn

    return register


def with_definitions(sql: str, uses: Iterable[str]) -> str:
    heads = ", ".join(f"{u} AS ({SQL[u]})" for u in uses)
    body = sql.strip()
    if not heads:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {heads}, {body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {heads}, {body[5:]}"
    return f"WITH {heads} {body}"


# --- chronic disease -----------------------------------------------------------


@shape("pat", "SELECT c_custkey AS patient_id, c_mktsegment AS cohort, c_nationkey AS site FROM customer")
def _pat(t) -> DataFrame:
    return t.raw("customer").selectExpr("c_custkey patient_id", "c_mktsegment cohort", "c_nationkey site")


@shape(
    "lab",
    "SELECT o_orderkey AS lab_id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS lab_date, "
    "o_totalprice / CAST(4000 AS DOUBLE) AS value FROM orders",
)
def _lab(t) -> DataFrame:
    return t.raw("orders").selectExpr(
        "o_orderkey lab_id", "o_custkey patient_id", "CAST(o_orderdate AS DATE) lab_date", "o_totalprice / 4000D value"
    )


@shape(
    "dx",
    "SELECT o_orderkey AS dx_id, o_custkey AS patient_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'N18.31' "
    "WHEN '2-HIGH' THEN 'E11.9' ELSE 'I10' END AS icd10_code FROM orders WHERE o_orderstatus = 'F'",
)
def _dx(t) -> DataFrame:
    return t.raw("orders").where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey dx_id",
        "o_custkey patient_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'N18.31' WHEN '2-HIGH' THEN 'E11.9' ELSE 'I10' END icd10_code",
    )


_LINE_LAB = (
    "SELECT l.l_orderkey AS lab_id, o.o_custkey AS patient_id, CAST(l.l_shipdate AS DATE) AS lab_date, "
    "{value} AS value FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"
)


def _line_lab(t, value: str) -> DataFrame:
    lines = t.raw("lineitem").selectExpr("l_orderkey lab_id", "CAST(l_shipdate AS DATE) lab_date", f"{value} value")
    owners = t.raw("orders").selectExpr("o_orderkey lab_id", "o_custkey patient_id")
    return lines.join(owners, "lab_id").select("lab_id", "patient_id", "lab_date", "value")


@shape("uacr", _LINE_LAB.format(value="l.l_quantity * CAST(10 AS DOUBLE)"))
def _uacr(t) -> DataFrame:
    return _line_lab(t, "l_quantity * 10D")


@shape("crea", _LINE_LAB.format(value="l.l_tax * CAST(20 AS DOUBLE)"))
def _crea(t) -> DataFrame:
    return _line_lab(t, "l_tax * 20D")


@shape(
    "labs",
    "SELECT lab_id, patient_id, lab_date, 'eGFR' AS test_name, value FROM lab "
    "UNION ALL SELECT lab_id, patient_id, lab_date, 'UACR', value FROM uacr "
    "UNION ALL SELECT lab_id, patient_id, lab_date, 'creatinine', value FROM crea",
)
def _labs(t) -> DataFrame:
    named = lambda df, n: df.withColumn("test_name", F.lit(n))
    return named(t.lab, "eGFR").unionByName(named(t.uacr, "UACR")).unionByName(named(t.crea, "creatinine"))


@shape(
    "note",
    "SELECT o_orderkey AS note_id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS note_date, "
    "CASE WHEN o_orderkey % 5 = 0 THEN concat('CKD stage ', CAST(1 + o_orderkey % 4 AS VARCHAR), ' noted') "
    "WHEN o_orderkey % 5 = 1 THEN 'chronic kidney disease G3b, stable' ELSE 'routine follow-up' END AS note_text "
    "FROM orders",
)
def _note(t) -> DataFrame:
    return t.raw("orders").selectExpr(
        "o_orderkey note_id",
        "o_custkey patient_id",
        "CAST(o_orderdate AS DATE) note_date",
        "CASE WHEN o_orderkey % 5 = 0 THEN concat('CKD stage ', CAST(1 + o_orderkey % 4 AS STRING), ' noted') "
        "WHEN o_orderkey % 5 = 1 THEN 'chronic kidney disease G3b, stable' ELSE 'routine follow-up' END note_text",
    )


@shape(
    "enc",
    "SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS encounter_date FROM orders",
)
def _enc(t) -> DataFrame:
    return t.raw("orders").selectExpr(
        "o_orderkey encounter_id", "o_custkey patient_id", "CAST(o_orderdate AS DATE) encounter_date"
    )


# --- controlled substances --------------------------------------------------------


@shape(
    "staff",
    "SELECT user_id AS staff_id, CASE user_id % 2 WHEN 0 THEN 'RN' ELSE 'Tech' END AS role, "
    "concat('U', CAST(user_id % 7 AS VARCHAR)) AS unit, user_id % 37 = 0 AS is_planted_diverter "
    "FROM (SELECT DISTINCT user_id FROM events) u",
)
def _staff(t) -> DataFrame:
    return t.raw("events").select("user_id").distinct().selectExpr(
        "user_id staff_id",
        "CASE user_id % 2 WHEN 0 THEN 'RN' ELSE 'Tech' END role",
        "concat('U', CAST(user_id % 7 AS STRING)) unit",
        "user_id % 37 = 0 is_planted_diverter",
    )


@shape(
    "txn",
    "SELECT event_id AS txn_id, user_id AS staff_id, CASE event_type WHEN 'click' THEN 'dispense' "
    "WHEN 'error' THEN 'waste' ELSE 'return' END AS txn_type, value AS amount, ts, "
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id + 1 END AS witness_id, event_id % 11 = 0 AS is_override "
    "FROM events WHERE event_type IN ('click', 'error', 'signup')",
)
def _txn(t) -> DataFrame:
    return t.raw("events").where("event_type IN ('click', 'error', 'signup')").selectExpr(
        "event_id txn_id",
        "user_id staff_id",
        "CASE event_type WHEN 'click' THEN 'dispense' WHEN 'error' THEN 'waste' ELSE 'return' END txn_type",
        "value amount",
        "ts",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id + 1 END witness_id",
        "event_id % 11 = 0 is_override",
    )


@shape(
    "mar",
    "SELECT event_id AS mar_id, user_id AS staff_id, user_id AS patient_id, value AS admin_amount, ts AS admin_time, "
    "event_id AS order_id FROM events WHERE event_type = 'purchase'",
)
def _mar(t) -> DataFrame:
    return t.raw("events").where("event_type = 'purchase'").selectExpr(
        "event_id mar_id", "user_id staff_id", "user_id patient_id", "value admin_amount", "ts admin_time",
        "event_id order_id",
    )


@shape(
    "pain",
    "SELECT event_id AS pain_id, user_id AS patient_id, CAST(floor(value) AS INT) % 11 AS score, "
    "ts AS documented_time FROM events WHERE event_type = 'view'",
)
def _pain(t) -> DataFrame:
    return t.raw("events").where("event_type = 'view'").selectExpr(
        "event_id pain_id", "user_id patient_id", "CAST(floor(value) AS INT) % 11 score", "ts documented_time"
    )


@shape(
    "risk",
    "SELECT user_id AS staff_id, '2024-01' AS period, CAST((user_id * 37) % 101 AS DOUBLE) AS risk_score "
    "FROM (SELECT DISTINCT user_id FROM events) u",
)
def _risk(t) -> DataFrame:
    return t.raw("events").select("user_id").distinct().selectExpr(
        "user_id staff_id", "'2024-01' period", "CAST((user_id * 37) % 101 AS DOUBLE) risk_score"
    )


@shape(
    "rx",
    "SELECT o_orderkey AS order_id, o_custkey AS patient_id, CAST(10 + o_orderkey % 30 AS DOUBLE) AS dose FROM orders",
)
def _rx(t) -> DataFrame:
    return t.raw("orders").selectExpr(
        "o_orderkey order_id", "o_custkey patient_id", "CAST(10 + o_orderkey % 30 AS DOUBLE) dose"
    )


@shape("given", "SELECT l_orderkey AS order_id, l_partkey AS med_id, l_quantity AS admin_amount FROM lineitem")
def _given(t) -> DataFrame:
    return t.raw("lineitem").selectExpr("l_orderkey order_id", "l_partkey med_id", "l_quantity admin_amount")


# --- equipment -----------------------------------------------------------------------


@shape(
    "ast",
    "SELECT p_partkey AS asset_number, p_type AS device_type, p_brand AS manufacturer, "
    "concat('F', CAST(p_partkey % 8 AS VARCHAR)) AS facility, concat('A', CAST(p_partkey % 13 AS VARCHAR)) AS clinical_area, "
    "CAST(DATE '1998-01-01' + p_size * 30 AS DATE) AS end_of_support_date, "
    "CAST(DATE '1998-01-01' + p_size * 30 - CAST(5 + p_partkey % 6 AS INTEGER) * 365 AS DATE) AS purchase_date, "
    "p_retailprice AS replacement_cost, p_size % 7 = 0 AS os_eol, "
    "CASE WHEN p_size % 7 = 0 THEN 'Windows 7 Embedded' WHEN p_size % 3 = 0 THEN 'Linux (embedded)' "
    "ELSE 'Windows 10 IoT Enterprise' END AS operating_system, "
    "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('mac-', CAST(p_partkey AS VARCHAR)) END AS mac_address FROM part",
)
def _ast(t) -> DataFrame:
    return t.raw("part").selectExpr(
        "p_partkey asset_number",
        "p_type device_type",
        "p_brand manufacturer",
        "concat('F', CAST(p_partkey % 8 AS STRING)) facility",
        "concat('A', CAST(p_partkey % 13 AS STRING)) clinical_area",
        "date_add(DATE '1998-01-01', p_size * 30) end_of_support_date",
        "date_add(DATE '1998-01-01', p_size * 30 - CAST(5 + p_partkey % 6 AS INT) * 365) purchase_date",
        "p_retailprice replacement_cost",
        "p_size % 7 = 0 os_eol",
        "CASE WHEN p_size % 7 = 0 THEN 'Windows 7 Embedded' WHEN p_size % 3 = 0 THEN 'Linux (embedded)' "
        "ELSE 'Windows 10 IoT Enterprise' END operating_system",
        "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('mac-', CAST(p_partkey AS STRING)) END mac_address",
    )


@shape(
    "wo",
    "SELECT l_orderkey AS wo_id, l_partkey AS asset_number, CAST(l_shipdate AS DATE) AS wo_date, "
    "CASE l_returnflag WHEN 'R' THEN 'Repair' ELSE 'PM' END AS wo_type, l_extendedprice AS cost, "
    "l_quantity AS downtime_hours FROM lineitem",
)
def _wo(t) -> DataFrame:
    return t.raw("lineitem").selectExpr(
        "l_orderkey wo_id",
        "l_partkey asset_number",
        "CAST(l_shipdate AS DATE) wo_date",
        "CASE l_returnflag WHEN 'R' THEN 'Repair' ELSE 'PM' END wo_type",
        "l_extendedprice cost",
        "l_quantity downtime_hours",
    )


# --- workforce -----------------------------------------------------------------------


@shape(
    "hr",
    "SELECT p_partkey AS num, concat('E', lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(5, length(CAST(p_partkey AS VARCHAR))) AS INTEGER)"
    ", '0')) AS employee_id, p_name AS worker_name, concat(p_type, ' ', p_brand) AS department, "
    "CAST(CASE WHEN p_size % 5 = 0 THEN 0.6 ELSE 1.0 END AS DOUBLE) AS fte, "
    "CASE p_size % 2 WHEN 0 THEN 'RN' ELSE 'Tech' END AS role, "
    "CAST(DATE '1994-06-01' + p_size * 40 AS DATE) AS hire_date, "
    "CASE WHEN p_size % 7 = 0 THEN CAST(DATE '1996-01-01' + p_size * 45 AS DATE) END AS term_date FROM part",
)
def _hr(t) -> DataFrame:
    return t.raw("part").selectExpr(
        "p_partkey num",
        "concat('E', lpad(CAST(p_partkey AS STRING), greatest(5, length(CAST(p_partkey AS STRING))), '0')) employee_id",
        "p_name worker_name",
        "concat(p_type, ' ', p_brand) department",
        "CAST(CASE WHEN p_size % 5 = 0 THEN 0.6 ELSE 1.0 END AS DOUBLE) fte",
        "CASE p_size % 2 WHEN 0 THEN 'RN' ELSE 'Tech' END role",
        "date_add(DATE '1994-06-01', p_size * 40) hire_date",
        "CASE WHEN p_size % 7 = 0 THEN date_add(DATE '1996-01-01', p_size * 45) END term_date",
    )


# Staff on the roster with size 48 or more are not scheduled; suppliers are scheduled agency staff without a roster row.
_TAS_NAME = (
    "CASE p_partkey % 10 WHEN 0 THEN concat(p_name, ' RN') WHEN 1 THEN upper(p_name) "
    "WHEN 2 THEN concat(substring(p_name, 1, 2), substring(p_name, 4, 1), substring(p_name, 3, 1), substring(p_name, 5, 50)) "
    "ELSE p_name END"
)
_TAS_DEPT = (
    "CASE p_partkey % 9 WHEN 0 THEN lower(concat(p_type, ' ', p_brand)) WHEN 1 THEN concat(' ', p_type, ' ', p_brand, ' ') "
    "ELSE concat(p_type, ' ', p_brand) END"
)


def _tas_sql(text: str) -> str:
    return (
        f"SELECT concat('TAS-', lpad(CAST(p_partkey AS {text}), CAST(greatest(4, length(CAST(p_partkey AS {text}))) AS INTEGER), '0')) "
        f"AS tas_worker_id, {_TAS_NAME} AS worker_name, {_TAS_DEPT} AS department, "
        "CASE p_size % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Eve' ELSE 'Night' END AS shift, "
        "CAST(60 + p_size % 21 AS DOUBLE) AS scheduled_hours FROM part WHERE p_size < 48 "
        f"UNION ALL SELECT concat('TAS-A', CAST(s_suppkey AS {text})), concat('Agency ', s_name), 'AGENCY POOL', 'Night', "
        "CAST(36 AS DOUBLE) FROM supplier"
    )


@shape("tas", _tas_sql("VARCHAR"))
def _tas(t) -> DataFrame:
    parts = t.raw("part").where("p_size < 48").selectExpr(
        "concat('TAS-', lpad(CAST(p_partkey AS STRING), greatest(4, length(CAST(p_partkey AS STRING))), '0')) tas_worker_id",
        f"{_TAS_NAME} worker_name",
        f"{_TAS_DEPT} department",
        "CASE p_size % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Eve' ELSE 'Night' END shift",
        "CAST(60 + p_size % 21 AS DOUBLE) scheduled_hours",
    )
    agency = t.raw("supplier").selectExpr(
        "concat('TAS-A', CAST(s_suppkey AS STRING)) tas_worker_id",
        "concat('Agency ', s_name) worker_name",
        "'AGENCY POOL' department",
        "'Night' shift",
        "CAST(36 AS DOUBLE) scheduled_hours",
    )
    return parts.unionByName(agency)


@shape(
    "leave",
    "SELECT concat('E', lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(5, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')) AS employee_id, "
    "CASE l_returnflag WHEN 'R' THEN 'PTO' ELSE 'LOA' END AS leave_type, CAST(l_shipdate AS DATE) AS start_date, "
    "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 AND l_quantity >= 50 THEN NULL "
    "ELSE CAST(CAST(l_shipdate AS DATE) + l_linenumber AS DATE) END AS end_date, "
    "CASE l_returnflag WHEN 'R' THEN l_quantity END AS hours FROM lineitem WHERE l_returnflag IN ('R', 'A')",
)
def _leave(t) -> DataFrame:
    return t.raw("lineitem").where("l_returnflag IN ('R', 'A')").selectExpr(
        "concat('E', lpad(CAST(l_partkey AS STRING), greatest(5, length(CAST(l_partkey AS STRING))), '0')) employee_id",
        "CASE l_returnflag WHEN 'R' THEN 'PTO' ELSE 'LOA' END leave_type",
        "CAST(l_shipdate AS DATE) start_date",
        "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 AND l_quantity >= 50 THEN NULL "
        "ELSE date_add(CAST(l_shipdate AS DATE), l_linenumber) END end_date",
        "CASE l_returnflag WHEN 'R' THEN l_quantity END hours",
    )


@shape(
    "dem",
    "SELECT c_mktsegment AS department, o_orderpriority AS shift, CAST(year(o_orderdate) AS INTEGER) AS period, "
    "CAST(count(*) AS DOUBLE) / 10 AS required_fte FROM orders JOIN customer ON c_custkey = o_custkey "
    "GROUP BY ALL",
)
def _dem(t) -> DataFrame:
    orders = t.raw("orders").selectExpr(
        "o_custkey", "o_orderpriority shift", "year(o_orderdate) period"
    )
    depts = t.raw("customer").selectExpr("c_custkey o_custkey", "c_mktsegment department")
    return orders.join(shuffled(depts), "o_custkey").groupBy("department", "shift", "period").agg(
        (F.count(F.lit(1)).cast("double") / F.lit(10)).alias("required_fte")
    )


@shape(
    "need",
    "SELECT concat(p_type, ' ', p_brand) AS department, CASE l_linenumber % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Eve' "
    "ELSE 'Night' END AS shift, CAST(floor(date_diff('day', DATE '1994-12-19', CAST(l_shipdate AS DATE)) / 14.0) AS INTEGER) AS seq, "
    "CAST(count(*) AS DOUBLE) / 4 AS required_fte FROM lineitem JOIN part ON p_partkey = l_partkey "
    "GROUP BY ALL",
)
def _need(t) -> DataFrame:
    lines = t.raw("lineitem").select(
        "l_partkey",
        F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Eve' ELSE 'Night' END").alias("shift"),
        CALENDAR.index(F.col("l_shipdate").cast("date")).alias("seq"),
    )
    depts = t.raw("part").selectExpr("p_partkey l_partkey", "concat(p_type, ' ', p_brand) department")
    lines = dealt(lines, ["l_partkey"], t.raw("lineitem").count(), 250_000)
    return lines.join(shuffled(depts), "l_partkey").groupBy("department", "shift", "seq").agg(
        (F.count(F.lit(1)).cast("double") / F.lit(4)).alias("required_fte")
    )


@shape(
    "budget",
    "SELECT concat(p_type, ' ', p_brand) AS department, CASE p_size % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Eve' ELSE 'Night' END AS shift, "
    "count(*) AS budgeted_positions, CAST(count(*) AS DOUBLE) * 0.9 AS budgeted_fte, "
    "concat('{\"RN\": ', CAST(count(*) FILTER (p_size % 2 = 0) AS VARCHAR), ', \"Tech\": ', "
    "CAST(count(*) FILTER (p_size % 2 = 1) AS VARCHAR), '}') AS role_mix FROM part GROUP BY ALL",
)
def _budget(t) -> DataFrame:
    g = t.raw("part").selectExpr(
        "concat(p_type, ' ', p_brand) department",
        "CASE p_size % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'Eve' ELSE 'Night' END shift",
        "p_size",
    )
    return g.groupBy("department", "shift").agg(
        F.count(F.lit(1)).alias("budgeted_positions"),
        (F.count(F.lit(1)).cast("double") * F.lit(0.9)).alias("budgeted_fte"),
        F.concat(
            F.lit('{"RN": '), F.count_if(F.expr("p_size % 2 = 0")).cast("string"),
            F.lit(', "Tech": '), F.count_if(F.expr("p_size % 2 = 1")).cast("string"), F.lit("}"),
        ).alias("role_mix"),
    )


# --- scheduling -----------------------------------------------------------------------

_UNIT = "CASE {k28} % 4 WHEN 0 THEN 'icu' WHEN 1 THEN 'cardiology' ELSE 'general' END"
_SHIFT = "CASE {k112} % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'night' ELSE 'swing' END"
_SPARK_K = {"k28": "(o_orderkey div 28)", "k112": "(o_orderkey div 112)"}
_DUCK_K = {"k28": "(o_orderkey // 28)", "k112": "(o_orderkey // 112)"}


@shape(
    "prov",
    f"SELECT c_custkey AS provider_id, c_custkey // {SITE_SIZE} AS site, CASE c_custkey % 4 WHEN 0 THEN 'nocturnist' "
    "WHEN 1 THEN 'icu' ELSE 'general' END AS service_line, string_split(concat('general', CASE WHEN c_custkey % 4 = 1 "
    "THEN ',icu' ELSE '' END, CASE WHEN c_custkey % 5 = 0 THEN ',cardiology' ELSE '' END), ',') AS credentials, "
    "CAST(CASE WHEN c_custkey % 3 = 0 THEN 0.6 ELSE 1.0 END AS DOUBLE) AS fte, CAST(c_custkey % 21 AS INTEGER) AS seniority_years, "
    "6 + CAST(c_custkey % 2 AS INTEGER) AS max_consecutive_shifts, 10 AS min_rest_hours, "
    "c_custkey % 4 = 0 OR c_custkey % 3 = 0 AS wants_night_differential FROM customer",
)
def _prov(t) -> DataFrame:
    return t.raw("customer").selectExpr(
        "c_custkey provider_id",
        f"c_custkey div {SITE_SIZE} site",
        "CASE c_custkey % 4 WHEN 0 THEN 'nocturnist' WHEN 1 THEN 'icu' ELSE 'general' END service_line",
        "split(concat('general', CASE WHEN c_custkey % 4 = 1 THEN ',icu' ELSE '' END, "
        "CASE WHEN c_custkey % 5 = 0 THEN ',cardiology' ELSE '' END), ',') credentials",
        "CAST(CASE WHEN c_custkey % 3 = 0 THEN 0.6 ELSE 1.0 END AS DOUBLE) fte",
        "CAST(c_custkey % 21 AS INT) seniority_years",
        "6 + CAST(c_custkey % 2 AS INT) max_consecutive_shifts",
        "10 min_rest_hours",
        "c_custkey % 4 = 0 OR c_custkey % 3 = 0 wants_night_differential",
    )


@shape(
    "asg",
    f"SELECT o_orderkey AS assignment_id, o_custkey AS provider_id, o_custkey // {SITE_SIZE} AS site, "
    f"CAST(DATE '{BLOCK_START}' + CAST(o_orderkey % {BLOCK_DAYS} AS INTEGER) AS DATE) AS work_date, "
    f"{_SHIFT.format(**_DUCK_K)} AS shift_type, {_UNIT.format(**_DUCK_K)} AS unit FROM orders WHERE o_orderpriority <> '1-URGENT'",
)
def _asg(t) -> DataFrame:
    return t.raw("orders").where("o_orderpriority <> '1-URGENT'").selectExpr(
        "o_orderkey assignment_id",
        "o_custkey provider_id",
        f"o_custkey div {SITE_SIZE} site",
        f"date_add(DATE '{BLOCK_START}', CAST(o_orderkey % {BLOCK_DAYS} AS INT)) work_date",
        f"{_SHIFT.format(**_SPARK_K)} shift_type",
        f"{_UNIT.format(**_SPARK_K)} unit",
    )


@shape(
    "cov",
    f"SELECT o_custkey // {SITE_SIZE} AS site, CAST(DATE '{BLOCK_START}' + CAST(o_orderkey % {BLOCK_DAYS} AS INTEGER) AS DATE) AS work_date, "
    f"{_SHIFT.format(**_DUCK_K)} AS shift_type, {_UNIT.format(**_DUCK_K)} AS unit, CAST(1 + count(*) % 2 AS INTEGER) AS required_headcount "
    "FROM orders GROUP BY ALL",
)
def _cov(t) -> DataFrame:
    cells = t.raw("orders").selectExpr(
        f"o_custkey div {SITE_SIZE} site",
        f"date_add(DATE '{BLOCK_START}', CAST(o_orderkey % {BLOCK_DAYS} AS INT)) work_date",
        f"{_SHIFT.format(**_SPARK_K)} shift_type",
        f"{_UNIT.format(**_SPARK_K)} unit",
    )
    return cells.groupBy("site", "work_date", "shift_type", "unit").agg(
        F.expr("CAST(1 + count(*) % 2 AS INT)").alias("required_headcount")
    )


@shape(
    "pto",
    "SELECT o_orderkey AS pto_id, o_custkey AS provider_id, "
    f"CAST(DATE '{BLOCK_START}' + CAST((o_orderkey // 3) % {BLOCK_DAYS} AS INTEGER) AS DATE) AS start_date, "
    f"CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(DATE '{BLOCK_START}' + CAST((o_orderkey // 3) % {BLOCK_DAYS} + o_orderkey % 6 AS INTEGER) AS DATE) END AS end_date, "
    "CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'requested' ELSE 'denied' END AS status "
    "FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def _pto(t) -> DataFrame:
    return t.raw("orders").where("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey pto_id",
        "o_custkey provider_id",
        f"date_add(DATE '{BLOCK_START}', CAST((o_orderkey div 3) % {BLOCK_DAYS} AS INT)) start_date",
        f"CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE date_add(DATE '{BLOCK_START}', "
        f"CAST((o_orderkey div 3) % {BLOCK_DAYS} + o_orderkey % 6 AS INT)) END end_date",
        "CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'requested' ELSE 'denied' END status",
    )


@shape(
    "pref",
    "SELECT c_custkey AS provider_id, s.shift_type, w.weekday, CAST((c_custkey * 7 + s.i * 3 + w.j) % 11 AS INTEGER) - 5 AS preference_weight, "
    "c_custkey % 2 = 0 AS wants_consecutive, CAST(14 + c_custkey % 7 AS INTEGER) AS max_shifts_per_block "
    "FROM customer CROSS JOIN (VALUES ('day', 0), ('night', 1), ('swing', 2)) AS s(shift_type, i) CROSS JOIN "
    "(VALUES ('Mon', 0), ('Tue', 1), ('Wed', 2), ('Thu', 3), ('Fri', 4), ('Sat', 5), ('Sun', 6)) AS w(weekday, j)",
)
def _pref(t) -> DataFrame:
    return (
        t.raw("customer")
        .selectExpr("c_custkey provider_id", "posexplode(array('day', 'night', 'swing')) AS (i, shift_type)")
        .selectExpr("*", "posexplode(array('Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun')) AS (j, weekday)")
        .selectExpr(
            "provider_id",
            "shift_type",
            "weekday",
            "CAST((provider_id * 7 + i * 3 + j) % 11 AS INT) - 5 preference_weight",
            "provider_id % 2 = 0 wants_consecutive",
            "CAST(14 + provider_id % 7 AS INT) max_shifts_per_block",
        )
    )


# The seven rules.
RULE_ROWS = [
    ("PAY-001", "max_consecutive", "6", "all"),
    ("PAY-002", "min_rest_hours", "10", "all"),
    ("PAY-003", "no_night_then_day", "true", "all"),
    ("PAY-004", "night_differential", "true", "all"),
    ("PAY-005", "max_shifts_per_block", "20", "all"),
    ("PAY-006", "min_shifts_per_block", "12", "all"),
    ("PAY-007", "max_consecutive", "7", "nocturnist"),
]


_RULE_VALUES = ", ".join(str(r) for r in RULE_ROWS)


@shape("rul", f"SELECT * FROM (VALUES {_RULE_VALUES}) AS r(rule_id, rule_type, param_value, applies_to)")
def _rul(t) -> DataFrame:
    return t.spark.sql(f"SELECT * FROM VALUES {_RULE_VALUES} AS r(rule_id, rule_type, param_value, applies_to)")
