"""The 24 source tables: column names, types and comments (fixed values). ``!`` marks a required key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

_DDL = {
    # Chronic disease
    "ckd_patients": "patient_id STRING, dob DATE, age INT, sex STRING, race STRING, has_diabetes BOOLEAN, "
    "has_hypertension BOOLEAN, pcp_name STRING, _cohort STRING, _true_ckd_stage STRING",
    "ckd_lab_results": "lab_id STRING, patient_id STRING, lab_date DATE, loinc STRING, test_name STRING, "
    "value DOUBLE, unit STRING, abnormal_flag STRING",
    "ckd_diagnoses": "dx_id STRING, patient_id STRING, icd10_code STRING, dx_date DATE, description STRING",
    "ckd_encounters": "encounter_id STRING, patient_id STRING, encounter_date DATE, encounter_type STRING, "
    "department STRING, provider_name STRING",
    "ckd_clinical_notes": "note_id STRING, patient_id STRING, note_date DATE, note_type STRING, "
    "author_role STRING, note_text STRING",
    # Shift scheduling
    "sched_providers": "provider_id STRING NOT NULL, full_name STRING, fte DOUBLE, credentials ARRAY<STRING>, "
    "seniority_years INT, service_line STRING, max_consecutive_shifts INT, min_rest_hours INT, "
    "wants_night_differential BOOLEAN",
    "sched_preferences": "provider_id STRING NOT NULL, shift_type STRING NOT NULL, weekday STRING NOT NULL, "
    "preference_weight INT, wants_consecutive BOOLEAN, max_shifts_per_block INT",
    "sched_pto_requests": "pto_id STRING NOT NULL, provider_id STRING NOT NULL, start_date DATE, end_date DATE, "
    "status STRING, reason STRING",
    "sched_coverage_requirements": "date DATE NOT NULL, shift_type STRING NOT NULL, unit STRING NOT NULL, "
    "required_headcount INT, required_credential STRING",
    "sched_pay_rules": "rule_id STRING NOT NULL, rule_type STRING, description STRING, param_name STRING, "
    "param_value STRING, applies_to STRING",
    "sched_existing_schedule": "assignment_id STRING NOT NULL, provider_id STRING NOT NULL, date DATE, "
    "shift_type STRING, unit STRING, source_system STRING",
    # Position control
    "nursing_hr_roster": "employee_id STRING, first_name STRING, last_name STRING, department STRING, unit STRING, "
    "role STRING, fte DOUBLE, hire_date DATE, term_date DATE, status STRING",
    "nursing_tas_schedule": "tas_worker_id STRING, worker_name STRING, department STRING, shift STRING, "
    "pay_period STRING, scheduled_hours DOUBLE, pto_hours DOUBLE",
    "nursing_pto_loa": "event_id STRING, employee_id STRING, leave_type STRING, start_date DATE, end_date DATE, "
    "hours DOUBLE",
    "nursing_demand_metrics": "department STRING, shift STRING, pay_period STRING, required_fte DOUBLE, census INT, "
    "demand_method STRING",
    "nursing_position_control": "department STRING, shift STRING, budgeted_positions INT, budgeted_fte DOUBLE, "
    "role_mix STRING",
    # Controlled substances
    "diversion_staff": "staff_id STRING NOT NULL, full_name STRING, role STRING, unit STRING, hire_date DATE, "
    "is_planted_diverter BOOLEAN",
    "diversion_omnicell_transactions": "txn_id STRING NOT NULL, staff_id STRING, patient_id STRING, med_name STRING, "
    "txn_type STRING, amount DOUBLE, timestamp TIMESTAMP, witness_id STRING, is_override BOOLEAN",
    "diversion_mar": "mar_id STRING NOT NULL, patient_id STRING, staff_id STRING, med_name STRING, "
    "admin_amount DOUBLE, admin_time TIMESTAMP, order_id STRING",
    "diversion_pain_scores": "pain_id STRING NOT NULL, patient_id STRING, score INT, documented_time TIMESTAMP",
    "diversion_provider_orders": "order_id STRING NOT NULL, patient_id STRING, med_name STRING, dose DOUBLE, "
    "ordering_provider STRING",
    "diversion_iris_scores": "staff_id STRING NOT NULL, period STRING, risk_score DOUBLE",
    # Equipment
    "htm_assets": "asset_number STRING, description STRING, device_type STRING, manufacturer STRING, model STRING, "
    "serial_number STRING, facility STRING, clinical_area STRING, purchase_date DATE, create_date DATE, "
    "end_of_support_date DATE, vendor_support_notes STRING, operating_system STRING, os_eol BOOLEAN, "
    "medigate_device_class STRING, mac_address STRING, ip_address STRING, replacement_cost DOUBLE, "
    "asset_status STRING",
    "htm_work_orders": "wo_id STRING, asset_number STRING, wo_date DATE, wo_type STRING, cost DOUBLE, "
    "downtime_hours DOUBLE, technician STRING",
}

COLUMN_COMMENTS = {
    "_cohort": "hidden truth, for scoring only",
    "_true_ckd_stage": "hidden truth, for scoring only",
    "is_planted_diverter": "hidden truth, for scoring only",
    "reason": "masked outside the scheduling office",
    "param_value": "text; cast on read by rule type",
    "wo_id": "may repeat; never a join key",
    "scheduled_hours": "already net of pto_hours",
    "role_mix": "JSON object role -> headcount",
    "end_date": "inclusive; NULL is open-ended",
}

TABLE_NAMES = tuple(_DDL)


def schema(table: str) -> T.StructType:
    """The StructType of a table, with comments kept as field metadata."""
    fields = T.StructType.fromDDL(_DDL[table]).fields
    return T.StructType(
        [
            T.StructField(
                f.name, f.dataType, f.nullable, {"comment": COLUMN_COMMENTS[f.name]} if f.name in COLUMN_COMMENTS else {}
            )
            for f in fields
        ]
    )


def required_keys(table: str) -> list[str]:
    return [f.name for f in schema(table).fields if not f.nullable]


def describe(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments to a DataFrame."""
    for name, text in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the table's columns in order; missing columns become NULL."""
    cols = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in schema(table).fields
    ]
    return df.select(*cols)
