"""Chronic-disease review candidates. Suggestions with evidence for a clinician, never a diagnosis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import albuminuria_stage, filtration_stage, stated_stage
from tidewatch.operators import quality, rules, skew, temporal

KEY = "patient_id"
TIER_ORDER = {"high": 1, "medium": 2, "low": 3}
RAPID_DECLINE = -5.0  # per year; published limit for rapid progression


def egfr_of(lab_results: DataFrame) -> DataFrame:
    return lab_results.where(F.col("test_name") == "eGFR").select("lab_id", KEY, "lab_date", "value")


def coded_patients(dx: DataFrame, prefix: str = "N18") -> DataFrame:
    return dx.where(F.col("icd10_code").startswith(prefix)).select(KEY).distinct()


def care_gap_summary(egfr: DataFrame, dx: DataFrame) -> DataFrame:
    """Lab evidence, coded, and evidence without a code: three counts from one pass over each table."""
    chronic = temporal.persistent_breach(egfr, KEY, "lab_date", "value").select(KEY, F.lit(True).alias("_lab"))
    coded = coded_patients(dx).withColumn("_coded", F.lit(True))
    both = chronic.join(coded, KEY, "full")
    lab, code = F.coalesce("_lab", F.lit(False)), F.coalesce("_coded", F.lit(False))
    return both.agg(
        F.count_if(lab).alias("patients_with_ckd_lab_evidence"),
        F.count_if(code).alias("patients_coded_n18"),
        F.count_if(lab & ~code).alias("care_gap_patients"),
    )


def care_gap_patients(egfr: DataFrame, dx: DataFrame) -> DataFrame:
    chronic = temporal.persistent_breach(egfr, KEY, "lab_date", "value")
    return chronic.join(coded_patients(dx), KEY, "left_anti")


def care_gap_flags(egfr: DataFrame, dx: DataFrame) -> DataFrame:
    """Every patient with lab evidence, with the gap kept as a column."""
    chronic = temporal.persistent_breach(egfr, KEY, "lab_date", "value")
    coded = coded_patients(dx).withColumn("_coded", F.lit(True))
    return chronic.join(coded, KEY, "left").select(
        KEY, "n_breach", "first_breach", "last_breach", F.col("_coded").isNull().alias("care_gap_flag")
    )


def latest_stated_stage(notes: DataFrame) -> DataFrame:
    """The stage the patient's latest staging note names. Notes that name none are filtered out first."""
    staged = notes.withColumn("note_stage", stated_stage("note_text")).where("note_stage IS NOT NULL")
    return staged.groupBy(KEY).agg(
        F.max_by("note_stage", F.struct("note_date", "note_id")).alias("note_stage"),
        F.max("note_date").alias("note_stage_date"),
    )


def latest_value(labs: DataFrame, out: str) -> DataFrame:
    return labs.where(F.col("value").isNotNull()).groupBy(KEY).agg(
        F.max_by("value", F.struct("lab_date", "lab_id", "value")).alias(out)
    )


def risk_tier(stage: Column, albuminuria: Column, slope: Column) -> Column:
    high = stage.isin("G4", "G5") | F.coalesce(slope <= RAPID_DECLINE, F.lit(False))
    medium = (stage == "G3b") | ((stage == "G3a") & F.coalesce(albuminuria.isin("A2", "A3"), F.lit(False)))
    return F.when(high, "high").when(medium, "medium").otherwise("low")


def candidates(
    egfr: DataFrame,
    dx: DataFrame,
    notes: DataFrame | None = None,
    uacr: DataFrame | None = None,
    creatinine: DataFrame | None = None,
    threshold: float = 60.0,
    min_gap_days: int = 90,
) -> DataFrame:
    """One row per patient whose low filtration values persist.

    All lab facts of a patient come from ONE aggregate over the lab table. The evidence column is of
    fixed size (the values that prove the flag); ``evidence_rows`` lists every value behind it.
    """
    v, day = F.col("value"), F.col("lab_date").cast("date")
    low = v < threshold
    low_at = F.when(low, day)
    at = F.struct(day, F.col("lab_id"))
    days = F.unix_date(day)
    facts = egfr.where(v.isNotNull()).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(low).alias("n_low"),
        F.min(low_at).alias("first_low_date"),
        F.max(low_at).alias("last_low_date"),
        F.min(v).alias("lowest_value"),
        F.max(day).alias("latest_egfr_date"),
        F.max_by(v, at).alias("latest_egfr"),
        (F.max(days) - F.min(days)).alias("_span"),
        F.regr_slope(v, days / F.lit(365.25)).alias("_slope"),
    )
    base = facts.where(F.datediff("last_low_date", "first_low_date") >= min_gap_days).withColumn(
        "slope_per_year", F.when((F.col("n_values") >= 3) & (F.col("_span") >= 90), F.col("_slope"))
    )
    base = base.join(coded_patients(dx).withColumn("_coded", F.lit(True)), KEY, "left")
    if uacr is not None:
        base = base.join(latest_value(uacr, "latest_uacr"), KEY, "left")
    else:
        base = base.withColumn("latest_uacr", F.lit(None).cast("double"))
    if creatinine is not None:
        base = base.join(latest_value(creatinine, "latest_creatinine"), KEY, "left")
    else:
        base = base.withColumn("latest_creatinine", F.lit(None).cast("double"))
    if notes is not None:
        base = base.join(latest_stated_stage(notes), KEY, "left")
    else:
        base = base.withColumn("note_stage", F.lit(None).cast("string"))

    stage = filtration_stage("latest_egfr")
    staged = base.withColumn("suggested_stage", stage).withColumn(
        "suggested_albuminuria", albuminuria_stage("latest_uacr")
    )
    agree = [
        F.lit(True),
        F.col("latest_egfr") < threshold,
        F.col("latest_creatinine") > 1.3,
        F.col("latest_uacr") >= 30,
        F.col("suggested_stage").startswith(F.concat(F.lit("G"), F.col("note_stage"))),
    ]
    evidence = F.to_json(
        F.struct(
            "n_values", "n_low", "first_low_date", "last_low_date", "lowest_value", "latest_egfr", "latest_egfr_date",
            "latest_uacr", "note_stage",
        )
    )
    return staged.select(
        KEY,
        "suggested_stage",
        "suggested_albuminuria",
        rules.confidence(agree).alias("confidence"),
        F.col("_coded").isNull().alias("care_gap_flag"),
        risk_tier(F.col("suggested_stage"), F.col("suggested_albuminuria"), F.col("slope_per_year")).alias("risk_tier"),
        "latest_egfr",
        "latest_egfr_date",
        "slope_per_year",
        "note_stage",
        evidence.alias("evidence_json"),
    )


def evidence_rows(cands: DataFrame, egfr: DataFrame, threshold: float = 60.0) -> DataFrame:
    """Every low value of every candidate, one row each."""
    return (
        egfr.where(F.col("value") < threshold)
        .join(cands.select(KEY), KEY, "left_semi")
        .select(KEY, "lab_id", F.col("lab_date").cast("date").alias("lab_date"), "value")
    )


def worklist(
    cands: DataFrame, encounters: DataFrame | None = None, as_of: str | None = None, days: int | None = None
) -> DataFrame:
    """Ranked for review: tier, then confidence, then the lowest filtration. Ranked without one big sort task."""
    if encounters is not None and as_of is not None and days is not None:
        cands = temporal.recently_active(cands, encounters, KEY, "encounter_date", as_of, days)
    tier = F.when(F.col("risk_tier") == "high", 1).when(F.col("risk_tier") == "medium", 2).otherwise(3)
    return skew.global_rank(
        cands,
        order=[tier, F.col("confidence").desc(), F.col("latest_egfr"), F.col(KEY)],
        buckets=[tier, -F.col("confidence"), F.floor(F.col("latest_egfr") * 10)],
        out="review_rank",
    )


def apply_reviews(ranked: DataFrame, decisions: DataFrame) -> DataFrame:
    """The latest decision per patient (confirm, adjust, dismiss) beside the suggestion."""
    last = temporal.latest_per_key(decisions, [KEY], ["decided_at", "decision_id"]).select(
        KEY, "decision", "adjusted_stage"
    )
    j = ranked.join(last, KEY, "left")
    stage = F.when(F.col("decision") == "adjust", F.col("adjusted_stage")).when(
        F.coalesce(F.col("decision"), F.lit("")) != "dismiss", F.col("suggested_stage")
    )
    return j.withColumn("review_status", F.coalesce("decision", F.lit("open"))).withColumn("final_stage", stage).drop(
        "decision", "adjusted_stage"
    )


def ambiguous(egfr: DataFrame, threshold: float = 60.0, min_gap_days: int = 90) -> DataFrame:
    """Low values that do not persist: a single one, or values on both sides of the limit."""
    v, low_day = F.col("value"), F.when(F.col("value") < threshold, F.col("lab_date").cast("date"))
    g = egfr.where(v.isNotNull()).groupBy(KEY).agg(
        F.count_if(v < threshold).alias("n_low"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        F.datediff(F.max(low_day), F.min(low_day)).alias("_gap"),
    )
    lasting = F.col("_gap") >= min_gap_days
    unclear = (F.col("n_low") == 1) | ((F.col("min_value") < threshold) & (F.col("max_value") >= threshold))
    return g.where((F.col("n_low") >= 1) & ~lasting & unclear).drop("_gap")


def quality_rules() -> dict[str, Column]:
    return {
        "patient id present": F.col(KEY).isNotNull(),
        "value present and positive": F.col("value") > 0,
        "filtration between 5 and 120": F.col("value").between(5, 120),
        "test name known": F.col("test_name").isin("eGFR", "creatinine", "UACR"),
    }


def lab_quality(labs: DataFrame) -> DataFrame:
    return quality.check(labs, {n: c for n, c in quality_rules().items() if n != "test name known" or "test_name" in labs.columns})
