"""Controlled-substance review: link events, build features, fire rules, compare with peers, report.

Rules and peer statistics decide flags; the text only restates them and never asserts guilt.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import after_hours, sentence
from tidewatch.operators import cohort, govern, matching, rules

FEATURES = (
    "waste_count_ratio",
    "waste_amount_ratio",
    "waste_no_witness_pct",
    "dispense_no_admin",
    "pain_not_dropping_pct",
    "after_hours_pct",
    "override_pct",
    "dose_deviation",
    "median_gap_s",
)


@dataclass(frozen=True)
class Windows:
    """Match windows in seconds and the limits of the rules (all open to change)."""

    dispense_s: int = 3_600
    pain_before_s: int = 3_600
    pain_after_s: int = 7_200
    min_drop: int = 2
    slow_gap_s: int = 2_700
    dose_tolerance: float = 0.05


def link_dispenses(
    txn: DataFrame, mar: DataFrame, on: Sequence[str], time: str = "timestamp", windows: Windows = Windows()
) -> DataFrame:
    """Each dispense with the administration it served, one-to-one, or NULL."""
    dispenses = txn.where(F.col("txn_type") == "dispense")
    return matching.interval_match(
        dispenses, mar, list(on), time, "admin_time", "txn_id", "mar_id",
        lo_s=0, hi_s=windows.dispense_s, right_cols={"admin_amount": "admin_amount"},
    ).withColumnRenamed("match_id", "mar_id").withColumnRenamed("match_time", "admin_time")


def describe_administrations(
    mar: DataFrame, orders: DataFrame, pain: DataFrame, pain_key: str = "patient_id", windows: Windows = Windows()
) -> DataFrame:
    """Each administration with its ordered dose and the pain scores around it."""
    dosed = mar.join(orders.select("order_id", "dose"), "order_id", "left")
    both = matching.asof_around(
        dosed, pain, [pain_key], "admin_time", "documented_time",
        before={"score_before": F.col("score"), "before_time": F.col("documented_time")},
        after={"score_after": F.col("score"), "after_time": F.col("documented_time")},
        before_s=windows.pain_before_s, after_s=windows.pain_after_s, tie="pain_id",
    )
    drop = F.col("score_before") - F.col("score_after")
    known = F.col("score_before").isNotNull() & F.col("score_after").isNotNull()
    return (
        both.withColumn("pain_documented", known)
        .withColumn("pain_drop", drop)
        .withColumn("pain_not_dropping", F.when(known, drop < windows.min_drop))
        .withColumn("dose_ratio", F.when(F.col("dose") > 0, F.col("admin_amount") / F.col("dose")))
    )


def link(
    txn: DataFrame, mar: DataFrame, orders: DataFrame, pain: DataFrame, on: Sequence[str],
    time: str = "timestamp", windows: Windows = Windows(),
) -> DataFrame:
    """Silver table: dispense, administration, order and pain scores in one row per dispense."""
    d = link_dispenses(txn, mar, on, time, windows).drop("admin_time", "admin_amount")
    a = describe_administrations(mar, orders, pain, windows=windows).select(
        "mar_id", "admin_time", "admin_amount", "order_id", "dose", "dose_ratio", "score_before", "score_after",
        "pain_documented", "pain_not_dropping",
    )
    return d.join(a, "mar_id", "left")


def period_of(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM")


def features(
    txn: DataFrame, linked: DataFrame, administrations: DataFrame, time: str = "timestamp"
) -> DataFrame:
    """One row per staff member and month.

    Cabinet rows, linked dispenses and administrations become one long table of 0/1 and amount columns
    and fold in a single aggregate. The median works on whole seconds, so its state per group is
    bounded by the match window, not by the rows.
    """
    kind = F.col("txn_type")
    one = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    amount = lambda c: F.when(c, F.round(F.col("amount") * 1000).cast("bigint")).otherwise(F.lit(0))
    cabinet = txn.select(
        "staff_id",
        period_of(time).alias("period"),
        one(kind == "dispense").alias("n_dispense"),
        one(kind == "waste").alias("n_waste"),
        amount(kind == "dispense").cast("bigint").alias("dispensed"),
        amount(kind == "waste").cast("bigint").alias("wasted"),
        one((kind == "waste") & F.col("witness_id").isNull()).alias("n_no_witness"),
        one((kind == "dispense") & after_hours(time)).alias("n_after_hours"),
        one((kind == "dispense") & F.col("is_override")).alias("n_override"),
    )
    links = linked.select(
        "staff_id",
        period_of(time).alias("period"),
        one(F.col("mar_id").isNull()).alias("n_no_admin"),
        F.round("gap_s").cast("bigint").alias("gap"),
    )
    admin = administrations.select(
        "staff_id",
        period_of("admin_time").alias("period"),
        F.lit(1).cast("bigint").alias("n_admin"),
        one(F.col("pain_documented")).alias("n_pain"),
        one(F.coalesce("pain_not_dropping", F.lit(False))).alias("n_flat_pain"),
        F.abs(F.col("dose_ratio") - 1).alias("deviation"),
    )
    rows = cabinet.unionByName(links, allowMissingColumns=True).unionByName(admin, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = ("n_dispense", "n_waste", "dispensed", "wasted", "n_no_witness", "n_after_hours", "n_override",
              "n_no_admin", "n_admin", "n_pain", "n_flat_pain")
    g = rows.groupBy("staff_id", "period").agg(
        *[total(c).alias(c) for c in counts],
        F.avg("deviation").alias("dose_deviation"),
        F.percentile("gap", 0.5).alias("median_gap_s"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return g.select(
        "staff_id",
        "period",
        "n_dispense",
        "n_waste",
        "n_admin",
        share("n_waste", "n_dispense").alias("waste_count_ratio"),
        share("wasted", "dispensed").alias("waste_amount_ratio"),
        share("n_no_witness", "n_waste").alias("waste_no_witness_pct"),
        F.col("n_no_admin").alias("dispense_no_admin"),
        share("n_flat_pain", "n_pain").alias("pain_not_dropping_pct"),
        share("n_after_hours", "n_dispense").alias("after_hours_pct"),
        share("n_override", "n_dispense").alias("override_pct"),
        "dose_deviation",
        "median_gap_s",
    )


# --- rules, one evidence row per violation; one pass over each of the three tables --------


def cabinet_rules(time: str = "timestamp") -> list[rules.Rule]:
    ref, at, dispense = F.col("txn_id"), F.col(time), F.col("txn_type") == "dispense"
    return [
        rules.Rule(
            "waste_without_witness", (F.col("txn_type") == "waste") & F.col("witness_id").isNull(), ref, at, F.col("amount")
        ),
        rules.Rule("after_hours", dispense & after_hours(time), ref, at, F.hour(at)),
        rules.Rule("override_pull", dispense & F.col("is_override"), ref, at, F.col("amount")),
    ]


def link_rules(time: str = "timestamp", windows: Windows = Windows()) -> list[rules.Rule]:
    ref, at = F.col("txn_id"), F.col(time)
    return [
        rules.Rule("dispense_without_admin", F.col("mar_id").isNull(), ref, at, F.col("amount")),
        rules.Rule(
            "slow_administration", F.col("gap_s") > windows.slow_gap_s, ref, at, F.col("gap_s"), windows.slow_gap_s
        ),
    ]


def administration_rules(windows: Windows = Windows()) -> list[rules.Rule]:
    ref, at, dose_limit = F.col("mar_id"), F.col("admin_time"), 1.0 + windows.dose_tolerance
    return [
        rules.Rule("pain_not_dropping", F.col("pain_not_dropping"), ref, at, F.col("pain_drop"), windows.min_drop),
        rules.Rule("pain_not_documented", ~F.col("pain_documented"), ref, at),
        rules.Rule("above_ordered_dose", F.col("dose_ratio") > dose_limit, ref, at, F.col("dose_ratio"), dose_limit),
    ]


def flags(
    txn: DataFrame, linked: DataFrame, administrations: DataFrame, time: str = "timestamp", windows: Windows = Windows()
) -> DataFrame:
    """All rules in one long evidence table."""
    return rules.stack_flags(
        rules.fire(txn, "staff_id", cabinet_rules(time)),
        rules.fire(linked, "staff_id", link_rules(time, windows)),
        rules.fire(administrations, "staff_id", administration_rules(windows)),
    )


# --- peers and score -----------------------------------------------------------


def peer_scores(feats: DataFrame, staff: DataFrame, min_peers: int = 5, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Leave-one-out scores against role x unit x month, wider to role x month where peers are few."""
    placed = feats.join(staff.select("staff_id", "role", "unit"), "staff_id", "left")
    return cohort.cohort_zscore(
        placed, ["staff_id", "period"], list(columns), [["role", "unit", "period"], ["role", "period"]], min_peers
    )


def blended_score(scores: DataFrame, risk: DataFrame, own_weight: float = 0.8, const_z: float = 3.0) -> DataFrame:
    """0.8 x mean positive z + 0.2 x outside risk score on 0..1. The outside score alone raises no flag.

    A feature without a z (no value, too few peers) is left out of the mean. Where all peers agree and a person lies
    above them there is no z either, but no clearer case: it counts as ``const_z``.
    """
    above = F.when(F.col("value") > F.col("peer_mean"), F.lit(const_z)).otherwise(F.lit(0.0))
    positive = F.when(F.col("const_peers"), above).when(F.col("z").isNotNull(), F.greatest(F.col("z"), F.lit(0.0)))
    g = scores.groupBy("staff_id", "period").agg(
        F.avg(positive).alias("mean_positive_z"),
        F.max("z").alias("max_z"),
        F.count_if(F.col("const_peers")).alias("n_const_peers"),
    )
    j = g.join(risk.select("staff_id", "period", "risk_score"), ["staff_id", "period"], "left")
    own = F.coalesce(F.col("mean_positive_z"), F.lit(0.0))
    outside = F.coalesce(F.col("risk_score"), F.lit(0.0)) / F.lit(100.0)
    return j.withColumn("blended", F.lit(own_weight) * own + F.lit(1.0 - own_weight) * outside)


def top_staff(blended: DataFrame, n: int = 10) -> DataFrame:
    return blended.orderBy(F.col("blended").desc(), "staff_id", "period").limit(n)


def planted_recall(blended: DataFrame, staff: DataFrame, k: int) -> DataFrame:
    """Do the planted people rank on top? One row per person (their highest month) before the top-k."""
    best = blended.groupBy("staff_id").agg(F.max("blended").alias("blended"))
    return cohort.precision_at(
        best.join(staff.select("staff_id", "is_planted_diverter"), "staff_id"),
        "blended", "staff_id", "is_planted_diverter", k,
    )


# --- report ---------------------------------------------------------------------


RULE_NAMES = [
    "waste_without_witness", "dispense_without_admin", "pain_not_dropping", "pain_not_documented",
    "slow_administration", "after_hours", "above_ordered_dose", "override_pull",
]


def rule_counts(flag_table: DataFrame, by: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Fired rules per person, one column per rule (a fixed list)."""
    return flag_table.groupBy(*by).agg(*[F.count_if(F.col("rule") == n).alias(n) for n in RULE_NAMES])


def narrative_text() -> Column:
    """Facts only, from the counts of one row."""
    say = lambda c, text: (F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(text)))
    return sentence(
        [
            say("waste_without_witness", " waste records carry no witness"),
            say("dispense_without_admin", " dispenses have no administration in the window"),
            say("pain_not_dropping", " administrations were not followed by a lower pain score"),
            say("pain_not_documented", " administrations lack a pain score before or after"),
            say("slow_administration", " administrations came late after the dispense"),
            say("after_hours", " dispenses were outside day hours"),
            say("above_ordered_dose", " administrations exceed the ordered dose"),
            say("override_pull", " dispenses were override pulls"),
        ]
    )


def report(
    staff_id: str, start: str, end: str, flag_table: DataFrame, blended: DataFrame, scores: DataFrame
) -> DataFrame:
    """The draft report for one person and window: counts by rule, highest scores and the features with their z of the
    window's months, narrative. For a reviewer to confirm; the evidence rows are ``report_evidence``."""
    mine = report_evidence(staff_id, start, end, flag_table)
    counts = rule_counts(mine)
    entity = F.col("staff_id").cast("string").alias("entity_id")
    score = _of_person(staff_id, start, end, blended).groupBy(entity).agg(
        F.max("max_z").alias("max_z"),
        F.max("blended").alias("blended"),
        F.max("risk_score").alias("risk_score"),
    )
    finding = F.struct("period", "feature", "value", "peer_mean", "z", "const_peers")
    found = report_scores(staff_id, start, end, scores).groupBy("entity_id").agg(
        F.sort_array(F.collect_list(finding)).alias("findings")  # features x months of one person
    )
    return (
        counts.join(score, "entity_id", "left")
        .join(found, "entity_id", "left")
        .withColumn("window_start", F.lit(start).cast("date"))
        .withColumn("window_end", F.lit(end).cast("date"))
        .withColumn("narrative", narrative_text())
        .withColumn("status", F.lit("draft for human review"))
    )


def _of_person(staff_id: str, start: str, end: str, monthly: DataFrame) -> DataFrame:
    """Rows of one person in the months that the window touches."""
    month = lambda day: F.date_format(F.lit(day).cast("date"), "yyyy-MM")
    return monthly.where((F.col("staff_id").cast("string") == staff_id) & F.col("period").between(month(start), month(end)))


def report_scores(staff_id: str, start: str, end: str, scores: DataFrame) -> DataFrame:
    """The person's features and peer scores in the months of the window."""
    rows = _of_person(staff_id, start, end, scores)
    return rows.select(F.col("staff_id").cast("string").alias("entity_id"), "period", "feature", "value", "peer_mean", "z", "const_peers")


def report_evidence(staff_id: str, start: str, end: str, flag_table: DataFrame) -> DataFrame:
    day = F.col("event_time").cast("date")
    inside = (day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date"))
    return flag_table.where((F.col("entity_id") == staff_id) & inside)


def narrate_all(flag_table: DataFrame) -> DataFrame:
    return rule_counts(flag_table).withColumn("narrative", narrative_text())


def audit_rows(reports: DataFrame, actor: str, at: str) -> DataFrame:
    """Who produced which text, when, on what evidence. Written with append only."""
    return reports.select(
        F.lit(actor).alias("actor"),
        F.lit(at).cast("timestamp_ntz").alias("produced_at"),
        "entity_id",
        F.sha2("narrative", 256).alias("narrative_hash"),
        F.to_json(F.struct(*RULE_NAMES)).alias("evidence"),
    )


def restricted_view(df: DataFrame, entitlements: DataFrame, user: str, scope: str, masked: dict[str, str]) -> DataFrame:
    """Only the investigator's scope, with patient columns masked."""
    return govern.mask_columns(govern.row_filter(df, entitlements, [scope], user), masked)
