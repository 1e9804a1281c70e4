from pyspark.sql import functions as F

from tidewatch.functions import scalars as S
from tidewatch.operators import rules


def one(spark, values, kind, col):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(col).collect()]


def test_filtration_stages(spark):
    got = one(spark, [90.0, 89.9, 60.0, 59.9, 45.0, 30.0, 15.0, 14.9, None], "double", S.filtration_stage("v"))
    assert got == ["G1", "G2", "G2", "G3a", "G3a", "G3b", "G4", "G5", None]


def test_albuminuria_stages(spark):
    assert one(spark, [29.9, 30.0, 300.0, 300.1, None], "double", S.albuminuria_stage("v")) == ["A1", "A2", "A2", "A3", None]


def test_stated_stage(spark):
    notes = [
        "Assessment: CKD stage 3b (G3b), likely x", "Annual visit", "chronic kidney disease G4, stable",
        "CKD G2 then CKD stage 5", "ckd stage 3 noted", None,
    ]
    assert one(spark, notes, "string", S.stated_stage("v")) == ["3b", None, "4", "2", "3", None]


def test_names(spark):
    got = one(spark, [" Bob J. Smith RN", "ann  lee", "Mary Stone RN"], "string", S.clean_name("v"))
    assert got == ["BOB SMITH", "ANN LEE", "MARY STONE"]
    assert one(spark, ["BOB", "ZED"], "string", S.fold_nickname("v")) == ["ROBERT", "ZED"]


def test_ids_are_never_cut(spark):
    assert one(spark, [7, 12345678], "long", S.surrogate_id("PAT-", "v", 6)) == ["PAT-000007", "PAT-12345678"]


def test_money_is_exact_in_any_order(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(1e9,)], "v double")
    assert df.agg(S.money_sum("v")).first()[0] == 1_000_000_100.0
    assert df.repartition(7).agg(S.money_sum("v")).first()[0] == 1_000_000_100.0


def test_weighted_bucket_follows_the_odds(spark):
    df = spark.range(20000).select(S.weighted_bucket("id", [("a", 0.4), ("b", 0.3), ("c", 0.3)]).alias("b"))
    share = {r["b"]: r["count"] / 20000 for r in df.groupBy("b").count().collect()}
    assert abs(share["a"] - 0.4) < 0.02 and abs(share["b"] - 0.3) < 0.02


def test_abnormal_flags(spark, rows):
    df = spark.createDataFrame(
        [("eGFR", 59.9), ("eGFR", 60.0), ("creatinine", 1.3), ("creatinine", 1.31), ("UACR", 30.0), ("UACR", None)],
        "t string, v double",
    )
    got = [r["abnormal_flag"] for r in rules.flag_abnormal(df, "t", "v", rules.KIDNEY_LIMITS).collect()]
    assert got == ["L", "N", "N", "H", "H", None]


RULES = [
    ("r1", "max_consecutive", "6", "all"), ("r2", "max_consecutive", "7", "nocturnist"),
    ("r3", "max_consecutive", "4", "42"), ("r4", "min_rest_hours", "10", "all"), ("r5", "min_rest_hours", "11", "all"),
    ("r6", "night_differential", "true", "all"), ("r7", "max_shifts_per_block", "many", "all"),
]


def test_rule_scopes_and_strictness(spark, rows):
    r = spark.createDataFrame(RULES, "rule_id string, rule_type string, param_value string, applies_to string")
    p = spark.createDataFrame([(1, "nocturnist"), (2, "general"), (42, "nocturnist")], "pid int, line string")
    got = rows(rules.resolve_rules(r, p, "pid", "line"), "pid", "rule_type", "value", "scope_used")
    runs = {(a): (c, d) for a, b, c, d in got if b == "max_consecutive"}
    assert runs == {1: (7.0, "group"), 2: (6.0, "all"), 42: (4.0, "entity")}
    assert {c for a, b, c, d in got if b == "min_rest_hours"} == {11.0}
    assert not [1 for a, b, c, d in got if b == "max_shifts_per_block"]  # a bad cast is not zero
    bad = rules.typed_rules(r, ["night_differential"]).where("bad_value")
    assert rows(bad, "rule_id") == [("r7",)]


def test_confidence_leaves_out_absent_evidence(spark):
    df = spark.createDataFrame([(True, None, False), (True, True, True), (None, None, None)], "a boolean, b boolean, c boolean")
    got = [r[0] for r in df.select(rules.confidence([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == [0.5, 1.0, None]


def test_rules_of_one_table_share_one_pass(spark, rows):
    df = spark.createDataFrame([("s", 1, 5.0), ("s", 2, 50.0)], "who string, ref int, v double").withColumn(
        "t", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    specs = [rules.Rule(n, F.col("v") > lim, F.col("ref"), F.col("t"), F.col("v"), lim) for n, lim in (("a", 1.0), ("b", 10.0))]
    out = rules.fire(df, "who", specs)
    assert rows(out, "rule", "ref_id", "measure", "limit_value") == [
        ("a", "1", 5.0, 1.0), ("a", "2", 50.0, 1.0), ("b", "2", 50.0, 10.0)
    ]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
