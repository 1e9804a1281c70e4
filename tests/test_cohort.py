import random
import statistics

from pyspark.sql import functions as F

from tidewatch.operators import cohort, skew


def test_leave_one_out_constant_peers(spark, rows):
    df = spark.createDataFrame([(i, "c", "r", v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 1.0, 10.0])], "id int, u string, r string, x double")
    out = cohort.cohort_zscore(df, ["id"], ["x"], [["r", "u"], ["r"]], min_peers=5)
    got = {r["id"]: r for r in out.collect()}
    assert got[5]["z"] is None and got[5]["const_peers"] is True and got[5]["peer_mean"] == 1.0
    assert got[0]["const_peers"] is False and abs(got[0]["peer_mean"] - 2.8) < 1e-12
    assert abs(got[0]["z"] - (1 - 2.8) / statistics.stdev([1, 1, 1, 1, 10])) < 1e-9


def test_scores_equal_brute_force_with_fallback(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice("ab"), rnd.choice(["hot"] * 6 + ["x", "y"]), None if rnd.random() < 0.1 else float(rnd.randrange(9))) for i in range(60)]
    df = spark.createDataFrame(data, "id int, r string, u string, x double")
    out = {r["id"]: r for r in cohort.cohort_zscore(df, ["id"], ["x"], [["r", "u"], ["r"]], min_peers=6).collect()}
    for i, r, u, x in data:
        narrow = [d[3] for d in data if d[0] != i and d[1] == r and d[2] == u and d[3] is not None]
        wide = [d[3] for d in data if d[0] != i and d[1] == r and d[3] is not None]
        peers, level = (narrow, "r+u") if len(narrow) >= 6 else (wide, "r")
        got = out[i]
        assert got["cohort_level"] == level and got["n_peers"] == len(peers)
        if x is None or len(set(peers)) < 2:
            assert got["z"] is None
        else:
            assert abs(got["z"] - (x - statistics.mean(peers)) / statistics.stdev(peers)) < 1e-9


def test_cohort_of_one(spark):
    df = spark.createDataFrame([(1, "a", 5.0)], "id int, r string, x double")
    got = cohort.cohort_zscore(df, ["id"], ["x"], [["r"]]).first()
    assert got["n_peers"] == 0 and got["z"] is None and got["const_peers"] is False


def test_label_scores(spark, rows):
    df = spark.createDataFrame([("G1", "G1"), ("G1", "G2"), ("G2", "G2"), ("G3", "G1"), ("G3", "G3")], "p string, t string")
    out = cohort.evaluate_labels(df, "p", "t", ["G1", "G2", "G3"])
    assert rows(out, "label", "tp", "fp", "fn", "within_one") == [("G1", 1, 1, 1, 1), ("G2", 1, 0, 1, 2), ("G3", 1, 1, 0, 1)]


def test_precision_at_k(spark):
    df = spark.createDataFrame([(1, 9.0, True), (2, 8.0, False), (3, 1.0, True)], "id int, s double, y boolean")
    r = cohort.precision_at(df, "s", "id", "y", 2).first()
    assert (r["hits"], r["precision_at_k"], r["recall_at_k"]) == (1, 0.5, 0.5)


def test_equity_per_fte(spark):
    df = spark.createDataFrame([("s", 1, 1.0, True), ("s", 1, 1.0, True), ("s", 2, 0.5, True), ("s", 2, 0.5, False)], "site string, id int, fte double, n boolean")
    r = cohort.equity_spread(df, ["site"], "id", {"nights": F.col("n")}, "fte").first()
    assert r["nights_total"] == 3 and r["nights_range"] == 0.0


def test_global_rank_is_exact(spark, rows):
    rnd = random.Random(4)
    data = [(i, rnd.choice([1, 1, 1, 2, 3]), rnd.randrange(5) / 4) for i in range(300)]
    df = spark.createDataFrame(data, "id int, tier int, v double")
    out = skew.global_rank(df, [F.col("tier"), F.col("v").desc(), F.col("id")], [F.col("tier"), F.floor(-F.col("v"))])
    want = sorted(data, key=lambda r: (r[1], -r[2], r[0]))
    assert [r["id"] for r in out.orderBy("rank").collect()] == [r[0] for r in want]
    assert [r["rank"] for r in out.orderBy("rank").select("rank").collect()] == list(range(1, 301))


def test_salted_join_keeps_every_row_once(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    per = big.groupBy("k").count()
    out = skew.salted_join(big, per, ["k"], ["id"])
    assert out.count() == 1000 and out.where("k = 'hot'").select("count").distinct().first()[0] == 666
