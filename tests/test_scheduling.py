import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import scheduling as H

B = H.Block("2026-09-01", 28)
D = lambda n: dt.date(2026, 9, n)


@pytest.fixture(scope="module")
def world(spark):
    people = [(i, 0, "nocturnist" if i < 4 else "general", ["general"] + (["icu"] if i % 2 else []), 1.0, i, 8, 10, i < 5) for i in range(12)]
    prov = spark.createDataFrame(
        people,
        "provider_id bigint, site bigint, service_line string, credentials array<string>, fte double, seniority_years int, "
        "max_consecutive_shifts int, min_rest_hours int, wants_night_differential boolean",
    )
    rule = spark.createDataFrame(
        [("1", "max_consecutive", "6", "all"), ("2", "min_rest_hours", "10", "all"), ("3", "no_night_then_day", "true", "all"),
         ("4", "night_differential", "true", "all"), ("5", "max_shifts_per_block", "20", "all"),
         ("6", "min_shifts_per_block", "12", "all"), ("7", "max_consecutive", "7", "nocturnist")],
        "rule_id string, rule_type string, param_value string, applies_to string",
    )
    pto = spark.createDataFrame(
        [(1, 5, D(3), D(5), "approved"), (2, 6, D(3), None, "requested"), (3, 7, D(1), D(28), "denied")],
        "pto_id int, provider_id bigint, start_date date, end_date date, status string",
    )
    facts = H.provider_facts(prov, rule, pto, None, B)
    cov = spark.range(28).select(F.explode(F.array(*[F.lit(s) for s in ("day", "night", "swing")])).alias("shift_type"), "id").selectExpr(
        "0L site", "date_add(DATE '2026-09-01', CAST(id AS INT)) work_date", "shift_type",
        "CASE WHEN shift_type = 'day' THEN 'icu' ELSE 'general' END unit", "2 required_headcount",
    )
    return prov, facts, cov


def shifts(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "assignment_id int, provider_id bigint, site bigint, work_date date, shift_type string, unit string")


def test_limits_in_force(world, rows):
    _, facts, _ = world
    got = {r["provider_id"]: r for r in facts.collect()}
    assert got[0]["max_run"] == 7 and got[9]["max_run"] == 6
    assert got[5]["off_days"] == [D(3), D(4), D(5)] and len(got[6]["wished_days"]) == 26 and got[7]["off_days"] == []


def test_empty_schedule_is_a_full_shortfall(spark, world):
    _, facts, cov = world
    out = H.audit(shifts(spark, []), facts, cov, B).groupBy("rule").count().collect()
    assert {r["rule"]: r["count"] for r in out} == {"coverage_shortfall": 84, "below_block_min": 12}


def test_each_violation_is_found(spark, world, rows):
    _, facts, cov = world
    data = [
        (8, 0, D(1), "day", "icu"),            # no icu credential
        (5, 0, D(4), "day", "icu"),            # on approved leave
        (9, 0, D(10), "night", "general"),     # not opted in
        (1, 0, D(1), "night", "general"), (1, 0, D(2), "day", "icu"),      # night then day, no rest
        (3, 0, D(20), "day", "icu"), (3, 0, D(20), "night", "general"),    # twice on one date
        *[(11, 0, D(n), "day", "icu") for n in range(10, 17)],             # seven days, limit six
        *[(0, 0, D(n), "night", "general") for n in range(10, 17)],        # seven nights, a nocturnist may
    ]
    out = H.audit(shifts(spark, data), facts, cov, B).where("rule NOT IN ('coverage_shortfall', 'below_block_min')")
    got = {}
    for rule, who in rows(out, "rule", "entity_id"):
        got.setdefault(rule, []).append(who)
    assert got == {
        "credential_missing": ["8"], "on_approved_leave": ["5"], "night_without_optin": ["9"],
        "night_then_day": ["1"], "min_rest": ["1", "3"], "two_shifts_one_date": ["3"], "max_consecutive": ["11"],
    }


def test_draft_breaks_no_hard_rule(spark, world):
    _, facts, cov = world
    drafted = H.draft(cov, facts, B, "r")
    rows_ = H.draft_as_assignments(drafted)
    found = {r["rule"] for r in H.audit(rows_, facts, cov, B).select("rule").distinct().collect()}
    assert found <= {"coverage_shortfall", "below_block_min"}
    assert drafted.count() > 100
    again = H.draft(cov.repartition(5), facts, B, "r")
    assert H.diff(drafted, again).count() == 0  # the same draft for any partitioning


def test_what_if_shows_only_changes(spark, world, rows):
    _, facts, cov = world
    off = facts.withColumn("off_days", F.when(F.col("provider_id") == 1, F.array(F.lit("2026-09-01").cast("date"))).otherwise(F.col("off_days")))
    change = H.diff(H.draft(cov, facts, B, "a"), H.draft(cov, off, B, "b"))
    assert change.where("change = 'added' AND provider_id = 1 AND work_date = DATE '2026-09-01'").count() == 0
    assert change.count() > 0


def test_run_record_and_reasons(spark, world):
    _, facts, cov = world
    drafted = H.draft(cov, facts, B, "r")
    rows_ = H.draft_as_assignments(drafted)
    rec = H.run_record(drafted, H.audit(rows_, facts, cov, B), H.soft_score(rows_, facts), "r", {"days": "28"}).first()
    assert rec["status"] in ("feasible", "partial") and rec["params"] == {"days": "28"} and rec["n_assigned"] > 100
    assert "shifts assigned" in H.why_text(drafted).first()["why"]


def test_blocks_share_leave_rest_and_minimum(spark, world, rows):
    prov, _, cov = world
    two = H.Block("2026-09-01", 14, 2)
    rule = spark.createDataFrame(
        [("1", "max_consecutive", "6", "all"), ("2", "min_rest_hours", "10", "all"), ("3", "no_night_then_day", "true", "all"),
         ("4", "night_differential", "true", "all"), ("5", "max_shifts_per_block", "10", "all"), ("6", "min_shifts_per_block", "3", "all")],
        "rule_id string, rule_type string, param_value string, applies_to string",
    )
    pto = spark.createDataFrame([(1, 5, D(12), D(20), "approved"), (2, 6, D(20), None, "approved")], "pto_id int, provider_id bigint, start_date date, end_date date, status string")
    facts = H.provider_facts(prov, rule, pto, None, two).cache()
    off = {r["provider_id"]: r["off_days"] for r in facts.collect()}
    assert len(off[5]) == 9 and len(off[6]) == 9  # leave goes on behind the first block
    drafted = H.draft(cov, facts, two, "r").cache()
    audited = H.audit(H.draft_as_assignments(drafted), facts, cov, two)
    assert audited.where(~F.col("rule").isin(*H.OPEN_RULES)).count() == 0
    assert H.with_hard_ok(drafted, audited).where("NOT is_hard_ok").count() == 0
    # only in the first block: below the minimum in the second
    early = shifts(spark, [(8, 0, D(n), "day", "general") for n in range(1, 5)])
    low = H.block_violations(early, facts.where("provider_id = 8"), two)
    assert rows(low, "rule", "ref_id") == [("below_block_min", "1")]


def test_hard_ok_follows_the_audit(spark, world):
    _, facts, cov = world
    bad = spark.createDataFrame(
        [("r", 0, 8, D(1), "day", "icu", 1), ("r", 0, 9, D(1), "day", "icu", 1)],
        "run_id string, site bigint, provider_id bigint, work_date date, shift_type string, unit string, seat int",
    )
    audited = H.audit(H.draft_as_assignments(bad), facts, cov, B)
    assert {r["provider_id"]: r["is_hard_ok"] for r in H.with_hard_ok(bad, audited).collect()} == {8: False, 9: True}


def greedy(pairs):
    """The auction's fixed point by brute force: all bids in falling order, taken where slot and provider still can."""
    heads, duties, out = {}, {}, []
    for r in sorted(pairs, key=lambda r: tuple(r.bid), reverse=True):
        slot = (r.site, r.work_date, r.shift_type, r.unit)
        mine = duties.setdefault(r.provider_id, H.Duties(r.rest_hours, r.night_day_rule, r.max_run, r.block_max, 12))
        if heads.get(slot, 0) < r.required_headcount and mine.take(r.day, r.block, r.begin, r.shift_type):
            heads[slot] = heads.get(slot, 0) + 1
            out.append((*slot, r.provider_id))
    return sorted(out)


@pytest.mark.parametrize("sites", [1, 3])
def test_auction_equals_greedy_and_has_no_blocking_pair(spark, world, sites):
    prov, _, cov = world
    rule = spark.createDataFrame(
        [("1", "max_consecutive", "4", "all"), ("2", "min_rest_hours", "14", "all"), ("3", "no_night_then_day", "true", "all"),
         ("4", "max_shifts_per_block", "6", "all"), ("5", "max_shifts_per_block", "4", "3")],
        "rule_id string, rule_type string, param_value string, applies_to string",
    )
    pref = spark.createDataFrame(
        [(p, s, d, (p * 7 + len(s) * 3 + i) % 5 - 1, p % 2 == 0, None) for p in range(12) for s in ("day", "night", "swing")
         for i, d in enumerate(("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"))],
        "provider_id bigint, shift_type string, weekday string, preference_weight int, wants_consecutive boolean, max_shifts_per_block int",
    )
    two = H.Block("2026-09-01", 14, 2)
    prov = prov.withColumn("site", F.col("provider_id") % sites)
    cov = cov.crossJoin(spark.range(sites).select(F.col("id").alias("s"))).withColumn("site", F.col("s")).drop("s")
    facts = H.provider_facts(prov, rule, spark.createDataFrame([], "pto_id int, provider_id bigint, start_date date, end_date date, status string"), pref, two).cache()
    pairs = H.bids(cov, facts, two)
    drafted = H.draft(cov.union(cov).repartition(3), facts, two, "r")
    got = sorted((r.site, r.work_date, r.shift_type, r.unit, r.provider_id) for r in drafted.collect())
    assert got == greedy(pairs.collect()) and len(got) > 60
    assert H.blocking_pairs(drafted, cov, facts, two).count() == 0
    assert H.blocking_pairs(drafted.where("provider_id <> 5"), cov, facts, two).count() > 0
    assert drafted.groupBy(*H.SLOT, "seat").count().where("count > 1").count() == 0


def test_draft_of_empty_tables(spark, world):
    _, facts, cov = world
    assert H.draft(cov.where("false"), facts, B, "r").count() == 0
    assert H.draft(cov, facts.where("false"), B, "r").count() == 0


def test_tables_per_provider_are_shuffled_and_dealt_before_they_are_folded(spark, world):
    """Their files say little about their size in memory: no broadcast of them, no fold of whole scans."""
    prov, facts, cov = world
    staged = spark.createDataFrame(facts.collect(), facts.schema)
    done = shifts(spark, [(1, 0, D(1), "day", "icu")])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    frames = [H.eligible(cov, staged), H.enriched_assignments(done, staged), H.run_violations(done, staged), H.block_violations(done, staged, B), H.soft_score(done, staged)]
    for out in frames:
        assert "strategy=merge" in out._jdf.queryExecution().optimizedPlan().toString()
    cells = spark.createDataFrame([(1, "day", "Mon", 3, True, 14), (1, "day", "Mon", 5, False, 12)], "provider_id bigint, shift_type string, weekday string, preference_weight int, wants_consecutive boolean, max_shifts_per_block int")
    rule = spark.createDataFrame([("1", "max_consecutive", "6", "all")], "rule_id string, rule_type string, param_value string, applies_to string")
    pto = spark.createDataFrame([], "pto_id int, provider_id bigint, start_date date, end_date date, status string")
    made = H.provider_facts(prov, rule, pto, cells, B)
    lines = plan(made).splitlines()
    folds = [i for i, x in enumerate(lines) if "partial_max(preference_weight" in x or "partial_min(" in x and "max_consecutive" in x]
    assert len(folds) >= 2 and all("REPARTITION_BY_COL" in "".join(lines[i : i + 4]) for i in folds)
    one = {r["provider_id"]: r for r in made.collect()}[1]
    assert one["weights"] == {"day|Mon": 5} and one["own_max_shifts"] == 12 and one["wants_consecutive"]


def test_many_rows_are_dealt_to_a_number_of_tasks(spark):
    from tidewatch.operators.skew import dealt

    df = spark.range(100)
    assert dealt(df, ["id"], 1_000, 10).rdd.getNumPartitions() == 100
    assert sorted(r["id"] for r in dealt(df, ["id"], 100, 50).collect()) == list(range(100))


def test_pairs_meet_their_limits_before_they_are_made(spark, world):
    """A lookup by provider after the join of slots and providers would shuffle all pairs once more."""
    _, facts, cov = world
    staged = spark.createDataFrame(facts.collect(), facts.schema)
    plan = H.bids(cov, staged, B)._jdf.queryExecution().executedPlan().toString()
    outer = next(x for x in plan.splitlines() if "Join" in x)
    assert "required_credential" in outer and "provider_id]" not in outer
    limits = H.bids(cov, staged, B).select("provider_id", *H.LIMITS).distinct().collect()
    assert {(r["provider_id"], r["max_run"]) for r in limits} >= {(0, 7.0), (9, 6.0)} and {r["rest_hours"] for r in limits} == {10.0}


def test_blocking_pairs_are_made_once_and_found(spark, world):
    _, facts, cov = world
    drafted, stored = H.draft(cov, facts, B, "r"), []

    def stage(df, name):
        stored.append(name)
        return df.cache()

    assert H.blocking_pairs(drafted, cov, facts, B, stage=stage).count() == 0 and stored == ["pairs"]
    lone = drafted.where("work_date <> DATE '2026-09-09'")
    left = H.blocking_pairs(lone, cov, facts, B, stage=stage).collect()
    assert left and {r["work_date"] for r in left} >= {D(9)}


def test_many_prices_are_shuffled_every_round(spark, world, monkeypatch):
    """A broadcast of each round's prices would stay in the driver, and grow with the slots."""
    _, facts, cov = world
    staged, plans = spark.createDataFrame(facts.collect(), facts.schema), []

    def stage(df, name):
        if name.startswith("claims") and name != "claims-0":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return spark.createDataFrame(df.collect(), df.schema)

    few = H.draft(cov, staged, B, "r", stage=stage).drop("run_id").collect()
    assert plans and not any("strategy=merge" in p for p in plans)
    plans.clear()
    monkeypatch.setattr(H, "FEW_PRICES", 0)
    many = H.draft(cov, staged, B, "r", stage=stage).drop("run_id").collect()
    assert plans and all("strategy=merge" in p for p in plans) and sorted(few) == sorted(many)


def many_sites(spark, world, sites=20):
    """Twelve people and a week of slots at each site, with limits that bring them into each other's way."""
    prov, _, cov = world
    rule = spark.createDataFrame(
        [("1", "max_consecutive", "3", "all"), ("2", "min_rest_hours", "14", "all"), ("3", "no_night_then_day", "true", "all"), ("4", "max_shifts_per_block", "4", "all")],
        "rule_id string, rule_type string, param_value string, applies_to string",
    )
    pto = spark.createDataFrame([(1, 5, D(2), D(4), "approved"), (2, 6, D(3), None, "requested")], "pto_id int, provider_id bigint, start_date date, end_date date, status string")
    each = spark.range(sites).select(F.col("id").alias("s"))
    prov = prov.crossJoin(each).withColumn("site", F.col("s")).withColumn("provider_id", F.col("provider_id") + 12 * F.col("s")).drop("s")
    cov = cov.where("work_date < DATE '2026-09-08'").crossJoin(each).withColumn("site", F.col("s")).drop("s")
    facts = H.provider_facts(prov, rule, pto, None, B)
    return spark.createDataFrame(facts.collect(), facts.schema), spark.createDataFrame(cov.collect(), cov.schema)


def test_small_sites_are_settled_at_once_as_by_rounds(spark, world, monkeypatch):
    """Their pairs are shuffled once; a site above its share goes by rounds, with the same draft."""
    facts, cov = many_sites(spark, world)
    stored = []

    def stage(df, name):
        stored.append(name)
        return spark.createDataFrame(df.collect(), df.schema)

    whole = H.draft(cov, facts, B, "r", stage=stage).collect()
    assert not any(n.startswith("claims") for n in stored) and "pairs" not in stored
    pairs = H.bids(cov, facts, B).collect()
    assert sorted((r.site, r.work_date, r.shift_type, r.unit, r.provider_id) for r in whole) == greedy(pairs) and len(whole) > 400
    stored.clear()
    bigger = cov.union(cov.where("site = 3").withColumn("unit", F.lit("ward")))
    mixed = H.draft(bigger, facts, B, "r", stage=stage).collect()
    assert "claims-0" in stored  # the site has two of 21 parts of all pairs
    stored.clear()
    monkeypatch.setattr(H, "SITE_PART", 1)
    assert sorted(H.draft(bigger, facts, B, "r", stage=stage).collect()) == sorted(mixed) and "claims-0" not in stored
    monkeypatch.setattr(H, "SITE_PAIRS", 0)
    assert sorted(H.draft(cov, facts, B, "r", stage=stage).collect()) == sorted(whole)


def test_sites_that_share_a_provider_go_by_rounds(spark, world):
    facts, cov = many_sites(spark, world)
    lent = facts.where("provider_id = 3").withColumn("site", F.lit(7).cast("bigint"))
    rows_ = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in (("facts", facts.union(lent)), ("slots", H.slots_of(cov)))}
    found, n_pairs = H.sites_by_rounds(rows_["slots"], rows_["facts"], lambda df, name: df, False)
    assert {r["site"] for r in found.collect()} == {0, 7} and n_pairs > 20 * 7 * 12
    assert H.sites_by_rounds(rows_["slots"], spark.createDataFrame(facts.collect(), facts.schema), lambda df, name: df, False)[0] is None


def test_duties_keep_rest_to_near_and_far_days():
    for rest in (None, 0, 10, 13, 30, 400, float("nan")):
        for hours in (8, 12):
            mine, taken = H.Duties(rest, False, None, None, hours), []
            for k in range(60):
                day, hour = (k * 17) % 61, (7, 12, 19, 0, 23)[k % 5]
                begin = day * 24 + hour
                free = all(d != day and not (rest is not None and abs(b - begin) - hours < rest) for d, b in taken)
                assert mine.take(day, 0, begin, "day") == free
                if free:
                    taken.append((day, begin))


def test_blocking_pairs_store_only_the_draft(spark, world):
    """All pairs are made from slots and providers that bring the draft along; none of them is stored or shuffled."""
    _, facts, cov = world
    drafted, stored = H.draft(cov, facts, B, "r").cache(), {}

    def stage(df, name):
        stored[name] = df.cache()
        return stored[name]

    out = H.blocking_pairs(drafted.where("provider_id % 3 <> 1"), cov, facts, B, stage=stage)
    assert out.count() > 0 and stored["pairs"].count() == drafted.where("provider_id % 3 <> 1").count()


def test_bids_of_one_score_fall_by_tie_and_id():
    pa = H.pa
    site = H.np.array([1, 1, 1, 1, 1, 1, 0])
    score = pa.array([1.0, None, float("nan"), 2.0, 2.0, -0.0, 0.0])
    tie, who = pa.array([5, 1, 1, -7, -7, 3, 2]), pa.array(["a", "b", "c", "d", "e", "f", "g"])
    assert H._falling(site, score, tie, who).tolist() == [6, 2, 4, 3, 0, 5, 1]
