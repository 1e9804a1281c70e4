import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import matching

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def left(spark, data):
    return spark.createDataFrame([(i, k, at(m) if m is not None else None) for i, k, m in data], "lid int, k string, lt timestamp_ntz")


def right(spark, data):
    return spark.createDataFrame([(i, k, at(m)) for i, k, m in data], "rid int, k string, rt timestamp_ntz")


def match(l, r, **kw):
    return matching.interval_match(l, r, ["k"], "lt", "rt", "lid", "rid", **kw)


def test_nearest_takes_the_later_dispense(spark, rows):
    out = match(left(spark, [(1, "s", 0), (2, "s", 5)]), right(spark, [(9, "s", 6)]))
    assert rows(out, "lid", "match_id") == [(1, None), (2, 9)]


def test_second_round_serves_the_left_over(spark, rows):
    l, r = left(spark, [(1, "s", 0), (2, "s", 5)]), right(spark, [(7, "s", 6), (8, "s", 8)])
    assert rows(match(l, r), "lid", "match_id") == [(1, 8), (2, 7)]
    assert rows(match(l, r, nearest_only=True), "lid", "match_id") == [(1, None), (2, 7)]


def test_window_edges(spark, rows):
    l = left(spark, [(1, "a", 0), (2, "b", 0), (3, "c", 0), (4, None, 0), (5, "d", None)])
    r = right(spark, [(1, "a", 0), (2, "b", 60), (3, "c", 61)])
    assert rows(match(l, r, hi_s=3600), "lid", "match_id") == [(1, None), (2, 2), (3, None), (4, None), (5, None)]


def test_lower_bound_is_exclusive(spark, rows):
    l, r = left(spark, [(1, "a", 0)]), right(spark, [(1, "a", 5), (2, "a", 6)])
    assert rows(match(l, r, lo_s=300, hi_s=3600), "lid", "match_id", "gap_s") == [(1, 2, 360.0)]


def test_unmatched_right_rows_on_request(spark, rows):
    l, r = left(spark, [(1, "a", 0)]), right(spark, [(1, "a", 5), (2, "z", 6)])
    assert rows(match(l, r, keep_right=True), "lid", "match_id") == [(1, 1), (None, 2)]


def test_bad_bounds(spark):
    with pytest.raises(ValueError):
        match(left(spark, []), right(spark, []), lo_s=10, hi_s=10)


def brute_match(ls, rs, hi):
    """Mutually nearest pairs are taken away until none is left."""
    got, ls, rs = {}, list(ls), list(rs)
    while True:
        def best_r(l):
            c = [(r[2] - l[2], r[0]) for r in rs if r[1] == l[1] and 0 < r[2] - l[2] <= hi]
            return min(c)[1] if c else None

        def best_l(r):
            c = [(r[2] - l[2], l[0]) for l in ls if r[1] == l[1] and 0 < r[2] - l[2] <= hi]
            return min(c)[1] if c else None

        pairs = [(l, r) for l in ls for r in rs if l[1] == r[1] and best_r(l) == r[0] and best_l(r) == l[0]]
        if not pairs:
            return got
        got |= {l[0]: r[0] for l, r in pairs}
        ls = [l for l in ls if l[0] not in got]
        rs = [r for r in rs if r[0] not in set(got.values())]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_match_equals_brute_force_with_a_hot_key(spark, rows, seed):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(4)}"
    ls = [(i, key(), rnd.randrange(6000 if seed < 3 else 200)) for i in range(90)]
    rs = [(i, key(), rnd.randrange(6000 if seed < 3 else 200)) for i in range(90)]
    # narrow slices, so that many decisions reach over a slice edge
    out = match(left(spark, ls), right(spark, rs), hi_s=90 * 60, slice_s=1)
    got = {i: m for i, m in rows(out, "lid", "match_id") if m is not None}
    assert got == brute_match(ls, rs, 90)
    assert len(set(got.values())) == len(got)


def test_batch_of_dispenses_then_administrations(spark, rows):
    """k left events, then k right events: all match, the last dispense with the first administration."""
    ls = [(100 * k + i, f"k{k}", i) for k in range(1, 51) for i in range(k)]
    rs = [(100 * k + i, f"k{k}", k + i) for k in range(1, 51) for i in range(k)]
    out = match(left(spark, ls), right(spark, rs), hi_s=200 * 60)
    assert dict(rows(out, "lid", "match_id")) == {100 * k + i: 100 * k + k - 1 - i for k in range(1, 51) for i in range(k)}


def brute_asof(ls, rs, back, tol):
    out = []
    for i, k, t in ls:
        if back:
            c = [(rt, r) for r, rk, rt in rs if rk == k and rt <= t and (tol is None or t - rt <= tol)]
            out.append((i, max(c)[1] if c else None))
        else:
            c = [(rt, r) for r, rk, rt in rs if rk == k and rt > t and (tol is None or rt - t <= tol)]
            out.append((i, min(c)[1] if c else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("tol", [None, 45])
def test_asof_equals_brute_force(spark, rows, direction, tol):
    rnd = random.Random(11)
    ls = [(i, f"k{rnd.randrange(3)}", rnd.randrange(3000)) for i in range(120)]
    rs = [(i, f"k{rnd.randrange(3)}", rnd.randrange(3000)) for i in range(80)]
    out = matching.asof_join(
        left(spark, ls), right(spark, rs), ["k"], "lt", "rt", {"hit": F.col("rid")}, direction,
        None if tol is None else tol * 60, tie="rid", slice_s=3600,
    )
    assert rows(out, "lid", "hit") == brute_asof(ls, rs, direction == "backward", tol)


def test_asof_keeps_rows_without_key_or_partner(spark, rows):
    l = left(spark, [(1, None, 0), (2, "x", 0), (3, "a", 0)])
    out = matching.asof_join(l, right(spark, [(5, "a", 0)]), ["k"], "lt", "rt", {"hit": F.col("rid")}, "backward", 60)
    assert rows(out, "lid", "hit") == [(1, None), (2, None), (3, 5)]


def test_one_shuffle(spark):
    out = match(left(spark, [(1, "s", 0)]), right(spark, [(7, "s", 6)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_around_equals_two_single_lookups(spark, rows):
    rnd = random.Random(7)
    ls = [(i, rnd.choice(["hot", "hot", "x", None]), rnd.randrange(3000)) for i in range(120)]
    rs = [(i, rnd.choice(["hot", "x"]), rnd.randrange(3000)) for i in range(90)]
    out = matching.asof_around(
        left(spark, ls), right(spark, rs), ["k"], "lt", "rt", {"b": F.col("rid")}, {"a": F.col("rid")},
        45 * 60, 20 * 60, tie="rid", slice_s=60,
    )
    want = {i: (b,) for i, b in brute_asof(ls, rs, True, 45)}
    want = {i: (*want[i], a) for i, a in brute_asof(ls, rs, False, 20)}
    assert {i: (b, a) for i, b, a in rows(out, "lid", "b", "a")} == want
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_latest_row_is_limited_before_the_shuffle(spark):
    from tidewatch.operators.temporal import latest_per_key

    plan = latest_per_key(right(spark, [(1, "a", 0)]), ["k"], ["rt"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")  # printed top down: a limit sits below
