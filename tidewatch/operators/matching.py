"""Time matching between two event tables: nearest one-to-one matches and as-of lookups.

No pair is ever built. Both sides go into one ordered sequence per (key, time slice); rows near a
slice edge are copied into the neighbouring slice, so each slice is complete on its own. One shuffle,
and a hot key spreads over its slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.scalars import wall_us
from tidewatch.operators.temporal import DAY_S, same_key

HOUR_S = 3_600


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def interval_match(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    left_id: str,
    right_id: str,
    lo_s: int = 0,
    hi_s: int = 3_600,
    nearest_only: bool = False,
    right_cols: Mapping[str, str] | None = None,
    slice_s: int | None = None,
    keep_right: bool = False,
) -> DataFrame:
    """Match each left event to one right event with ``lo_s < right - left <= hi_s``, one-to-one.

    A pair is taken when each is the other's nearest partner; in a sequence ordered by time that is a
    left event directly followed by a right event. What is taken leaves the sequence, and so on until
    no such pair is left: an event whose nearest partner went to another still finds its next one. That
    is how brackets match, so a pair is two events of one nesting level that follow each other there:
    no repetition is needed. ``nearest_only`` stops after the pairs that are each other's nearest.

    What a pair is hangs on the events between its two ends only, so a slice with copies of all events
    within ``hi_s`` of it decides its own events. Two windows share one shuffle. A slice is
    ``4 * hi_s`` wide (an event is copied 1.5 times on average); for hot keys ``slice_s`` makes it
    narrower, down to ``hi_s`` (three times).

    Returns every left row once with ``match_id, match_time, gap_s`` and ``right_cols``
    (source -> new name), NULL where unmatched. ``keep_right`` adds unmatched right rows (left columns
    NULL apart from ``on``).
    """
    if lo_s < 0 or hi_s <= lo_s:
        raise ValueError("need 0 <= lo_s < hi_s")
    right_cols = dict(right_cols or {})
    reach = hi_s * 1_000_000
    width = (4 * hi_s if slice_s is None else max(slice_s, hi_s)) * 1_000_000
    shift = lo_s * 1_000_000
    span = (hi_s - lo_s) * 1_000_000

    def sliced(df: DataFrame) -> DataFrame:
        home = F.floor(F.col("_us") / F.lit(width)).cast("bigint")
        first = F.floor((F.col("_us") - F.lit(reach)) / F.lit(width)).cast("bigint")
        last = F.floor((F.col("_us") + F.lit(reach)) / F.lit(width)).cast("bigint")
        return df.withColumn("_home", home).withColumn("_slice", F.explode(F.sequence(first, last)))

    has_key = F.lit(True)
    for k in on:
        has_key = has_key & F.col(k).isNotNull()
    usable = has_key & F.col(left_time).isNotNull()
    lefts = left.where(usable).select(
        *left.columns,
        F.lit(1).alias("_side"),
        (wall_us(left_time) + F.lit(shift)).alias("_us"),
        F.col(left_id).alias("_lid"),
    )
    payload = F.struct(
        F.col(right_id).alias("id"), F.col(right_time).alias("at"), *[F.col(s).alias(d) for s, d in right_cols.items()]
    )
    rights = right.where(has_key & F.col(right_time).isNotNull()).select(
        *on,
        F.lit(0).alias("_side"),
        wall_us(right_time).alias("_us"),
        F.col(right_id).alias("_rid"),
        payload.alias("_pay"),
    )
    seq = sliced(lefts).unionByName(sliced(rights), allowMissingColumns=True)
    group = f"PARTITION BY {', '.join(_q(k) for k in on)}, _slice"
    order = "ORDER BY _us, _side, _lid DESC, _rid"
    if not nearest_only:
        # The nesting level after a left event and before a right one.
        rise = F.expr(f"sum(2 * _side - 1) OVER ({group} {order} ROWS UNBOUNDED PRECEDING)")
        seq = seq.withColumn("_level", F.when(F.col("_side") == 1, rise).otherwise(rise + 1))
        group += ", _level"
    seq = (
        seq.withColumn("_item", F.struct("_side", "_us", "_pay"))
        .withColumn("_next", F.expr(f"lead(_item) OVER ({group} {order})"))
        .withColumn("_before", F.expr(f"lag(_item) OVER ({group} {order})"))
    )
    takes = (F.col("_side") == 1) & (F.col("_next._side") == 0) & (F.col("_next._us") - F.col("_us") <= span)
    taken = (F.col("_side") == 0) & (F.col("_before._side") == 1) & (F.col("_us") - F.col("_before._us") <= span)
    seq = seq.withColumn("_m", F.when(takes, F.col("_next._pay"))).withColumn("_taken", F.coalesce(taken, F.lit(False)))
    keep = F.col("_slice") == F.col("_home")
    if not keep_right:
        keep = keep & (F.col("_side") == 1)
    else:
        keep = keep & ((F.col("_side") == 1) | ~F.col("_taken"))
    m = F.when(F.col("_side") == 0, F.col("_pay")).otherwise(F.col("_m"))
    gap = F.when(F.col("_side") == 1, (wall_us(F.col("_m.at")) - F.col("_us") + F.lit(shift)) / F.lit(1_000_000.0))
    matched = seq.where(keep).select(
        *[F.col(c) for c in left.columns],
        m["id"].alias("match_id"),
        m["at"].alias("match_time"),
        gap.alias("gap_s"),
        *[m[d].alias(d) for d in right_cols.values()],
    )
    rest = left.where(~usable)  # a row without key or time can match nothing, and is still returned
    return matched.unionByName(rest, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    cols: Mapping[str, Column],
    direction: str = "backward",
    tolerance_s: int | None = None,
    tie: str | None = None,
    slice_s: int | None = None,
) -> DataFrame:
    """Per left row, the nearest right row at or before (``backward``) or after (``forward``) it.

    An equal time counts as backward. Equal right times: the largest ``tie`` wins backward, the
    smallest forward. ``cols`` maps new column names to expressions over the right row. With a
    tolerance, right rows are copied only into the slices they can serve; without one, a summary of
    one row per (key, slice) carries the last value across slices.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    back = direction == "backward"
    tie_col = F.col(tie) if tie else F.lit(0)
    has_key = F.col(right_time).isNotNull()
    for k in on:
        has_key = has_key & F.col(k).isNotNull()
    hit = F.struct(wall_us(right_time).alias("us"), tie_col.alias("tie"), *[c.alias(n) for n, c in cols.items()])
    lefts = left.withColumn("_us", wall_us(left_time)).withColumn("_side", F.lit(1))
    rights = right.where(has_key).select(
        *on, wall_us(right_time).alias("_us"), F.lit(0).alias("_side"), hit.alias("_hit")
    ).withColumn("_tie", F.col("_hit.tie"))

    if tolerance_s is not None:
        width = max(slice_s or HOUR_S, 2 * tolerance_s) * 1_000_000
    else:
        width = (slice_s or DAY_S) * 1_000_000
    slice_of = lambda us: F.floor(us / F.lit(width)).cast("bigint")
    lefts = lefts.withColumn("_slice", slice_of(F.col("_us")))
    if tolerance_s is None:
        rights = rights.withColumn("_slice", slice_of(F.col("_us")))
    else:
        tol = F.lit(tolerance_s * 1_000_000)
        far = F.col("_us") + tol if back else F.col("_us") - tol
        lo, hi = (F.col("_us"), far) if back else (far, F.col("_us"))
        rights = rights.withColumn("_slice", F.explode(F.sequence(slice_of(lo), slice_of(hi))))

    seq = lefts.unionByName(rights, allowMissingColumns=True)
    if back:
        order = [F.col("_us").asc(), F.col("_side").asc(), F.col("_tie").asc()]
    else:
        order = [F.col("_us").desc(), F.col("_side").desc(), F.col("_tie").desc()]
    w = W.partitionBy(*on, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    near = seq.withColumn("_near", F.last("_hit", ignorenulls=True).over(w)).where("_side = 1")

    if tolerance_s is None:
        best = F.when(F.col("_hit").isNotNull(), F.struct(F.col("_us"), F.col("_tie")))
        pick = F.max_by("_hit", best) if back else F.min_by("_hit", best)
        per_slice = seq.groupBy(*on, "_slice").agg(pick.alias("_edge"))
        step = F.col("_slice").asc() if back else F.col("_slice").desc()
        wk = W.partitionBy(*on).orderBy(step).rowsBetween(W.unboundedPreceding, -1)
        carry = per_slice.withColumn("_carry", F.last("_edge", ignorenulls=True).over(wk)).select(
            *[F.col(k).alias(f"_k_{k}") for k in on], F.col("_slice").alias("_k_slice"), "_carry"
        )
        cond = same_key(near, carry, on, "_k_") & near["_slice"].eqNullSafe(carry["_k_slice"])
        near = near.join(carry, cond, "left").withColumn("_near", F.coalesce("_near", "_carry"))
        found = F.col("_near").isNotNull()
    else:
        gap = F.abs(F.col("_us") - F.col("_near.us"))
        found = gap <= tolerance_s * 1_000_000
    return near.select(
        *[F.col(c) for c in left.columns], *[F.when(found, F.col(f"_near.{n}")).alias(n) for n in cols]
    )


def asof_around(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    before: Mapping[str, Column],
    after: Mapping[str, Column],
    before_s: int,
    after_s: int,
    tie: str,
    slice_s: int = HOUR_S,
) -> DataFrame:
    """The last right row at or before, and the first one after, in ONE shuffle and ONE sort.

    Same rules as two ``asof_join`` calls. Rights sort before lefts of the same time, so the running
    last value looks back and the next non-null value looks ahead in the same order.
    """
    has_key = F.col(right_time).isNotNull()
    for k in on:
        has_key = has_key & F.col(k).isNotNull()
    parts = {"us": wall_us(right_time), **{f"b_{n}": c for n, c in before.items()}, **{f"a_{n}": c for n, c in after.items()}}
    width = max(slice_s, 2 * before_s, 2 * after_s) * 1_000_000
    slice_of = lambda us: F.floor(us / F.lit(width)).cast("bigint")
    lefts = left.withColumn("_us", wall_us(left_time)).withColumn("_side", F.lit(1))
    lefts = lefts.withColumn("_slice", slice_of(F.col("_us")))
    # a right row serves lefts from after_s earlier to before_s later
    reach = F.sequence(
        slice_of(F.col("_us") - F.lit(after_s * 1_000_000)), slice_of(F.col("_us") + F.lit(before_s * 1_000_000))
    )
    rights = right.where(has_key).select(
        *on,
        wall_us(right_time).alias("_us"),
        F.lit(0).alias("_side"),
        F.col(tie).alias("_tie"),
        F.struct(*[c.alias(n) for n, c in parts.items()]).alias("_hit"),
    ).withColumn("_slice", F.explode(reach))
    seq = lefts.unionByName(rights, allowMissingColumns=True)
    over = f"OVER (PARTITION BY {', '.join(_q(k) for k in on)}, _slice ORDER BY _us, _side, _tie"
    near = seq.withColumn(
        "_b", F.expr(f"last(_hit) IGNORE NULLS {over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    ).withColumn("_a", F.expr(f"lead(_hit) IGNORE NULLS {over})")).where("_side = 1")
    b_ok = F.col("_us") - F.col("_b.us") <= before_s * 1_000_000
    a_ok = F.col("_a.us") - F.col("_us") <= after_s * 1_000_000
    return near.select(
        *[F.col(c) for c in left.columns],
        *[F.when(b_ok, F.col(f"_b.b_{n}")).alias(n) for n in before],
        *[F.when(a_ok, F.col(f"_a.a_{n}")).alias(n) for n in after],
    )
