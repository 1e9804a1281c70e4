"""Shift scheduling: who can take a slot, what a schedule breaks, how good it is, and a draft.

All facts about a provider (limits in force, days off, preferences) are folded to one row per provider
first and travel with it; slots and assignments then meet providers in one equi join. Day-off lists
hold distinct days of the planning window, so their size is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import weekday_name
from tidewatch.operators import cohort, rules, temporal
from tidewatch.operators.ranges import explode_ranges
from tidewatch.operators.skew import dealt, shuffled
from tidewatch.session import ship_package
from tidewatch.sources.tables import staging

ID = "provider_id"
SLOT = ["site", "work_date", "shift_type", "unit"]
RULE_TYPES = (
    "max_consecutive", "min_rest_hours", "no_night_then_day", "night_differential", "max_shifts_per_block",
    "min_shifts_per_block",
)


@dataclass(frozen=True)
class Clock:
    """First hour and length of each shift (no table holds them)."""

    start: Mapping[str, int] = field(default_factory=lambda: {"day": 7, "night": 19, "swing": 12})
    hours: int = 12

    def starts_at(self, day: Column, shift: Column) -> Column:
        hour = F.lit(None).cast("int")
        for name, first in self.start.items():
            hour = F.when(shift == name, F.lit(first)).otherwise(hour)
        return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


@dataclass(frozen=True)
class Block:
    """Planning blocks of equal length, one after another; together they are the horizon."""

    start: str
    days: int = 28
    blocks: int = 1

    def last(self) -> Column:
        """The last day of the horizon."""
        return F.date_add(F.lit(self.start).cast("date"), self.days * self.blocks - 1)

    def number(self, day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit(self.start).cast("date")) / F.lit(self.days)).cast("int")


def required_credential(unit: Column) -> Column:
    return F.when(unit.isin("icu", "cardiology"), unit).otherwise("general")


def with_requirement(coverage: DataFrame) -> DataFrame:
    if "required_credential" in coverage.columns:
        return coverage
    return coverage.withColumn("required_credential", required_credential(F.col("unit")))


def days_off(pto: DataFrame, status: str, block: Block, out: str) -> DataFrame:
    """Distinct days off per provider as one array, cut to the horizon."""
    first = F.lit(block.start).cast("date")
    cut = pto.where(F.col("status") == status).select(
        ID, F.greatest("start_date", first).alias("s"), F.least(F.coalesce("end_date", block.last()), block.last()).alias("e")
    )
    days = explode_ranges(cut, "s", "e").select(ID, "day").distinct()
    return days.groupBy(ID).agg(F.sort_array(F.collect_list("day")).alias(out))


def provider_facts(
    providers: DataFrame, rule_table: DataFrame, pto: DataFrame, prefs: DataFrame | None, block: Block
) -> DataFrame:
    """One row per provider: limits in force, days off, weights by shift and weekday."""
    n_providers = providers.count()
    limits = rules.rule_values(rule_table, providers, ID, "service_line", RULE_TYPES)
    limits = limits.withColumnRenamed("min_rest_hours", "rule_min_rest")
    p = shuffled(providers).join(limits, ID, "left")
    p = p.join(days_off(pto, "approved", block, "off_days"), ID, "left")
    p = p.join(days_off(pto, "requested", block, "wished_days"), ID, "left")
    none = F.array().cast("array<date>")
    p = p.withColumn("off_days", F.coalesce("off_days", none)).withColumn("wished_days", F.coalesce("wished_days", none))
    if prefs is not None:
        cells = F.collect_list(F.struct(F.concat_ws("|", "shift_type", "weekday"), "preference_weight"))
        # Dealt by provider before they are folded: hardly two cells of a scan fold into one.
        one = dealt(prefs, [ID], n_providers, 20_000).groupBy(ID, "shift_type", "weekday").agg(
            F.max("preference_weight").alias("preference_weight"),
            F.max("wants_consecutive").alias("wants_consecutive"),
            F.min("max_shifts_per_block").alias("max_shifts_per_block"),
        )
        w = one.groupBy(ID).agg(
            F.map_from_entries(cells).alias("weights"),
            F.max("wants_consecutive").alias("wants_consecutive"),
            F.min("max_shifts_per_block").alias("own_max_shifts"),
        )  # at most one cell per shift and weekday
        p = p.join(w, ID, "left")
    else:
        p = (
            p.withColumn("weights", F.lit(None).cast("map<string,int>"))
            .withColumn("wants_consecutive", F.lit(None).cast("boolean"))
            .withColumn("own_max_shifts", F.lit(None).cast("int"))
        )
    block_max = F.col("max_shifts_per_block") * F.col("fte")
    return (
        p.withColumn("max_run", F.least("max_consecutive", "max_consecutive_shifts").cast("int"))
        .withColumn("rest_hours", F.greatest("min_rest_hours", "rule_min_rest"))
        .withColumn("block_max", F.least(block_max, F.col("own_max_shifts")))
        .withColumn("block_min", F.col("min_shifts_per_block") * F.col("fte"))
        .withColumn("needs_optin", F.coalesce(F.col("night_differential") == 1, F.lit(False)))
        .withColumn("night_day_rule", F.coalesce(F.col("no_night_then_day") == 1, F.lit(False)))
    )


def weight_of(weights: Column, shift: Column, day: Column) -> Column:
    return F.coalesce(F.try_element_at(weights, F.concat_ws("|", shift, weekday_name(day))), F.lit(0))


def eligible(coverage: DataFrame, facts: DataFrame, on: Sequence[str] = ("site", "required_credential")) -> DataFrame:
    """Slot x provider of the same site with the credential, not on approved leave, opted in for nights.

    The credential list is exploded, so this is an equi join on (site, credential), never a containment
    test against every provider. ``on``: other columns that both have to agree in.
    """
    able = shuffled(facts).withColumn("required_credential", F.explode("credentials"))
    j = with_requirement(coverage).join(able, [*on])
    night_ok = (F.col("shift_type") != "night") | ~F.col("needs_optin") | F.col("wants_night_differential")
    return j.where(~F.array_contains("off_days", F.col("work_date")) & night_ok)


def scored_candidates(
    coverage: DataFrame, facts: DataFrame, wish_penalty: float = 3.0, keep: Sequence[str] = (), on: Sequence[str] = ("site", "required_credential")
) -> DataFrame:
    """Preference weight, slightly lifted by seniority, less a penalty on a day asked off."""
    lift = F.lit(1.0) + F.lit(0.01) * F.col("seniority_years")
    # The name of the cell is made per slot, before the join, not per pair.
    cell = F.concat_ws("|", F.col("shift_type"), weekday_name(F.col("work_date")))
    weight = F.coalesce(F.try_element_at(F.col("weights"), F.col("_cell")), F.lit(0))
    wished = F.array_contains("wished_days", F.col("work_date"))
    e = eligible(coverage.withColumn("_cell", cell), facts, on)
    return e.select(
        *SLOT, "required_headcount", ID, *keep,
        weight.alias("preference_weight"),
        wished.alias("asked_off"),
        (weight * lift - F.when(wished, F.lit(wish_penalty)).otherwise(F.lit(0.0))).alias("score"),
    )


def top_candidates(candidates: DataFrame) -> DataFrame:
    """As many candidates per slot as it needs heads."""
    w = W.partitionBy(*SLOT).orderBy(F.col("score").desc(), F.col(ID))
    ranked = candidates.withColumn("candidate_rank", F.row_number().over(w))
    return ranked.where(F.col("candidate_rank") <= F.col("required_headcount"))


# --- audit -------------------------------------------------------------------------


def by_provider(assignments: DataFrame) -> DataFrame:
    """Assignments dealt by provider, which is how nearly every rule reads them."""
    return dealt(assignments, [ID], assignments.count(), 100_000)


def coverage_fill(coverage: DataFrame, assignments: DataFrame) -> DataFrame:
    filled = assignments.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("assigned"))
    j = with_requirement(coverage).join(filled, SLOT, "left")
    return j.withColumn("assigned", F.coalesce("assigned", F.lit(0))).withColumn(
        "shortfall", F.greatest(F.col("required_headcount") - F.col("assigned"), F.lit(0))
    )


def tightness(coverage: DataFrame, providers: DataFrame, full_time_shifts: float = 20.0) -> DataFrame:
    """Required slots against the shifts the providers of the site can work."""
    need = coverage.groupBy("site").agg(F.sum("required_headcount").alias("demand"))
    have = providers.groupBy("site").agg((F.sum("fte") * F.lit(full_time_shifts)).alias("capacity"))
    return need.join(have, "site", "full").withColumn("tightness", F.try_divide(F.col("demand"), F.col("capacity")))


def enriched_assignments(assignments: DataFrame, facts: DataFrame, clock: Clock = Clock()) -> DataFrame:
    """Each assignment with its clock times, the provider's previous shift, and the provider's facts."""
    timed = assignments.withColumn("start_ts", clock.starts_at(F.col("work_date"), F.col("shift_type"))).withColumn(
        "end_ts", F.col("start_ts") + F.make_dt_interval(hours=F.lit(clock.hours))
    )
    chained = temporal.previous_gap(
        timed, [ID], "start_ts", "end_ts", ["assignment_id"], {"shift_type": "prev_shift", "work_date": "prev_date"},
        slice_s=28 * temporal.DAY_S,  # a provider has about one shift a day
    )
    own = shuffled(facts).select(
        ID, "credentials", "off_days", "rest_hours", "needs_optin", "night_day_rule", "wants_night_differential"
    )
    return chained.join(own, ID, "left")


def assignment_rules() -> list[rules.Rule]:
    ref, at = F.col("assignment_id"), F.col("work_date")
    need = required_credential(F.col("unit"))
    return [
        rules.Rule("credential_missing", ~F.coalesce(F.array_contains("credentials", need), F.lit(False)), ref, at),
        rules.Rule(
            "min_rest", F.col("gap_hours") < F.col("rest_hours"), ref, at, F.col("gap_hours"), F.col("rest_hours")
        ),
        rules.Rule(
            "night_then_day",
            F.col("night_day_rule") & (F.col("shift_type") == "day") & (F.col("prev_shift") == "night")
            & (F.datediff("work_date", "prev_date") == 1),
            ref, at,
        ),
        rules.Rule(
            "night_without_optin",
            F.col("needs_optin") & (F.col("shift_type") == "night") & ~F.col("wants_night_differential"),
            ref, at,
        ),
        rules.Rule("on_approved_leave", F.array_contains("off_days", F.col("work_date")), ref, at),
    ]


def run_violations(assignments: DataFrame, facts: DataFrame) -> DataFrame:
    """Runs of worked days above the provider's limit."""
    runs = temporal.consecutive_runs(assignments, [ID], "work_date").join(shuffled(facts).select(ID, "max_run"), ID)
    return rules.fire(
        runs, ID,
        [rules.Rule("max_consecutive", F.col("run_days") > F.col("max_run"), F.col("run_start"), F.col("run_start"),
                    F.col("run_days"), F.col("max_run"))],
    )


def block_violations(assignments: DataFrame, facts: DataFrame, block: Block) -> DataFrame:
    """Shifts per block above or below the provider's limits; in every block of the horizon, worked or not."""
    counts = assignments.groupBy(ID, block.number(F.col("work_date")).alias("block")).agg(F.count(F.lit(1)).alias("n"))
    every = facts.select(ID, F.explode(F.sequence(F.lit(0), F.lit(block.blocks - 1))).alias("block"))
    grid = every.join(counts, [ID, "block"], "full").withColumn("n", F.coalesce("n", F.lit(0)))
    per = shuffled(facts).select(ID, "block_max", "block_min").join(grid, ID)
    ref = F.col("block")
    when = F.date_add(F.lit(block.start).cast("date"), ref * F.lit(block.days))
    return rules.fire(
        per, ID,
        [
            rules.Rule("above_block_max", F.col("n") > F.col("block_max"), ref, when, F.col("n"), F.col("block_max")),
            rules.Rule("below_block_min", F.col("n") < F.col("block_min"), ref, when, F.col("n"), F.col("block_min")),
        ],
    )


def double_bookings(assignments: DataFrame) -> DataFrame:
    per_day = assignments.groupBy(ID, "work_date").agg(F.count(F.lit(1)).alias("n"))
    return rules.fire(
        per_day, ID, [rules.Rule("two_shifts_one_date", F.col("n") > 1, F.col("work_date"), F.col("work_date"), F.col("n"), 1.0)]
    )


def coverage_violations(coverage: DataFrame, assignments: DataFrame) -> DataFrame:
    fill = coverage_fill(coverage, assignments).withColumn("_slot", F.concat_ws("|", "site", "shift_type", "unit"))
    return rules.fire(
        fill, "_slot",
        [rules.Rule("coverage_shortfall", F.col("shortfall") > 0, F.col("work_date"), F.col("work_date"),
                    F.col("assigned"), F.col("required_headcount"))],
    )


def audit(
    assignments: DataFrame, facts: DataFrame, coverage: DataFrame, block: Block, clock: Clock = Clock()
) -> DataFrame:
    """Every violation of every rule, one evidence row each."""
    return rules.stack_flags(
        rules.fire(enriched_assignments(assignments, facts, clock), ID, assignment_rules()),
        run_violations(assignments, facts),
        block_violations(assignments, facts, block),
        double_bookings(assignments),
        coverage_violations(coverage, assignments),
    )


# --- soft score ------------------------------------------------------------------------


def soft_score(assignments: DataFrame, facts: DataFrame) -> DataFrame:
    """Per site: preference points, share of liked shifts, days asked off, isolated single shifts, equity."""
    own = shuffled(facts).select(ID, "weights", "wished_days", "fte")
    j = assignments.join(own, ID)
    weight = weight_of(F.col("weights"), F.col("shift_type"), F.col("work_date"))
    base = j.withColumn("_w", weight).groupBy("site").agg(
        F.count(F.lit(1)).alias("n_shifts"),
        F.sum("_w").alias("preference_points"),
        F.avg(F.when(F.col("_w") > 0, 1).otherwise(0)).alias("liked_share"),
        F.count_if(F.array_contains("wished_days", F.col("work_date"))).alias("asked_off_worked"),
    )
    weekend = F.dayofweek("work_date").isin(1, 7)
    spread = cohort.equity_spread(
        j, ["site"], ID, {"nights": F.col("shift_type") == "night", "weekends": weekend}, "fte"
    ).select("site", "nights_sd", "nights_range", "weekends_sd", "weekends_range")
    runs = temporal.consecutive_runs(assignments, ["site", ID], "work_date").join(
        shuffled(facts).select(ID, "wants_consecutive"), ID
    )
    single = runs.groupBy("site").agg(
        F.count_if((F.col("run_days") == 1) & F.col("wants_consecutive")).alias("isolated_shifts")
    )
    return base.join(spread, "site", "left").join(single, "site", "left")


def equity(assignments: DataFrame, providers: DataFrame, by: list[str]) -> DataFrame:
    weekend = F.dayofweek("work_date").isin(1, 7)
    j = assignments.join(shuffled(providers).select(ID, "fte"), ID)
    return cohort.equity_spread(j, by, ID, {"nights": F.col("shift_type") == "night", "weekends": weekend}, "fte")


# --- draft ------------------------------------------------------------------------------


def draft_schema(coverage: DataFrame, facts: DataFrame) -> str:
    """Ids keep the types of their tables."""
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    return (
        f"run_id string, site {kind(coverage, 'site')}, provider_id {kind(facts, ID)}, work_date date, shift_type string, unit string, "
        "seat int, why_factors struct<preference_weight:int,equity_load:int,alternatives:int>"
    )


#: What a provider's choice looks at, besides the shift itself.
LIMITS = ("rest_hours", "night_day_rule", "max_run", "block_max")


def slots_of(coverage: DataFrame) -> DataFrame:
    """Doubled slots are one, with the larger headcount."""
    return (
        with_requirement(coverage)
        .groupBy(*SLOT, "required_credential")
        .agg(F.max("required_headcount").alias("required_headcount"))
        .where("required_headcount > 0")
    )


def _with_limits(facts: DataFrame) -> DataFrame:
    """The limits come along from the providers: looked up by pair they would cost a shuffle of all pairs."""
    own = {c: F.col(c).cast("double") if c != "night_day_rule" else F.col(c) for c in LIMITS}
    return facts.join(shuffled(facts).select(ID, *[v.alias(f"_{c}") for c, v in own.items()]), ID)


def _bids(
    slots: DataFrame, limited: DataFrame, block: Block, clock: Clock, keep: Sequence[str] = (), on: Sequence[str] = ("site", "required_credential")
) -> DataFrame:
    """``bids`` of slots that are one row each and providers with their limits; what depends on the slot alone is made per slot."""
    day = F.datediff("work_date", F.lit("1970-01-01").cast("date"))
    hour = F.hour(clock.starts_at(F.col("work_date"), F.col("shift_type")))
    timed = slots.withColumns({"day": day, "begin": day * 24 + hour, "block": block.number(F.col("work_date"))}).where("begin IS NOT NULL")
    pairs = scored_candidates(timed, limited, keep=[*[f"_{c}" for c in LIMITS], "day", "begin", "block", *keep], on=on)
    return pairs.select(
        *SLOT, "required_headcount", ID, *[F.col(f"_{c}").alias(c) for c in LIMITS], "preference_weight",
        F.struct(F.col("score"), F.xxhash64(*SLOT, ID).alias("tie"), F.col(ID).alias("who")).alias("bid"),
        "day", "begin", "block", *keep,
    )


def bids(coverage: DataFrame, facts: DataFrame, block: Block, clock: Clock = Clock()) -> DataFrame:
    """Every pair of slot and eligible provider with its bid; no two bids are equal.

    The bid is the candidate score; equal scores are ordered by a hash of slot and provider, so that no provider wins all
    of them, and at last by the provider's id. Doubled slots are one, with the larger headcount.
    """
    return _bids(slots_of(coverage), _with_limits(facts), block, clock)


class Duties:
    """The shifts that one provider has taken, and whether one more fits the hard limits."""

    def __init__(self, rest: float | None, night_day: bool, max_run: float | None, cap: float | None, hours: int):
        self.rest, self.night_day, self.max_run, self.cap, self.hours = rest, night_day, max_run, cap, hours
        #: Shifts more days apart than this have their rest, as each begins within its day.
        self.reach = None if rest is None or not rest < 10_000 else max(0, int((rest + hours) // 24)) + 1
        self.on: dict[int, tuple[int, str]] = {}
        self.in_block: dict[int, int] = {}

    def take(self, day: int, block: int, begin: int, shift: str) -> bool:
        if day in self.on or (self.cap is not None and self.in_block.get(block, 0) + 1 > self.cap):
            return False
        if self.rest is not None and self.on:
            if self.reach is None or 2 * self.reach > len(self.on):
                near = self.on.values()
            else:
                near = [self.on[d] for d in range(day - self.reach, day + self.reach + 1) if d in self.on]
            for b, _ in near:
                if abs(b - begin) - self.hours < self.rest:
                    return False
        if self.night_day and (
            (shift == "day" and self.on.get(day - 1, (0, ""))[1] == "night")
            or (shift == "night" and self.on.get(day + 1, (0, ""))[1] == "day")
        ):
            return False
        if self.max_run is not None:
            first = last = day
            while first - 1 in self.on:
                first -= 1
            while last + 1 in self.on:
                last += 1
            if last - first + 1 > self.max_run:
                return False
        self.on[day] = (begin, shift)
        self.in_block[block] = self.in_block.get(block, 0) + 1
        return True


def _claims(open_pairs: DataFrame, clock: Clock) -> DataFrame:
    """Which of the open pairs their providers claim: best bid first, as far as the hard limits allow.

    A provider has at most one pair for each slot of its site, so the calendar bounds the group.
    """
    hours = clock.hours

    def run(batches):
        who, duties = object(), None
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
            limits = [column(c) for c in LIMITS]
            rows = zip(*[column(c).to_pylist() for c in (ID, "day", "block", "begin", "shift_type")], strict=True)
            keep = []
            for i, (provider, day, own_block, begin, shift) in enumerate(rows):
                if provider != who:
                    who, duties = provider, Duties(*[c[i].as_py() for c in limits], hours)
                if duties.take(day, own_block, begin, shift):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int32()))

    dealt = open_pairs.repartition(ID).sortWithinPartitions(F.col(ID), F.col("bid").desc())
    return dealt.mapInArrow(run, open_pairs.schema)


#: Rows of a round's prices that are left to Spark's choice of join; more of them are shuffled. Their files are small for what they
#: hold in memory, and a broadcast of each round would stay in the driver.
FEW_PRICES = 50_000


def auction(pairs: DataFrame, stage: Callable[[DataFrame, str], DataFrame], clock: Clock = Clock()) -> tuple[DataFrame, int]:
    """The claims that stand at the end, and the number of rounds.

    A round: every provider claims its best open pairs within the hard limits; every slot keeps its best claims, as many
    as it needs heads, and posts the least of them as its price; pairs with a bid below the price are closed in the next
    round. What becomes of a pair depends on pairs with higher bids alone, so from the best bid down everything settles:
    the rounds end, at the same claims whatever the partitioning, and no pair is left out that slot and provider would
    both rather have. Sites whose claims stay the same are done and leave the next round.
    """
    by_slot = W.partitionBy(*SLOT).orderBy(F.col("bid").desc())
    kept = ["site", "work_date", "shift_type", "unit", "price"]
    claims = stage(_claims(pairs, clock), "claims-0")
    done, prices, n = [], None, 0
    mark = lambda c, sign: c.select("site", F.lit(sign).alias("n"), F.xxhash64(*SLOT, ID).alias("h"))
    while True:
        n += 1
        ranked = claims.withColumn("_place", F.row_number().over(by_slot))
        prices = ranked.where(F.col("_place") == F.col("required_headcount")).withColumnRenamed("bid", "price").select(*kept)
        if claims.count() > FEW_PRICES:  # no more prices than claims
            prices = shuffled(prices)
        open_pairs = pairs.join(prices, SLOT, "left").where("price IS NULL OR bid >= price").drop("price")
        after = stage(_claims(open_pairs, clock), f"claims-{n}")
        # Equal claims cancel out; a site whose claims all do is at its fixed point.
        both = mark(claims, 1).union(mark(after, -1)).groupBy("site").agg(F.sum("n").alias("n"), F.bit_xor("h").alias("h"))
        moved = stage(both.where("n <> 0 OR h <> 0").select("site"), f"moved-{n}")
        if moved.isEmpty():
            done.append(after)
            break
        done.append(after.join(moved, "site", "left_anti"))
        claims = after.join(moved, "site", "left_semi")
        pairs = pairs.join(moved, "site", "left_semi")
        if n % 8 == 0:
            pairs = stage(pairs, f"pairs-{n}")
    return reduce(DataFrame.unionByName, done), n


#: A site with at most this many pairs, and at most this part of all pairs, is settled by one task; the others by rounds.
SITE_PAIRS = 200_000
SITE_PART = 16


def sites_by_rounds(slots: DataFrame, facts: DataFrame, stage: Callable[[DataFrame, str], DataFrame], given: bool) -> tuple[DataFrame | None, int]:
    """(sites that the auction settles by rounds over all tasks, or None; number of pairs at most).

    Large sites, by slots times able providers, so that no task has more than its share. Also sites that do not stand
    alone or whose slots have no single headcount: with a provider whose rows differ in site or limits, a slot without a
    unit, or (``given`` credentials) one slot under two credentials.
    """
    need = slots.groupBy("site", "required_credential").agg(F.count(F.lit(1)).alias("n"))
    able = facts.select("site", F.explode("credentials").alias("required_credential"))
    able = able.groupBy("site", "required_credential").agg(F.count(F.lit(1)).alias("m"))
    sizes = stage(need.join(able, ["site", "required_credential"]).groupBy("site").agg(F.sum(F.col("n") * F.col("m")).alias("n")), "sites")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    person = F.struct("site", *LIMITS)
    several = facts.where(F.col(ID).isNotNull()).groupBy(ID).agg(F.min(person).alias("a"), F.max(person).alias("b"), F.collect_set("site").alias("of")).where("NOT a <=> b")
    marked = [
        sizes.where(F.col("n") > min(SITE_PAIRS, total // SITE_PART)).select("site"),
        several.select(F.explode("of").alias("site")),
        slots.where("unit IS NULL").select("site"),
    ]
    if given:
        marked.append(slots.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("site"))
    found = stage(reduce(DataFrame.union, marked).distinct(), "sites-by-rounds")
    return (None if found.isEmpty() else found), total


def _falling(site: np.ndarray, score: pa.Array, tie: pa.Array, who: pa.Array) -> np.ndarray:
    """Rows by site, then from the best bid down, as Spark orders them: no number above all numbers, null below."""
    s, t = score.to_numpy(zero_copy_only=False), tie.to_numpy()
    null = np.asarray(pc.is_null(score))
    kind = np.where(null, 2, np.where(np.isnan(s), 0, 1))
    s = np.where(kind == 1, s, 0.0)
    order = np.lexsort((~t, -s, kind, site))
    site, kind, s, t = site[order], kind[order], s[order], t[order]
    equal = (site[1:] == site[:-1]) & (kind[1:] == kind[:-1]) & (s[1:] == s[:-1]) & (t[1:] == t[:-1])
    if equal.any():
        begins = np.flatnonzero(np.concatenate(([True], ~equal)))
        for lo, hi in zip(begins, [*begins[1:], len(order)], strict=True):
            if hi - lo > 1:
                order[lo:hi] = sorted(order[lo:hi].tolist(), key=lambda i: who[i].as_py(), reverse=True)
    return order


def _settle_sites(rows: pa.RecordBatch, hours: int) -> pa.RecordBatch:
    """The claims of whole sites: bids in falling order, each taken where its slot and provider still can."""
    column = lambda c: rows.column(rows.schema.get_field_index(c))
    code = lambda c: column(c).dictionary_encode()
    sites, people, shifts, units = code("site"), code(ID), code("shift_type"), code("unit")
    at = sites.indices.to_numpy()
    day = column("work_date").cast(pa.int32()).to_numpy()
    slot = ((at.astype(np.int64) * (int(day.max()) - int(day.min()) + 1) + day - int(day.min())) * len(shifts.dictionary) + shifts.indices.to_numpy())
    _, first, slot = np.unique(slot * len(units.dictionary) + units.indices.to_numpy(), return_index=True, return_inverse=True)
    left = column("required_headcount").to_numpy()[first].tolist()
    others = np.bincount(slot) - 1
    order = _falling(at, column("score"), column("tie"), column(ID))
    duties: list[Duties | None] = [None] * len(people.dictionary)
    names = shifts.dictionary.to_pylist()
    limits = [column(c) for c in LIMITS]
    walk = (slot, people.indices.to_numpy(), day, column("block").to_numpy(), column("begin").to_numpy(), shifts.indices.to_numpy())
    keep = []
    for i, s, p, on, own_block, begin, shift in zip(order.tolist(), *[x[order].tolist() for x in walk], strict=True):
        if not left[s]:
            continue
        mine = duties[p]
        if mine is None:
            mine = duties[p] = Duties(*[c[i].as_py() for c in limits], hours)
        if mine.take(on, own_block, begin, names[shift]):
            left[s] -= 1
            keep.append(i)
    kept = rows.take(pa.array(keep, pa.int64()))
    return pa.RecordBatch.from_arrays([*kept.columns, pa.array(others[slot[keep]], pa.int32())], [*rows.schema.names, "alternatives"])


def settled(pairs: DataFrame, n_pairs: int, clock: Clock = Clock()) -> DataFrame:
    """The claims of sites that a task can hold, each site as a whole, and how many others each slot could have had.

    From the best bid down nothing is taken back, so one pass over a site ends where the rounds of ``auction`` end.
    """
    hours = clock.hours

    def run(batches):
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            site = batch.column(0)
            new = np.flatnonzero(np.asarray(pc.not_equal(site.slice(1), site.slice(0, len(site) - 1)))) + 1
            cut = int(new[-1]) if len(new) else 0
            if held and (cut or site[0].as_py() != last):
                yield _settle_sites(pa.concat_batches([*held, batch.slice(0, cut)]), hours)
                held = []
            elif cut:
                yield _settle_sites(batch.slice(0, cut), hours)
            held.append(batch.slice(cut))
            last = site[len(site) - 1].as_py()
        if held:
            yield _settle_sites(pa.concat_batches(held), hours)

    flat = pairs.select(*SLOT, "required_headcount", ID, *LIMITS, "preference_weight", "bid.score", "bid.tie", "begin", "block")
    out = T.StructType([*flat.schema.fields, T.StructField("alternatives", T.IntegerType())])
    claims = dealt(flat, ["site"], n_pairs, 250_000).sortWithinPartitions("site").mapInArrow(run, out)
    return claims.withColumn("bid", F.struct("score", "tie", F.col(ID).alias("who"))).drop("score", "tie")


def draft(
    coverage: DataFrame, facts: DataFrame, block: Block, run_id: str, clock: Clock = Clock(), stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """A first draft for a person to approve, by an auction over all sites at once; ``with_hard_ok`` adds what the audit says.

    Sites that a task can hold are settled as a whole, so that their pairs are shuffled once; a large site is never one
    group: its pairs are dealt by provider and by slot, round after round. Slots and providers that cannot meet leave seats
    open; empty tables give an empty draft.
    """
    ship_package(coverage.sparkSession)
    stage = stage or staging(coverage.sparkSession, "auction")
    slots = stage(slots_of(coverage), "slots")
    limited = _with_limits(facts)
    by_rounds, n_pairs = sites_by_rounds(slots, facts, stage, "required_credential" in coverage.columns)
    alone = slots if by_rounds is None else slots.join(by_rounds, "site", "left_anti")
    wanted = [*SLOT, ID, "bid", "preference_weight", "block", "alternatives"]
    out = stage(settled(_bids(alone, limited, block, clock), n_pairs, clock).select(*wanted), "settled")
    if by_rounds is not None:
        pairs = stage(_bids(slots.join(by_rounds, "site", "left_semi"), limited, block, clock), "pairs")
        claims, _ = auction(pairs, stage, clock)
        options = pairs.groupBy(*SLOT).agg((F.count(F.lit(1)) - 1).cast("int").alias("alternatives"))
        out = out.unionByName(claims.join(options, SLOT).select(*wanted))
    seat = F.row_number().over(W.partitionBy(*SLOT).orderBy(F.col("bid").desc()))
    hard = (F.col("shift_type") == "night") | F.dayofweek("work_date").isin(1, 7)
    before = W.partitionBy(ID, "block").orderBy(F.col("bid").desc()).rowsBetween(W.unboundedPreceding, -1)
    load = F.coalesce(F.sum(hard.cast("int")).over(before), F.lit(0)).cast("int")
    out = out.withColumn("seat", seat).withColumn("equity_load", load)
    why = F.struct(F.col("preference_weight").cast("int").alias("preference_weight"), "equity_load", "alternatives")
    made = out.select(F.lit(run_id).alias("run_id"), "site", ID, "work_date", "shift_type", "unit", "seat", why.alias("why_factors"))
    # Stored: the rounds above should not run again for every reader.
    return stage(made.to(T.StructType.fromDDL(draft_schema(coverage, facts))), f"draft-{run_id}")


def blocking_pairs(
    drafted: DataFrame, coverage: DataFrame, facts: DataFrame, block: Block, clock: Clock = Clock(),
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Pairs left out of a draft although their slot has room for them and their provider could work them.

    Room and limits are looked at as if only shifts with higher bids stood, since both sides would give up the lower ones.
    A draft of ``draft`` has none. It is worked out by joins, not by the auction. The pairs in the draft are stored with their
    bids, and slots and providers bring theirs along, so that all pairs are made once and never shuffled.
    """
    stage = stage or staging(coverage.sparkSession, "blocking")
    key = [*SLOT, ID]
    slots, limited = slots_of(coverage), _with_limits(facts)
    taken = slots.join(shuffled(drafted).select(*key), SLOT)
    held = stage(_bids(taken, limited, block, clock, on=["site", "required_credential", ID]), "pairs")
    higher = held.groupBy(*SLOT).agg(F.sort_array(F.collect_list("bid"), asc=False).alias("slot_bids"))  # at most the headcount
    duties = F.sort_array(F.collect_list(F.struct("day", "bid", "begin", "block", "shift_type")))  # one a day
    theirs = held.groupBy(ID).agg(duties.alias("duties"))
    own = limited.join(shuffled(theirs), ID, "left")
    pairs = _bids(slots.join(shuffled(higher), SLOT, "left"), own, block, clock, keep=["slot_bids", "duties"])
    # Room: of the slot's bids, fewer than it needs heads are higher.
    least = F.try_element_at("slot_bids", F.col("required_headcount").cast("int"))
    room = least.isNull() | (least <= F.col("bid"))
    apart = F.coalesce(~F.exists("slot_bids", lambda b: b["who"] == F.col(ID)), F.lit(True))
    theirs_or_none = F.coalesce("duties", F.array().cast(theirs.schema["duties"].dataType))
    busy = F.exists(theirs_or_none, lambda d: (d["day"] == F.col("day")) & (d["bid"] > F.col("bid")))
    above = F.filter(theirs_or_none, lambda d: d["bid"] > F.col("bid"))
    gap = lambda d: F.abs(d["begin"] - F.col("begin")) - clock.hours

    def fits(above: Column) -> Column:
        days = F.transform(above, lambda d: d["day"])  # in rising order
        last = F.aggregate(days, F.col("day"), lambda end, d: F.when(d == end + 1, d).otherwise(end))
        first = F.aggregate(F.reverse(days), F.col("day"), lambda end, d: F.when(d == end - 1, d).otherwise(end))
        clash = F.exists(above, lambda d: F.coalesce(gap(d) < F.col("rest_hours"), F.lit(False)))
        turned = F.exists(
            above,
            lambda d: ((F.col("shift_type") == "day") & (d["shift_type"] == "night") & (d["day"] == F.col("day") - 1))
            | ((F.col("shift_type") == "night") & (d["shift_type"] == "day") & (d["day"] == F.col("day") + 1)),
        )
        count = F.size(F.filter(above, lambda d: d["block"] == F.col("block"))) + 1
        full = F.coalesce(count > F.col("block_max"), F.lit(False)) | F.coalesce(last - first + 1 > F.col("max_run"), F.lit(False))
        return ~clash & ~(F.col("night_day_rule") & turned) & ~full

    # An array of one, so that the duties above a bid are picked once for all conditions; a filter would put them into each.
    return pairs.where(room & apart & ~busy).where(F.exists(F.array(above), fits)).select(*key)


#: Rules that a draft may leave open: an empty seat, too few shifts.
OPEN_RULES = ("coverage_shortfall", "below_block_min")


def with_hard_ok(drafted: DataFrame, audited: DataFrame) -> DataFrame:
    """Add ``is_hard_ok``: the audit has no hard finding for the shift itself nor for its provider as a whole."""
    hard = audited.where(~F.col("rule").isin(*OPEN_RULES))
    own = ["credential_missing", "min_rest", "night_then_day", "night_without_optin", "on_approved_leave"]
    shifts = hard.where(F.col("rule").isin(*own)).select(F.col("ref_id").alias("_shift")).distinct()
    persons = hard.where(~F.col("rule").isin(*own)).select(F.col("entity_id").alias("_person")).distinct()
    shift = F.concat_ws("|", ID, "work_date", "shift_type", "unit", "seat")
    return (
        drafted.withColumn("_s", shift)
        .withColumn("_p", F.col(ID).cast("string"))
        .join(shifts, F.col("_s") == F.col("_shift"), "left")
        .join(persons, F.col("_p") == F.col("_person"), "left")
        .withColumn("is_hard_ok", F.col("_shift").isNull() & F.col("_person").isNull())
        .drop("_s", "_p", "_shift", "_person")
    )


def draft_as_assignments(drafted: DataFrame) -> DataFrame:
    key = F.concat_ws("|", ID, "work_date", "shift_type", "unit", "seat")
    return drafted.select(key.alias("assignment_id"), ID, "site", "work_date", "shift_type", "unit")


def run_record(drafted: DataFrame, audited: DataFrame, soft: DataFrame, run_id: str, params: dict[str, str]) -> DataFrame:
    """One row per run: status, objective, open seats by rule, parameters."""
    slack = audited.groupBy("rule").agg(F.count(F.lit(1)).cast("string").alias("n")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "n")))).alias("constraint_slack")
    )
    points = soft.agg(F.coalesce(F.sum("preference_points"), F.lit(0)).cast("double").alias("objective_value"))
    filled = drafted.agg(F.count(F.lit(1)).alias("n_assigned"))
    one = lambda df: df.withColumn("_j", F.lit(1))
    pairs = [F.lit(x) for kv in params.items() for x in kv]
    short = F.try_element_at("constraint_slack", F.lit("coverage_shortfall"))
    status = F.when(short.isNull(), "feasible").otherwise("partial")
    return one(slack).join(one(points), "_j").join(one(filled), "_j").select(
        F.lit(run_id).alias("run_id"), status.alias("status"), "objective_value", "n_assigned", "constraint_slack",
        F.create_map(*pairs).alias("params"),
    )


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Assignments only in one of two drafts."""
    key = [ID, *SLOT]
    a = before.select(*key).distinct().withColumn("_a", F.lit(True))
    b = after.select(*key).distinct().withColumn("_b", F.lit(True))
    return (
        a.join(b, key, "full")
        .where(F.col("_a").isNull() | F.col("_b").isNull())
        .withColumn("change", F.when(F.col("_a").isNull(), "added").otherwise("removed"))
        .drop("_a", "_b")
    )


def compare_soft(history: DataFrame, drafted: DataFrame, facts: DataFrame) -> DataFrame:
    h = soft_score(history, facts).withColumn("schedule", F.lit("history"))
    d = soft_score(drafted, facts).withColumn("schedule", F.lit("draft"))
    return h.unionByName(d)


def why_text(drafted: DataFrame) -> DataFrame:
    """Why a provider has the shifts they have, from the recorded factors."""
    w = F.col("why_factors")
    g = drafted.groupBy(ID).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("shift_type") == "night").alias("n_nights"),
        F.count_if(w["preference_weight"] > 0).alias("n_liked"),
        F.count_if(w["alternatives"] == 0).alias("n_only"),
    )
    text = F.concat_ws(
        "; ",
        F.concat(F.col("n").cast("string"), F.lit(" shifts assigned")),
        F.when(F.col("n_nights") > 0, F.concat(F.col("n_nights").cast("string"), F.lit(" of them nights"))),
        F.when(F.col("n_liked") > 0, F.concat(F.col("n_liked").cast("string"), F.lit(" match a stated preference"))),
        F.when(F.col("n_only") > 0, F.concat(F.lit("for "), F.col("n_only").cast("string"), F.lit(" no one else was eligible"))),
    )
    return g.select(ID, text.alias("why"))
