"""Rule flags with evidence, parameter rules with scopes, confidence and narrative."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG_COLUMNS = ("rule", "entity_id", "ref_id", "event_time", "measure", "limit_value")


@dataclass(frozen=True)
class Rule:
    """A named condition, the record and time it points at, and the value held against a limit."""

    name: str
    when: Column
    ref: Column
    time: Column
    measure: Column | None = None
    limit: Column | float | None = None

    def hit(self) -> Column:
        bound = self.limit if isinstance(self.limit, Column) else F.lit(self.limit)
        row = F.struct(
            F.lit(self.name).alias("rule"),
            self.ref.cast("string").alias("ref_id"),
            self.time.cast("timestamp_ntz").alias("event_time"),
            (F.lit(None) if self.measure is None else self.measure).cast("double").alias("measure"),
            bound.cast("double").alias("limit_value"),
        )
        return F.when(self.when, row)


def fire(df: DataFrame, entity: str, rules: Sequence[Rule]) -> DataFrame:
    """One evidence row per rule that holds, in one shared shape. All rules of a table share one pass."""
    hits = F.explode(F.array_compact(F.array(*[r.hit() for r in rules])))
    return df.select(F.col(entity).cast("string").alias("entity_id"), hits.alias("_h")).select(
        "_h.rule", "entity_id", "_h.ref_id", "_h.event_time", "_h.measure", "_h.limit_value"
    )


def stack_flags(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def flag_abnormal(
    df: DataFrame, test: str, value: str, limits: Mapping[str, tuple[str, float, str]], out: str = "abnormal_flag"
) -> DataFrame:
    """``limits``: test -> (comparison, limit, flag). A handful of literals, so no join."""
    from tidewatch.operators.temporal import compare

    flag = F.when(F.col(value).isNull(), F.lit(None).cast("string"))
    for name, (op, limit, label) in limits.items():
        flag = flag.when((F.col(test) == name) & compare(F.col(value), op, limit), label)
    return df.withColumn(out, flag.otherwise("N"))


# Reference limits of the three kidney tests.
KIDNEY_LIMITS = {"eGFR": ("<", 60.0, "L"), "creatinine": (">", 1.3, "H"), "UACR": (">=", 30.0, "H")}


def confidence(criteria: Sequence[Column]) -> Column:
    """Share of the criteria that agree; a criterion without evidence (NULL) leaves the mean."""
    known = [F.when(c.isNotNull(), 1).otherwise(0) for c in criteria]
    agree = [F.when(c, 1).otherwise(0) for c in criteria]
    total = reduce(lambda a, b: a + b, known)
    return F.when(total > 0, reduce(lambda a, b: a + b, agree) / total)


def typed_rules(rules: DataFrame, flag_types: Sequence[str]) -> DataFrame:
    """Cast the text parameter: a number, or 1/0 for switch rules. A bad cast is marked, not zeroed."""
    is_flag = F.col("rule_type").isin(*flag_types)
    number = F.col("param_value").try_cast("double")
    switch = F.col("param_value").try_cast("boolean").cast("double")
    value = F.when(is_flag, switch).otherwise(number)
    return rules.withColumn("value", value).withColumn("bad_value", value.isNull())


STRICT_MAX = ("max_consecutive", "max_shifts_per_block")
FLAG_TYPES = ("no_night_then_day", "night_differential")


def _applicable(
    rules: DataFrame, entities: DataFrame, entity: str, scope: str, strict_max: Sequence[str], flag_types: Sequence[str]
) -> DataFrame:
    """Every usable rule an entity falls under, with its order of precedence as one struct.

    Each entity asks for its three scope keys (own id, group, ``all``), so this is one equi join; the
    rule table is small enough for Spark to broadcast by its measured size.
    """
    keys = F.array(
        F.struct(F.lit(1).alias("rank"), F.lit("entity").alias("scope_used"), F.col(entity).cast("string").alias("key")),
        F.struct(F.lit(2).alias("rank"), F.lit("group").alias("scope_used"), F.col(scope).alias("key")),
        F.struct(F.lit(3).alias("rank"), F.lit("all").alias("scope_used"), F.lit("all").alias("key")),
    )
    asked = entities.select(F.col(entity), F.explode(keys).alias("_s")).select(
        entity, F.col("_s.rank"), F.col("_s.scope_used"), F.col("_s.key").alias("applies_to")
    )
    usable = typed_rules(rules, flag_types).where(~F.col("bad_value")).select("rule_id", "rule_type", "value", "applies_to")
    strictness = F.when(F.col("rule_type").isin(*strict_max), F.col("value")).otherwise(-F.col("value"))
    order = F.struct("rank", strictness.alias("strictness"), "rule_id", "value", "scope_used")
    found = asked.join(usable, "applies_to").select(entity, "rule_type", order.alias("_r"))
    # Dealt before they are folded: few rows of a scan share an entity, so a fold there would hold nearly all of them.
    return found.repartition(entity)


def resolve_rules(
    rules: DataFrame,
    entities: DataFrame,
    entity: str,
    scope: str,
    strict_max: Sequence[str] = STRICT_MAX,
    flag_types: Sequence[str] = FLAG_TYPES,
) -> DataFrame:
    """The rule in force per entity and rule type: own id beats its scope group beats ``all``.

    Among rules of equal scope the strictest wins: the smallest value of a maximum, the largest of a
    minimum or switch.
    """
    found = _applicable(rules, entities, entity, scope, strict_max, flag_types)
    best = found.groupBy(entity, "rule_type").agg(F.min("_r").alias("_r"))
    return best.select(entity, "rule_type", "_r.rule_id", "_r.value", "_r.scope_used")


def rule_values(
    rules: DataFrame,
    entities: DataFrame,
    entity: str,
    scope: str,
    types: Sequence[str],
    strict_max: Sequence[str] = STRICT_MAX,
    flag_types: Sequence[str] = FLAG_TYPES,
) -> DataFrame:
    """The same rules as one row per entity with a column per listed type: one aggregate, no pivot."""
    found = _applicable(rules, entities, entity, scope, strict_max, flag_types)
    best = [F.min(F.when(F.col("rule_type") == t, F.col("_r")))["value"].alias(t) for t in types]
    return found.groupBy(entity).agg(*best)


def narrative(df: DataFrame, parts: Sequence[tuple[Column, Column]], out: str = "narrative") -> DataFrame:
    from tidewatch.functions.scalars import sentence

    return df.withColumn(out, sentence(parts))
