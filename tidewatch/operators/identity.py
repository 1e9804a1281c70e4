"""Match people across two systems without a shared key.

Names are compared as distinct (department, first, last) values, never row against row, so any number
of copies of one name is one value. A tier links a value only where it stands for one person on each
side; the rest stays visible as a tie. Tiers, each on what the earlier ones left:

    EXACT_ID    the ids are equal
    EXACT_NAME  same department and folded name
    FUZZY similar    scored names: one edit apart or half of their letter pairs in common within a department, or one edit
                     apart in different departments where the name stands for one person on each side; the department
                     adds to the score and so breaks ties; links across departments are for review
    FUZZY sound      same department and first name, last names sound alike
    FUZZY first      same department and first name (changed last name); always for review

The similar tier joins on deletion texts (the names that yield one text by deleting a letter number at most
(length + 1) x alphabet) and on the rarest letter pairs of a name, by a prefix filter with bounds on length and position,
always over distinct names.

Apart from the tiers, ``agreement_patterns``, ``fit_weights`` and ``link_probabilities`` score candidate pairs by the
Fellegi-Sunter model, its parameters fitted by expectation maximisation over the few patterns of agreement.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.scalars import clean_label, clean_name, first_word, fold_nickname, last_word
from tidewatch.functions.similarity import edit_likeness, jaro_winkler
from tidewatch.operators.skew import salted_join
from tidewatch.session import ship_package
from tidewatch.sources.tables import staging

NAME_KEY = ["dept", "first", "last"]

Stage = Callable[[DataFrame, str], DataFrame]


def normalize_name(df: DataFrame, name: str, first: str = "first", last: str = "last") -> DataFrame:
    """Upper case, credential suffix and middle initial dropped, split, nickname folded."""
    return (
        df.withColumn("_clean", clean_name(name))
        .withColumn(first, fold_nickname(first_word("_clean")))
        .withColumn(last, last_word("_clean"))
        .drop("_clean")
    )


def people(df: DataFrame, id_col: str, name: str, dept: str) -> DataFrame:
    """Distinct (id, dept, first, last). Several spellings of one person under one id fold together."""
    named = normalize_name(df.select(F.col(id_col).alias("id"), F.col(name).alias("_n"), F.col(dept).alias("_d")), "_n")
    return named.select("id", clean_label("_d").alias("dept"), "first", "last").distinct()


def name_counts(p: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """How many people share a key, and one of them. Folded map-side: a hot name is one row."""
    known = p
    for k in keys:
        known = known.where(F.col(k).isNotNull() & (F.length(k) > 0))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{tag}"), F.min("id").alias(f"id_{tag}"))


def match_unique(l: DataFrame, r: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Links where the key stands for exactly one person on each side."""
    lc = name_counts(l, keys, "l").where("n_l = 1")
    rc = name_counts(r, keys, "r").where("n_r = 1")
    return lc.join(rc, list(keys))


def deletions(text: str):
    """The text and every text with one letter taken out."""
    t = F.col(text)
    cut = F.transform(
        F.sequence(F.lit(1), F.length(t)),
        lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
    )
    return F.array_distinct(F.concat(F.array(t), cut))


#: Names are alike when this percentage of their distinct letter pairs are common ones (of all that either has).
GRAM_PERCENT = 50


def grams(text: str):
    """The distinct pairs of neighbouring letters; a text of one letter is its own."""
    t = F.col(text)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(2))))


def alike_in_grams(a: DataFrame, b: DataFrame, percent: int = GRAM_PERCENT) -> DataFrame:
    """Pairs of names (``name_l``, ``name_r``) of one ``dept`` with ``percent`` of their letter pairs in common.

    Grams of a name stand in one order, rarest first by counts over both sides. Two names that are alike share one of the
    first ``prefix`` grams of each, their lengths are alike too, and behind the first common gram enough others must be
    left: only pairs that pass all of that are compared. No pair is missed.
    """
    parted = {"l": a, "r": b}
    names = {k: df.select("dept", F.col(f"name_{k}").alias("name")).withColumn("gram", F.explode(grams("name"))) for k, df in parted.items()}
    counts = names["l"].select("gram").union(names["r"].select("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))

    def keyed(tag: str) -> DataFrame:
        ordered = (
            names[tag].join(counts, "gram").groupBy("dept", "name").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("g"))
        )  # as long as a name
        size = F.size("g")
        prefix = size - F.ceil(size * F.lit(percent) / 100).cast("int") + 1
        first = F.posexplode(F.slice("g", F.lit(1), prefix)).alias("at", "one")
        return ordered.withColumn("size", size).select(
            "dept", F.col("name").alias(f"name_{tag}"), F.col("g.gram").alias(f"g_{tag}"), F.col("size").alias(f"size_{tag}"), first
        ).select("*", F.col("one.gram").alias("gram"), F.col("at").alias(f"at_{tag}")).drop("one", "at")

    x, y = F.col("size_l"), F.col("size_r")
    least = F.ceil(F.lit(percent) * (x + y) / F.lit(100 + percent))
    met = keyed("l").join(keyed("r"), ["dept", "gram"]).where(
        (100 * F.least(x, y) >= percent * F.greatest(x, y)) & (F.least(x - F.col("at_l"), y - F.col("at_r")) >= least)
    )
    common = F.size(F.array_intersect("g_l", "g_r"))
    alike = met.where((100 + percent) * common >= percent * (x + y)).select("dept", "name_l", "name_r").distinct()
    return alike.join(a, ["dept", "name_l"]).join(b, ["dept", "name_r"])


def candidate_pairs(l: DataFrame, r: DataFrame) -> DataFrame:
    """Distinct name pairs worth scoring: (dept_l, dept_r, name_l, name_r) with the counts and one id of each side.

    Within a department: one edit apart (adjacent swaps included), or letter pairs alike (``alike_in_grams``). Across departments: one edit apart, for names that stand for one person on each side; any other name is ambiguous
    without its department, and would make a row per pair of departments.
    """

    def named(p: DataFrame, tag: str) -> DataFrame:
        counts = name_counts(p, NAME_KEY, tag)
        full = F.concat_ws(" ", "first", "last").alias(f"name_{tag}")
        return counts.select("dept", F.col("dept").alias(f"dept_{tag}"), full, f"n_{tag}", f"id_{tag}")

    def alone(p: DataFrame, tag: str) -> DataFrame:
        p = p.where(F.length("dept") > 0)
        held = name_counts(p, ["first", "last"], tag).where(f"n_{tag} = 1").select(f"id_{tag}", "first", "last")
        dept = p.select(F.col("id").alias(f"id_{tag}"), "first", "last", F.col("dept").alias(f"dept_{tag}"))
        one = held.join(dept, [f"id_{tag}", "first", "last"])
        return one.select(f"dept_{tag}", F.concat_ws(" ", "first", "last").alias(f"name_{tag}"), F.lit(1).cast("bigint").alias(f"n_{tag}"), f"id_{tag}")

    def cut(p: DataFrame, tag: str) -> DataFrame:
        return p.withColumn("_cut", F.explode(deletions(f"name_{tag}")))

    a, b = named(l, "l"), named(r, "r")
    keep = ["dept_l", "dept_r", "name_l", "name_r", "n_l", "id_l", "n_r", "id_r"]
    near = cut(a, "l").join(cut(b, "r"), ["dept", "_cut"]).select(keep)
    alike = alike_in_grams(a, b).select(keep)
    across = cut(alone(l, "l"), "l").join(cut(alone(r, "r"), "r"), "_cut").where("dept_l <> dept_r").select(keep)
    pair = ["dept_l", "dept_r", "name_l", "name_r"]
    every = near.unionByName(alike).unionByName(across)
    return every.groupBy(*pair).agg(*[F.first(c).alias(c) for c in ("n_l", "id_l", "n_r", "id_r")])


#: Share of the score that an equal department gives.
DEPT_SHARE = 0.05


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Likeness (the better of Jaro-Winkler and 1 - Levenshtein / length) with the department's share, to four places."""
    a, b = F.col("name_l"), F.col("name_r")
    likeness = F.greatest(jaro_winkler(a, b), edit_likeness(a, b))
    same = F.when(F.col("dept_l") == F.col("dept_r"), F.lit(DEPT_SHARE)).otherwise(F.lit(0.0))
    return pairs.withColumn("score", F.round(likeness * F.lit(1.0 - DEPT_SHARE) + same, 4))


def best_candidates(scored: DataFrame) -> DataFrame:
    """Mutual best pairs with the lead over the runner-up on either side. Windows hold the candidates of one name."""
    wl = W.partitionBy("dept_l", "name_l").orderBy(F.col("score").desc(), "name_r", "dept_r")
    wr = W.partitionBy("dept_r", "name_r").orderBy(F.col("score").desc(), "name_l", "dept_l")
    ranked = (
        scored.withColumn("_l", F.row_number().over(wl))
        .withColumn("_l2", F.lead("score").over(wl))
        .withColumn("_r", F.row_number().over(wr))
        .withColumn("_r2", F.lead("score").over(wr))
    )
    second = F.greatest(F.coalesce("_l2", F.lit(0.0)), F.coalesce("_r2", F.lit(0.0)))
    return ranked.where("_l = 1 AND _r = 1").withColumn("margin", F.round(F.col("score") - second, 4)).drop(
        "_l", "_l2", "_r", "_r2"
    )


def unique_links(p: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``match_unique`` over one table holding both sides (``side`` is l or r): a single aggregate."""
    known = p
    for k in keys:
        known = known.where(F.col(k).isNotNull() & (F.length(k) > 0))
    is_l, is_r = F.col("side") == "l", F.col("side") == "r"
    return (
        known.groupBy(*keys)
        .agg(
            F.count_if(is_l).alias("n_l"),
            F.count_if(is_r).alias("n_r"),
            F.min(F.when(is_l, F.col("id"))).alias("id_l"),
            F.min(F.when(is_r, F.col("id"))).alias("id_r"),
        )
        .where("n_l = 1 AND n_r = 1")
    )


def build_crosswalk(
    l: DataFrame,
    r: DataFrame,
    accept: float = 0.88,
    review: float = 0.93,
    margin: float = 0.03,
    stage: Stage | None = None,
) -> DataFrame:
    """Tiered matching of two ``people`` tables. Every id of either side is in the result, in one row.

    A pair is linked when neither end has another link in its tier. Ids with several links are not guessed at: they stand
    unlinked with the rule ``several_links``, for review, and take no part in later tiers.

    Both sides live in one table that gains its match columns tier by tier; a tier looks only at rows
    still open. Each tier reads that table twice, so ``stage(df, name)`` writes it and reads it back
    (by default in the shared scratch folder): a lost executor or a later tier never repeats the
    earlier ones. This is the one operator that runs jobs of its own.
    """
    ship_package(l.sparkSession)  # the likeness runs on the executors
    keep: Stage = stage or staging(l.sparkSession, "crosswalk")
    sure, doubt = F.lit(False), F.lit(True)

    def close(p: DataFrame, links: DataFrame, method: str, rule: str, conf, needs) -> DataFrame:
        found = F.struct(
            F.lit(method).alias("match_method"),
            F.lit(rule).alias("match_rule"),
            conf.cast("double").alias("confidence"),
            needs.alias("needs_review"),
        )
        both = F.explode(
            F.array(
                F.struct(F.lit("l").alias("side"), F.col("id_l").alias("id"), F.col("id_r").alias("other")),
                F.struct(F.lit("r").alias("side"), F.col("id_r").alias("id"), F.col("id_l").alias("other")),
            )
        )
        # An id may carry several names. Linked are pairs whose two ends have no other link; all others go to review.
        pairs = links.groupBy("id_l", "id_r").agg(F.min(found).alias("_new"))
        alone = (F.count(F.lit(1)).over(W.partitionBy("id_l")) == 1) & (F.count(F.lit(1)).over(W.partitionBy("id_r")) == 1)
        taken = pairs.withColumn("_clear", alone).select(both.alias("_b"), "_new", "_clear").select("_b.*", "_new", "_clear")
        taken = taken.groupBy("side", "id").agg(F.min(F.struct("other", "_new")).alias("_t"), F.min("_clear").alias("_clear"))
        return (
            p.join(taken, ["side", "id"], "left")
            .withColumn("other", F.coalesce("other", F.when(F.col("_clear"), F.col("_t.other"))))
            .withColumn("how", F.coalesce("how", F.when(F.col("_clear"), F.col("_t._new"))))
            .withColumn("several", F.col("several") | F.coalesce(~F.col("_clear"), F.lit(False)))
            .drop("_t", "_clear")
        )

    def still_open(p: DataFrame) -> DataFrame:
        return p.where(F.col("how").isNull() & ~F.col("several")).drop("how", "other", "several")

    kind = "struct<match_method: string, match_rule: string, confidence: double, needs_review: boolean>"
    tagged = l.withColumn("side", F.lit("l")).unionByName(r.withColumn("side", F.lit("r")))
    p = tagged.withColumn("other", F.lit(None).cast("string")).withColumn("how", F.lit(None).cast(kind))
    p = p.withColumn("several", F.lit(False))
    p = keep(p, "people")
    p = close(p, unique_links(still_open(p).select("side", "id", F.col("id").alias("_same")).distinct(), ["_same"]),
              "EXACT_ID", "same_id", F.lit(1.0), sure)
    p = keep(close(p, unique_links(still_open(p), NAME_KEY), "EXACT_NAME", "same_name", F.lit(1.0), sure), "exact")

    free = still_open(p)
    pairs = candidate_pairs(free.where("side = 'l'").drop("side"), free.where("side = 'r'").drop("side"))
    best = best_candidates(score_pairs(pairs).where(F.col("score") >= accept)).where("n_l = 1 AND n_r = 1")
    unsure = (F.col("score") < review) | (F.col("margin") < margin) | (F.col("dept_l") != F.col("dept_r"))
    p = keep(close(p, best, "FUZZY", "similar_name", F.col("score"), unsure), "edit")

    alike = unique_links(still_open(p).withColumn("sound", F.soundex("last")), ["dept", "first", "sound"])
    p = close(p, alike, "FUZZY", "same_sound", F.lit(accept), doubt)
    p = close(p, unique_links(still_open(p), ["dept", "first"]), "FUZZY", "same_first_name", F.lit(0.5), doubt)
    p = keep(p, "first")

    # A name that several open people of either side hold is a tie; only such names are spread before the join.
    free = still_open(p)
    held = free.groupBy(*NAME_KEY).agg(
        F.count_if(F.col("side") == "l").alias("_l"), F.count_if(F.col("side") == "r").alias("_r")
    ).where("_l > 1 OR _r > 1")
    ties = salted_join(free, held, NAME_KEY, ["id"]).groupBy("side", "id").agg(F.max(F.col("_l").isNotNull()).alias("_tie"))
    many = p.where(F.col("how").isNull() & F.col("several")).select("side", "id", F.lit(None).cast("boolean").alias("_tie")).distinct()
    rest = ties.unionByName(many).select(
        F.when(F.col("side") == "l", F.col("id")).alias("left_id"),
        F.when(F.col("side") == "r", F.col("id")).alias("right_id"),
        F.lit("UNMATCHED").alias("match_method"),
        F.when(F.col("_tie").isNull(), "several_links").when(F.col("_tie"), "tie").otherwise("none").alias("match_rule"),
        F.lit(0.0).alias("confidence"),
        F.lit(True).alias("needs_review"),
    )
    linked = p.where("side = 'l' AND how IS NOT NULL").select(
        F.col("id").alias("left_id"), F.col("other").alias("right_id"), "how.*"
    ).distinct()
    rows = linked.unionByName(rest)
    key = F.md5(F.concat_ws("|", F.coalesce("left_id", F.lit("-")), F.coalesce("right_id", F.lit("-"))))
    return rows.select(F.concat(F.lit("K-"), F.substring(key, 1, 16)).alias("employee_key"), "*")


def review_queue(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.where("needs_review")


# --- probabilities of a link ----------------------------------------------------------------


#: Levels of agreement of each field, best first (0 disagrees).
FIELDS = {"dept": 1, "first": 2, "last": 2}


def agreement(pairs: DataFrame) -> DataFrame:
    """Add ``a_dept`` (equal), ``a_first`` (equal 2, same initial 1) and ``a_last`` (equal 2, one edit apart or the same sound 1)."""
    first = lambda k: F.substring_index(f"name_{k}", " ", 1)
    last = lambda k: F.substring_index(f"name_{k}", " ", -1)
    near = (F.levenshtein(last("l"), last("r")) <= 1) | (F.soundex(last("l")) == F.soundex(last("r")))
    return pairs.withColumns(
        {
            "a_dept": (F.col("dept_l") == F.col("dept_r")).cast("int"),
            "a_first": F.when(first("l") == first("r"), 2).when(F.substring(first("l"), 1, 1) == F.substring(first("r"), 1, 1), 1).otherwise(0),
            "a_last": F.when(last("l") == last("r"), 2).when(near, 1).otherwise(0),
        }
    )


def agreement_patterns(pairs: DataFrame) -> DataFrame:
    """(a_dept, a_first, a_last, n): how many candidate pairs agree how; at most 18 rows."""
    return agreement(pairs).groupBy(*[f"a_{f}" for f in FIELDS]).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class LinkModel:
    """Share of true links among candidates, and per field the chance of each level for links (m) and others (u)."""

    share: float
    m: dict[str, list[float]]
    u: dict[str, list[float]]
    rounds: int

    def weight(self, levels: dict[str, int]) -> float:
        """Log2 of how much likelier the pattern is for links."""
        return sum(math.log2(self.m[f][levels[f]] / self.u[f][levels[f]]) for f in FIELDS)

    def probability(self, levels: dict[str, int]) -> float:
        odds = self.share / (1.0 - self.share) * 2.0 ** self.weight(levels)
        return odds / (1.0 + odds)


def fit_weights(patterns: DataFrame, belief: float = 0.2, rounds: int = 500, tolerance: float = 1e-9) -> LinkModel:
    """Expectation maximisation over the patterns (18 rows at most come to the driver), fields taken as independent.

    Candidates are alike in some way all of them, so what splits them best need not be links and others. Therefore
    both shares are drawn towards those of the start (links mostly agree, others mostly do not) as by ``belief`` times as many
    pairs as there are of either. Every level keeps a small count, so its weight is finite. Without pairs the start is returned.
    """
    rows = [({f: r[f"a_{f}"] for f in FIELDS}, float(r["n"])) for r in sorted(patterns.collect())]
    start_m = {"dept": [0.2, 0.8], "first": [0.05, 0.15, 0.8], "last": [0.05, 0.25, 0.7]}
    start_u = {"dept": [0.9, 0.1], "first": [0.7, 0.2, 0.1], "last": [0.7, 0.2, 0.1]}
    model = LinkModel(0.2, start_m, start_u, 0)
    total = sum(n for _, n in rows)
    for n_round in range(1, rounds + 1 if total else 1):
        sure = [model.probability(levels) for levels, _ in rows]
        links = sum(p * n for p, (_, n) in zip(sure, rows, strict=True))

        def shares(part: list[float], f: str, prior: list[float]) -> list[float]:
            held = [0.01 + belief * sum(w * n for w, (_, n) in zip(part, rows, strict=True)) * x for x in prior]
            for w, (levels, n) in zip(part, rows, strict=True):
                held[levels[f]] += w * n
            return [h / sum(held) for h in held]

        rest = [1.0 - p for p in sure]
        new = LinkModel(
            min(1 - 1e-6, max(1e-6, links / total)), {f: shares(sure, f, start_m[f]) for f in FIELDS}, {f: shares(rest, f, start_u[f]) for f in FIELDS}, n_round
        )
        moved = abs(new.share - model.share) + sum(abs(x - y) for f in FIELDS for x, y in zip(new.m[f] + new.u[f], model.m[f] + model.u[f], strict=True))
        model = new
        if moved < tolerance:
            break
    return model


def link_probabilities(pairs: DataFrame, model: LinkModel) -> DataFrame:
    """The pairs with ``weight`` and ``probability`` of being one person."""
    every = [dict(zip(FIELDS, levels, strict=True)) for levels in product(*[range(n + 1) for n in FIELDS.values()])]
    rows = [(*levels.values(), model.weight(levels), model.probability(levels)) for levels in every]
    table = pairs.sparkSession.createDataFrame(rows, "a_dept int, a_first int, a_last int, weight double, probability double")
    return agreement(pairs).join(F.broadcast(table), [f"a_{f}" for f in FIELDS])  # 18 rows


def probable_links(scored: DataFrame, least: float = 0.9) -> DataFrame:
    """Pairs of at least that probability that are the best one of both their names (``margin`` is the lead in weight)."""
    return best_candidates(scored.withColumn("score", F.col("weight"))).drop("score").where(F.col("probability") >= least)
