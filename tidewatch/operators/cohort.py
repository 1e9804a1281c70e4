"""Peer comparison: leave-one-out z-scores with a fallback cohort, label scoring, equity spread."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.skew import salted_join


def _peer_stats(long: DataFrame, level: Sequence[str], n: int) -> DataFrame:
    """One row per (cohort, feature): moments, and the extreme values with how often they occur."""
    by = [*level, "feature"]
    known = long.where(F.col("value").isNotNull())
    moments = known.groupBy(*by).agg(
        F.count("value").alias(f"_n{n}"),
        F.avg("value").alias(f"_mean{n}"),
        (F.var_pop("value") * F.count("value")).alias(f"_m2{n}"),
    )
    freq = known.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("_c"))
    ends = freq.groupBy(*by).agg(
        F.min(F.struct("value", "_c")).alias(f"_lo{n}"), F.max(F.struct("value", "_c")).alias(f"_hi{n}")
    )
    return moments.join(ends, by)


def cohort_zscore(
    df: DataFrame, ids: Sequence[str], feats: Sequence[str], levels: Sequence[Sequence[str]], min_peers: int = 5
) -> DataFrame:
    """Score each row against the OTHERS of its cohort, in long form (one row per id and feature).

    ``levels`` go from narrow to wide; the first with at least ``min_peers`` peers is used (the last one
    otherwise). Peers exclude the row itself: with it included, the largest possible score in a cohort
    of n is (n-1)/sqrt(n). Peers without spread give a NULL score, and ``const_peers`` tells whether the
    row differs from them. Cohort figures are aggregates joined back with a salt, so a cohort holding
    most of the rows is neither windowed nor sent to one task.
    """
    carried = list(dict.fromkeys([*ids, *[c for lv in levels for c in lv]]))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in feats])
    long = df.select(*carried, F.explode(pairs).alias("_p")).select(*carried, "_p.feature", "_p.value")
    out = long
    for i, level in enumerate(levels):
        out = salted_join(out, _peer_stats(long, level, i), [*level, "feature"], ids)

    x = F.col("value")

    def scored(i: int) -> Column:
        n, mean, m2 = F.coalesce(F.col(f"_n{i}"), F.lit(0)), F.col(f"_mean{i}"), F.col(f"_m2{i}")
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        peers = F.when(x.isNull(), n).otherwise(n - 1)
        peer_mean = F.when(x.isNull(), mean).otherwise(F.when(n > 1, (n * mean - x) / (n - 1)))
        rest = F.when(x.isNull(), m2).otherwise(F.when(n > 1, m2 - (x - mean) * (x - mean) * n / (n - 1)))
        own = lambda end: F.when(end["value"] == x, 1).otherwise(0)
        flat = (peers > 0) & ((lo["_c"] - own(lo) == peers) | (hi["_c"] - own(hi) == peers))
        sd = F.when(flat, F.lit(0.0)).otherwise(F.when(peers > 1, F.sqrt(F.greatest(rest, F.lit(0.0)) / (peers - 1))))
        flat_value = F.when(lo["_c"] - own(lo) == peers, lo["value"]).otherwise(hi["value"])
        return F.struct(
            F.lit("+".join(levels[i])).alias("cohort_level"),
            peers.cast("bigint").alias("n_peers"),
            F.when(flat, flat_value).otherwise(peer_mean).alias("peer_mean"),
            sd.alias("peer_sd"),
            F.when(sd > 0, (x - peer_mean) / sd).alias("z"),
            F.coalesce(flat & (x != flat_value), F.lit(False)).alias("const_peers"),
        )

    pick = scored(len(levels) - 1)
    for i in reversed(range(len(levels) - 1)):
        s = scored(i)
        pick = F.when(s["n_peers"] >= min_peers, s).otherwise(pick)
    return out.withColumn("_s", pick).select(*carried, "feature", "value", "_s.*")


def confusion(df: DataFrame, pred: str, truth: str) -> DataFrame:
    return df.groupBy(F.col(pred).alias("pred"), F.col(truth).alias("truth")).agg(F.count(F.lit(1)).alias("n"))


def evaluate_labels(df: DataFrame, pred: str, truth: str, order: Sequence[str] | None = None) -> DataFrame:
    """Precision and recall per label; with ``order`` also how many are within one step of the truth."""
    m = confusion(df, pred, truth)
    same = F.col("pred") == F.col("truth")
    near = F.lit(None).cast("bigint")
    if order is not None:
        scale = F.array(*[F.lit(x) for x in order])
        pos = lambda c: F.array_position(scale, F.col(c))
        known = (pos("pred") > 0) & (pos("truth") > 0)
        near = F.when(known & (F.abs(pos("pred") - pos("truth")) <= 1), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    as_pred = F.struct(
        F.col("pred").alias("label"),
        F.when(same, F.col("n")).otherwise(zero).alias("tp"),
        F.when(same, zero).otherwise(F.col("n")).alias("fp"),
        zero.alias("fn"),
        zero.alias("near"),
        zero.alias("support"),
    )
    as_truth = F.struct(
        F.col("truth").alias("label"),
        zero.alias("tp"),
        zero.alias("fp"),
        F.when(same, zero).otherwise(F.col("n")).alias("fn"),
        near.cast("bigint").alias("near"),
        F.col("n").alias("support"),
    )
    g = (
        m.select(F.explode(F.array(as_pred, as_truth)).alias("e"))
        .select("e.*")
        .where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "near", "support")])
    )
    out = g.select(
        "label",
        "tp",
        "fp",
        "fn",
        "support",
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).alias("recall"),
        F.col("near").alias("within_one"),
    )
    return out if order is not None else out.drop("within_one")


def precision_at(df: DataFrame, score: str, tie: str, truth: str, k: int) -> DataFrame:
    """Share of true cases among the k highest scores, and share of all true cases found there."""
    top = df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)
    hits = top.agg(F.count_if(F.col(truth)).alias("hits"), F.count(F.lit(1)).alias("k"))
    total = df.agg(F.count_if(F.col(truth)).alias("positives"))
    one_row = hits.withColumn("_j", F.lit(1)).join(total.withColumn("_j", F.lit(1)), "_j").drop("_j")
    return one_row.withColumn("precision_at_k", F.try_divide(F.col("hits"), F.col("k"))).withColumn(
        "recall_at_k", F.try_divide(F.col("hits"), F.col("positives"))
    )


def equity_spread(df: DataFrame, by: Sequence[str], entity: str, flags: Mapping[str, Column], fte: str) -> DataFrame:
    """How evenly flagged work (nights, weekends) is shared, per full-time equivalent."""
    per = df.groupBy(*by, entity).agg(
        F.max(fte).alias("_fte"), *[F.count_if(cond).alias(name) for name, cond in flags.items()]
    )
    aggs = [F.count(F.lit(1)).alias("n_entities")]
    for name in flags:
        share = F.col(name) / F.col("_fte")
        aggs += [
            F.sum(name).alias(f"{name}_total"),
            F.avg(share).alias(f"{name}_mean"),
            F.stddev_samp(share).alias(f"{name}_sd"),
            (F.max(share) - F.min(share)).alias(f"{name}_range"),
        ]
    return per.groupBy(*by).agg(*aggs)
