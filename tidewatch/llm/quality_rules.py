"""Quality rules over whole texts, natively: fixed base rules and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed one- and two-word grams: one from trusted documents, one from the
whole raw corpus. Their counts cover all documents; only ``buckets`` weights (a fixed number of rows) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Stage, stage_for

WORD_GAP = r"[\x20\x09-\x0D]+"
#: Runs of these signs count as words of their own in the ratio, so a sign glued to every word is seen.
SIGNS = r"([#*$%&|<>!?=~^_{}\\]+)"
BUCKETS = 1 << 16
#: Counts added to every bucket of both multinomials.
SMOOTH = 2.0
#: A document stays when its mean log ratio per gram is at least this.
LEAST_RATIO = -0.4
MIN_WORDS, MAX_REPEAT_PERCENT, SPAN = 20, 30, 8


def words_of(text: Column) -> Column:
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WORD_GAP))


def _runs(hashes: str, gap: int) -> Column:
    """Hashes of each value with the one ``gap`` places on: pairs from single values, fours from pairs, and so on."""
    n = F.greatest(F.size(hashes) - gap, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 1 + gap, n), lambda a, b: F.xxhash64(a, b))


def _apart(text: Column) -> tuple[Column, Column]:
    """Whether a text holds signs, and its words with runs of signs set apart."""
    body = F.coalesce(text, F.lit(""))
    return body.rlike(SIGNS), words_of(F.regexp_replace(body, SIGNS, " $1 "))


def _hash(words: Column | str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Add the base columns and ``_grams``, the hashes of one and two words of the ratio (texts without signs reuse those of
    the windows). Each step names what the next one uses twice, so that nothing is computed per element anew."""
    step = docs.withColumn("_words", words_of(F.col(text))).withColumn("_one", _hash("_words"))
    step = step.withColumn("_two", _runs("_one", 1)).withColumn("_four", _runs("_two", 2))
    signs, apart = _apart(F.col(text))
    step = step.withColumn("_signs", signs).withColumn("_uni", F.when(F.col("_signs"), _hash(apart)).otherwise(F.col("_one")))
    step = step.withColumn("_grams", F.concat("_uni", F.when(F.col("_signs"), _runs("_uni", 1)).otherwise(F.col("_two"))))
    # A text that repeats no four words repeats no window of eight.
    none = F.array().cast("array<bigint>")
    step = step.withColumn("_hard", F.size("_four") > F.size(F.array_distinct("_four")))
    step = step.withColumn("_windows", F.when(F.col("_hard"), _runs("_four", 4)).otherwise(none))
    # Only a text that repeats a window is looked at closely: sort the windows, keep those next to an equal one.
    step = step.withColumn("_repeats", F.size("_windows") > F.size(F.array_distinct("_windows")))
    step = step.withColumn(
        "_sorted",
        F.when(F.col("_repeats"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    near = lambda i: F.get(F.col("_sorted"), i)["h"]
    step = step.withColumn(
        "_at",
        F.sort_array(
            F.transform(
                F.filter("_sorted", lambda s, i: s["h"].eqNullSafe(near(i - 1)) | s["h"].eqNullSafe(near(i + 1))), lambda s: s["i"]
            )
        ),
    )
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-SPAN).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(SPAN), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = step.withColumn("_lines", lines)
    step = step.select(
        *docs.columns,
        "_grams",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return step.withColumn("base_failed", failed)


def weights(docs: DataFrame, trusted: DataFrame, id_col: str, text: str, stage: Stage, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight) for every bucket: log of trusted over raw probability, counted over all documents.

    ``trusted`` names documents by ``id_col``; rows of other or null ids are only raw. Counts are combined in each task
    before the shuffle, so a frequent gram is one row per task.
    """
    known = trusted.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().withColumn("_trusted", F.lit(1))
    flagged = (
        docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
        .join(known.hint("shuffle_hash"), "_id", "left")
        .select("_text", F.coalesce("_trusted", F.lit(0)).alias("_trusted"))
    )
    # An outer explode: a plain one makes Spark compute the arrays in a filter below the join as well.
    signs, apart = _apart(F.col("_text"))
    one = flagged.withColumn("_uni", _hash(F.when(signs, apart).otherwise(words_of(F.col("_text")))))
    both = one.select("_trusted", F.explode_outer(F.concat(F.col("_uni"), _runs("_uni", 1))).alias("h"))
    both = both.where("h is not null").select("_trusted", F.pmod("h", F.lit(buckets)).cast("int").alias("bucket"))
    # Stored, since the totals and the weights both read them.
    counts = stage(both.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_trusted").alias("good")), "counts")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").na.fill(0, ["raw", "good"])
    total = full.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    raw_all, good_all = (F.lit(x) for x in total.first())  # two numbers
    ratio = F.log((F.col("good") + SMOOTH) / (good_all + SMOOTH * buckets)) - F.log((F.col("raw") + SMOOTH) / (raw_all + SMOOTH * buckets))
    return full.select("bucket", ratio.alias("weight"))


def apply_rules(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    least: float = LEAST_RATIO,
    stage: Stage | None = None,
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept) of every document.

    ``llr`` is the mean weight of the document's grams (0 without any); ``kept`` is false where a base rule fails and else
    whether ``llr`` reaches ``least``. Null text counts as empty. Every row gives one row, repeated rows and null ids
    too; other columns are not read. An empty table gives an empty result; without trusted rows both models are the
    same up to smoothing and few documents fall below the limit.
    """
    stage = stage or stage_for(docs.sparkSession, "rules")
    table = weights(docs, trusted, id_col, text, stage, buckets)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).withColumn("_row", F.monotonically_increasing_id())
    based = with_base(rows, "_text")
    # A document's grams lie in one task, so they fold to one row before the shuffle. The weights are ``buckets`` rows.
    folded = (
        based.select("_row", "_id", *names, F.explode_outer("_grams").alias("h"))
        .withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
        .join(F.broadcast(table), "bucket", "left")
        .groupBy("_row")
        .agg(F.first("_id").alias(id_col), *[F.first(c).alias(c) for c in names], F.coalesce(F.avg("weight"), F.lit(0.0)).alias("llr"))
        .drop("_row")
    )
    return folded.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= least))
