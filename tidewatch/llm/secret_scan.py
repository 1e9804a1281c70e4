"""Secret scans natively: an incremental ledger of content-addressed texts.

A text is known by its SHA-256, whatever path and version hold it. The ledger has one row for each text and scan:
the rules (with their versions) that were applied and the spans they found. A new scan takes up only pairs of text
and rule version that no row has, reads each such text once, and findings are joined back to every path.
A rule whose pattern changes gets a new version, and only that rule is applied again.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

#: Findings of one text are joined to paths in so many parts, so that a text at very many paths is no hot key.
PATH_PARTS = 32


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; one counts if its ``group`` has ``least`` characters.

    ``hint`` is a cheaper pattern that every match contains; texts without it are not searched.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1
    hint: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns of the base kinds, then the rules that only add spans.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        hint=r"(?i:passw|secret|token|api_?key)",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, hint="AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", least=24, hint="[0-9a-f]{24}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]{0,32}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?:Bearer|bearer) [A-Za-z0-9._~+/-]{20,}=*"),
    Rule("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{6,64}@"),
)
RULES = BASE + ADDED

LEDGER = "blob string, rules array<string>, spans array<struct<kind string, version int, start int, stop int>>"


class BlobLedger:
    """A ledger in a shared folder; every scan adds one folder of rows and changes none."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def rows(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        if not there:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(os.path.join(self.base, "scan=*"))

    def unseen(self, versions: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, path, todo): for each text with a rule version not applied to it yet, one path that holds it."""
        seen = self.rows().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        own = versions.groupBy("blob").agg(F.min("path").alias("path"))
        todo = F.array_except(F.array(*[F.lit(r.name) for r in rules]), F.coalesce("seen", F.array().cast("array<string>")))
        return own.join(seen, "blob", "left").select("blob", "path", todo.alias("todo")).where(F.size("todo") > 0)

    def scan(self, texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Apply what is not applied yet to ``texts`` (path, blob, text) and add it to the ledger; returns the added rows."""
        # A path may be null; one of equal (path, text) rows is enough, which the ledger's rows make so below.
        held = texts.where("text is not null").select("blob", "path", "text")
        todo = self.unseen(held.select("blob", "path"), rules)
        same = (F.col("h.blob") == F.col("t.blob")) & F.col("h.path").eqNullSafe(F.col("t.path"))
        # Keyed by text and path: of a text at very many paths, one row meets its match, the others lie spread.
        work = held.alias("h").join(todo.alias("t").hint("shuffle_hash"), same).select("h.blob", "h.text", "t.todo")
        out = os.path.join(self.base, f"scan={uuid.uuid4().hex[:12]}")
        findings(work, rules).write.parquet(out)
        return self.spark.read.schema(LEDGER).parquet(out)

    def spans(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, kind, start, stop) of the given rule versions, each once."""
        wanted = [F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]
        found = self.rows().where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s"))
        found = found.where(F.array_contains(F.array(*wanted), F.struct(F.col("s.kind").alias("kind"), F.col("s.version").alias("version"))))
        return found.select("blob", "s.kind", "s.start", "s.stop").distinct()


def _matches(text: str, rule: Rule) -> Column:
    """(gap, size, measured) of every match: code points since the match before, its own, those of the group that counts."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(F.col(text), rule.pattern, -1)
    group = whole if not rule.group else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    return F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("all"), group.alias("part")),
        lambda m: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            F.length(m["gap"]).alias("gap"),
            F.length(m["all"]).alias("size"),
            F.length(m["part"]).alias("part"),
        ),
    )


def findings(work: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of (blob, text, todo): one per text. Equal texts of one blob may come several times.

    The place of a match is a running sum over the matches before it, so that a text with very many matches costs no
    more than their number.
    """
    none = F.array().cast("array<struct<kind:string,version:int,gap:int,size:int,part:int>>")
    columns = [
        F.when(F.array_contains("todo", r.name) & F.col("text").rlike(r.hint or r.pattern), _matches("text", r)).otherwise(none)
        for r in rules
    ]
    # Row by row the text ends here; what goes on is small.
    found = work.select("blob", "todo", F.concat(*columns).alias("matches"))
    least = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.least))])
    by_match = Window.partitionBy("blob", "m.kind", "m.version").orderBy("at")
    narrow = found.groupBy("blob").agg(F.first("todo").alias("todo"), F.first("matches").alias("matches"))
    one = narrow.select("blob", "todo", F.posexplode_outer("matches").alias("at", "m"))
    placed = one.withColumn("stop", F.sum(F.col("m.gap") + F.col("m.size")).over(by_match).cast("int"))
    counts = F.col("m.part") >= F.element_at(least, F.concat(F.col("m.kind"), F.lit("@"), F.col("m.version").cast("string")))
    span = F.struct(F.col("m.kind").alias("kind"), F.col("m.version").alias("version"), (F.col("stop") - F.col("m.size")).alias("start"), "stop")
    return placed.groupBy("blob").agg(
        F.first("todo").alias("rules"), F.sort_array(F.collect_list(F.when(counts, span))).alias("spans")
    )


def addressed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, text): every row is one version of one path; a null text has no blob."""
    return docs.select(F.col(id_col).alias("path"), F.sha2(F.col(text).cast("binary"), 256).alias("blob"), F.col(text).alias("text"))


def scan(
    docs: DataFrame, ledger: BlobLedger | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, spans) of every row of ``docs``: spans (kind, start, stop) in code points by start, then in the order of the rules.

    Rows share one finding where their texts are equal. Null and empty texts have no spans; repeated rows and null ids give
    a row each. An empty table gives an empty result; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    ledger = ledger or BlobLedger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex[:12]}"))
    versions = addressed(docs, id_col, text)
    ledger.scan(versions, rules)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    per_blob = (
        ledger.spans(rules)
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", F.element_at(rank, F.col("kind")).alias("rank"), "kind", "stop"))).alias("spans"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PATH_PARTS - 1))))
    )
    rows = versions.select("path", "blob", F.pmod(F.xxhash64("path"), F.lit(PATH_PARTS)).cast("int").alias("part"))
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,stop:int>>")
    return rows.join(per_blob, ["blob", "part"], "left").select(
        F.col("path").alias(id_col),
        F.transform(F.coalesce("spans", empty), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))).alias("spans"),
    )


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a hash of their spans, and all spans as text."""
    names = [r.kind for r in BASE]
    line = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"].isin(names))
    return found.select(id_col, *[of(k).alias(f"n_{k}") for k in names], F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
