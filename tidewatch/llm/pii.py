"""Personal data: fixed base forms, and bootstrapped extraction of identifiers that stand in the same contexts.

Base entities are the seeds, and so are credentials of a fixed form (kind ``secret``, which is no base kind). Their contexts
(the words before and after, or the word before with the shape of the token, hashed) are lexical patterns; tokens that look
like identifiers and stand in such contexts are candidate instances. Spark scores the graph of patterns and instances until
no more is found: a pattern is as good as the instances it extracts, an instance as good as its best confident
patterns. Tokens that confident patterns reach are added with the pattern's kind, and so are the credentials.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import Stage, fresh, parted, stage_for
from tidewatch.session import ship_package

KINDS = ["email", "ip", "card", "phone", "secret"]
#: Kinds of the base; a kind behind them only adds spans.
N_BASE = 4
#: A pattern is confident when at least this share of the distinct instances it extracts is known, counted with one
#: unknown instance more, and when it extracts this many known ones.
CONFIDENT, SUPPORT = 0.8, 5
#: An unseen token must look like an identifier: so many digits, or an at sign inside.
LEAST_DIGITS = 5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits that fails at its begin fails inside too, so matching starts at run begins only (linear time).
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![0-9A-Za-z])(?:AKIA[A-Z0-9]{16,}|[0-9a-f]{32,})(?![0-9A-Za-z])")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'`.,;:!?()[]{}<>|=*#$%&~^"
_NOT_DIGIT = re.compile(r"[^0-9]")
_SHAPES = (re.compile("[0-9]+"), re.compile("[a-z]+"), re.compile("[A-Z]+"))

Span = tuple[int, int, int]  # start, kind number, end


def _emails(text: str) -> Iterator[Span]:
    at, last = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, 0, found.end()
        # Nothing before this sign can belong to a later local part, which never holds one.
        last = found.end() if found else at + 1
        at = text.find("@", last)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass their test, ordered by start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def secret_spans(text: str, taken: list[Span]) -> list[Span]:
    """Credentials of a fixed form that touch no base span: access keys, and runs of 32 or more hex digits of letters and digits."""
    if not _DIGIT.search(text):
        return []
    found = [(m.start(), N_BASE, m.end()) for m in _SECRET.finditer(text) if not m.group().isdigit() and not m.group().isalpha()]
    return [(s, k, e) for s, k, e in found if not any(a < e and s < b for a, _, b in taken)]


def shape(token: str) -> str:
    """Classes of signs: 0 for digits, a and A for letters, each run once; other signs stay."""
    return _SHAPES[2].sub("A", _SHAPES[1].sub("a", _SHAPES[0].sub("0", token)))


def candidate_spans(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Tokens without their edge signs that look like identifiers and touch no base span."""
    if "@" not in text and not _DIGIT.search(text):
        return []
    out, ends = [], sorted((s, e) for s, _, e in taken)
    for m in _TOKEN.finditer(text):
        token = m.group()
        if "@" not in token and sum(c in "0123456789" for c in token) < LEAST_DIGITS:
            continue
        begin = m.start() + len(token) - len(token.lstrip(_EDGE))
        end = m.start() + len(token.rstrip(_EDGE))
        if begin < end and not any(s < end and begin < e for s, e in ends):
            out.append((begin, end))
    return out


def _hash(kind: str, *words: str) -> int:
    raw = "\x1f".join((kind, *words)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


#: Code points looked at on either side of a token for its context words.
REACH = 80


def contexts(text: str, begin: int, end: int) -> list[int]:
    """The patterns around a token: two words before; one word before with one after; one word before with the token's shape.

    Quotation marks alone are no words.
    """
    left = [w for w in text[max(0, begin - REACH) : begin].lower().split() if w.strip("\"'`")]
    right = [w for w in text[end : end + REACH].lower().split() if w.strip("\"'`")]
    out = []
    if left:
        out.append(_hash("shape", left[-1], shape(text[begin:end][:REACH])))
    if len(left) >= 2:
        out.append(_hash("two before", *left[-2:]))
    if left and right:
        out.append(_hash("around", left[-1], right[0]))
    return out


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())])
_SEEN = T.ArrayType(T.StructType([*_SPAN.fields, T.StructField("instance", T.LongType()), T.StructField("patterns", T.ArrayType(T.LongType()))]))
_ARROW_SPAN = [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]


def find_base(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, base spans, seen): one pass over the whole texts; ``seen`` are base entities and candidates (kind -1)."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("base", T.ArrayType(_SPAN)), T.StructField("seen", _SEEN)])
    base_type = pa.list_(pa.struct(_ARROW_SPAN))
    seen_type = pa.list_(pa.struct([*_ARROW_SPAN, ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, seen = [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                spans = base_spans(t)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                seeds = spans + secret_spans(t, spans)
                found = seeds + [(s, -1, e) for s, e in candidate_spans(t, seeds)]
                seen.append(
                    [
                        {"start": s, "kind": k, "end": e, "instance": _hash("instance", t[s:e].lower()), "patterns": contexts(t, s, e)}
                        for s, k, e in found
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, base_type), pa.array(seen, seen_type)], ["id", "base", "seen"]
            )

    return docs.select(id_col, text).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def confident_patterns(seen: DataFrame, stage: Stage) -> DataFrame:
    """(pattern, found) of the patterns that bootstrapping trusts in the end.

    ``seen`` has a row per occurrence (instance, kind or -1, patterns). Scores come from distinct pairs, so a text that
    is copied a thousand times counts once. All steps are sums per pattern or instance, combined before the shuffle. Once
    found, an instance and a pattern stay with their first score, so the rounds end: when one finds no more instances.
    """
    pairs = stage(seen.select("instance", F.explode("patterns").alias("pattern"), "kind").distinct(), "pairs")
    edges = pairs.select("pattern", "instance").distinct()
    size = edges.groupBy("pattern").agg(F.count("*").alias("all"))
    known = pairs.where("kind >= 0").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    trusted, n = None, 0
    while True:
        good = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("good"), F.count("*").alias("known"))
        scored = good.join(size, "pattern").withColumn("score", F.col("good") / (F.col("all") + 1))
        now = scored.where((F.col("score") >= CONFIDENT) & (F.col("known") >= SUPPORT)).select("pattern", "kind", "score")
        if trusted is not None:
            now = trusted.unionByName(now.join(trusted, ["pattern", "kind"], "left_anti"))
        trusted = stage(now, f"patterns-{n}")
        reached = edges.join(trusted, "pattern").groupBy("instance", "kind").agg(F.max("score").alias("score"))
        new = stage(reached.join(known.select("instance").distinct(), "instance", "left_anti"), f"new-{n}")
        if new.isEmpty():
            break
        known, n = stage(known.unionByName(new), f"known-{n}"), n + 1
    first = Window.partitionBy("pattern").orderBy(F.desc("score"), "kind")  # at most one row per kind
    return trusted.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("pattern", F.col("kind").alias("found"))


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", stage: Stage | None = None) -> DataFrame:
    """(id, base, spans): per row the base spans and all spans, arrays of (start, kind, end) in order.

    Null text counts as empty; every row gives one row, repeated rows and null ids too. Added spans never touch a base
    span of their text. An empty table gives an empty result; other columns are not read.
    """
    stage = stage or stage_for(docs.sparkSession, "pii")
    found = stage(find_base(docs, id_col, text).withColumn("_row", F.monotonically_increasing_id()), "found")
    seen = found.select("_row", F.explode("seen").alias("s")).select("_row", "s.*")
    patterns = confident_patterns(seen, stage)
    added = (
        seen.where("kind = -1")
        .select("_row", "start", "end", F.explode("patterns").alias("pattern"))
        .join(patterns, "pattern")
        .groupBy("_row", "start", "end")
        .agg(F.min("found").alias("kind"))
        .unionByName(seen.where(F.col("kind") >= N_BASE).select("_row", "start", "end", "kind"))
        .groupBy("_row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    )
    both = F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
    return found.join(added, "_row", "left").select(id_col, "base", F.array_sort(both).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        id_col,
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:N_BASE])],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def cut_out(text: str, spans: list[Span]) -> str:
    """The text with every span (overlapping ones together) replaced by its kind in angle brackets."""
    out, last = [], 0
    for start, kind, end in sorted(spans):
        if start >= last:
            out += [text[last:start], f"<{KINDS[kind].upper()}>"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, text: str = "text", stage: Stage | None = None) -> DataFrame:
    """The documents with every found span replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>``, ``<PHONE>`` or ``<SECRET>``.

    All columns stay, and so do null texts. Spans depend on the text alone, so rows are joined to them by its hash and
    length; a text without any span is not changed.
    """
    stage = stage or stage_for(docs.sparkSession, "redact")
    name = F.struct(F.xxhash64(text).alias("h"), F.length(text).alias("n"))
    key, body, held = fresh(docs, "_key_", "_text_", "_spans_")
    texts = docs.where(F.col(text).isNotNull()).select(name.alias(key), F.col(text).alias(body))
    own = stage_for(docs.sparkSession, "redact")
    found = find(texts, key, body, own).where(F.size("spans") > 0).dropDuplicates([key])
    cuts = stage(found.select(key, F.col("spans").alias(held)), "spans")
    del found
    own.end()
    names = docs.columns
    some, others = parted(docs, F.xxhash64(text), cuts.select(F.col(key)["h"].alias("h")), "h")
    joined = (
        some.withColumn(key, name)
        .join(cuts, key, "left")
        .select(F.col(text).alias(body), held, *names)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            new = [t if not s or t is None else cut_out(t, [(x["start"], x["kind"], x["end"]) for x in s]) for t, s in zip(texts, spans, strict=True)]
            columns = [pa.array(new, pa.string()) if c == text else batch.column(2 + i) for i, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema).union(others)
