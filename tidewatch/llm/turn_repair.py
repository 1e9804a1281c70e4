"""Conversation structure repair over suffixes that conversations share.

A conversation is a word over twelve signs: the role of a row (system, user, assistant, other) and what its fault
demands (nothing, one more, delete it). What the rest of a conversation costs depends on that rest and on the state of
the grammar ``(s?(ua)+)?`` alone. So the words of all conversations are sorted from their ends, and each distinct ending is
one node of an automaton: cost-to-go and best next edit are found once for a node and state and used by every
conversation that ends so. Spark deals the words out by range, a hot word over several tasks.

Texts stay in rows: a task reads its conversations sorted, holds the digests of one conversation at most, and writes the
repaired text into a running hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Stage, stage_for

ROLES = "sua"
FAULTS = ("", "truncated", "blank", "duplicate")
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Grammar states: nothing yet, after system, after user, after assistant. What the next row must be, and where it leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ENDS = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
FULL = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\f\r"
_ROWS = "conv bigint, tag int, turn bigint, role string, text string"

# ---------------------------------------------------------------- damage


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, dropped) after the fixed damage by ``crc32("conv_id:turn") % 20``; nulls are one blank there.

    0 drops the row (it stays here, marked, so that its conversation is known), 1 empties the text, 2 removes its ``[.!?]``,
    3 repeats the row, 4 makes the role user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return (
        rows.select("conv_id", "turn", "role", "text")
        .withColumn("kind", kind)
        .select(
            F.col("conv_id").cast("bigint").alias("conv"),
            F.col("turn").cast("bigint").alias("turn"),
            F.when(F.col("kind") == 4, "user").otherwise(blank("role")).alias("role"),
            text.alias("text"),
            (F.col("kind") == 0).alias("dropped"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


# ---------------------------------------------------------------- one word per conversation


def fault(role: str, text: str, seen: set[bytes]) -> str:
    """The first fault of a row; ``seen`` holds the rows before it."""
    said = text.rstrip(SPACE)
    own = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    again = own in seen
    seen.add(own)
    if not said:
        return "blank"
    if again:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


def sign(role: str, found: str) -> str:
    """One letter for a row: a-l."""
    kind = ROLES.find(role[:1]) if role[:1] else -1
    return chr(97 + 3 * (kind if kind >= 0 else 3) + {"": 0, "truncated": 1}.get(found, 2))


def _columns(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


class _Reading:
    """What is known of the conversation being read."""

    def __init__(self, conv: int | None):
        self.conv, self.seen, self.word, self.before = conv, set(), [], None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        found = fault(role, text, self.seen)
        if found:
            self.counts[found] += 1
        self.word.append(sign(role, found))
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), "".join(self.word))


_WORDS = "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, word string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_NUMBERS = [("conv", pa.int64())] + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal")]
_WORDS_ARROW = pa.schema([*_NUMBERS, ("word", pa.string())])


def words(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, word): one row per conversation, also where all its rows are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for conv, turn, role, text, dropped in _columns(batch, ["conv", "turn", "role", "text", "dropped"]):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.row())
                    now = _Reading(conv)
                if not dropped:
                    now.add(turn, role, text)
            if len(out) > 4096:
                yield _batch(out, _WORDS_ARROW)
                out = []
        if now is not None:
            out.append(now.row())
        yield _batch(out, _WORDS_ARROW)

    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return dealt.mapInArrow(run, _WORDS)


# ---------------------------------------------------------------- the automaton


@dataclass(frozen=True)
class Node:
    """One class of endings: for each grammar state the cost-to-go beyond the class's least, the best edit, the state behind it."""

    extra: tuple[int, ...]
    edit: tuple[str, ...]
    to: tuple[int, ...]


class Endings:
    """The automaton, read from the ends of words.

    Endings with the same costs, up to a constant, and the same edits are one node, so there are few nodes whatever the
    number and length of words; a node's successor before a letter is worked out once. Words come in the order of
    their reversed letters: the path of the last word is kept, and the next one goes on from the ending they share.
    """

    def __init__(self):
        self.nodes: dict[Node, Node] = {}
        self.known: dict[tuple[str, Node], tuple[int, Node]] = {}
        inf = float("inf")
        self.word = ""
        self.path = [self._node([(0, "", s) if s in ENDS else (inf, "", s) for s in range(4)])]  # (cost, node) by length

    def _node(self, options: list[tuple]) -> tuple[int, Node]:
        """Insertions read no row: take them in until no state gets cheaper. Ties go to the least letter."""
        cost = [o[0] for o in options]
        for _ in range(4):
            cost = [min(cost[s], INSERT + cost[NEXT[s][1]]) for s in range(4)]
        best = []
        for s, (c, edit, to) in enumerate(options):
            insert = INSERT + cost[NEXT[s][1]]
            best.append((insert, "I", NEXT[s][1]) if insert < c or (insert == c and "I" < edit) else (c, edit, to))
        least = min(b[0] for b in best)
        node = Node(tuple(b[0] - least for b in best), tuple(b[1] for b in best), tuple(b[2] for b in best))
        return least, self.nodes.setdefault(node, node)

    def _before(self, letter: str, rest: Node) -> tuple[int, Node]:
        """Added cost and node of ``letter`` and the ending behind it."""
        role, need = divmod(ord(letter) - 97, 3)
        options = []
        for s in range(4):
            want, to = NEXT[s]
            ways = [(DELETE + rest.extra[s], "D", s)]
            if need < 2:
                more = TRUNCATED * need
                if role < 3 and ROLES[role] == want:
                    ways.append((more + rest.extra[to], "K", to))
                elif s == START and role == 0:
                    ways.append((more + rest.extra[SYSTEM], "K", SYSTEM))
                ways.append((REROLE + more + rest.extra[to], "R", to))
            options.append(min(ways, key=lambda w: w[:2]))
        return self._node(options)

    def best(self, word: str) -> tuple[int, str]:
        """Least cost and its edits."""
        common, longest = 0, min(len(word), len(self.word))
        while common < longest and word[-1 - common] == self.word[-1 - common]:
            common += 1
        del self.path[common + 1 :]
        for k in range(common + 1, len(word) + 1):
            cost, rest = self.path[-1]
            key = (word[-k], rest)
            if key not in self.known:
                self.known[key] = self._before(*key)
            more, node = self.known[key]
            self.path.append((cost + more, node))
        self.word = word
        cost, node = self.path[-1]
        state, at, edits = START, len(word), []
        while edit := self.path[at][1].edit[state]:
            edits.append(edit)
            state = self.path[at][1].to[state]
            at -= edit != "I"
        return cost + node.extra[START], "".join(edits)


_AUDITS_ARROW = pa.schema([*_NUMBERS, ("cost", pa.int64()), ("audit", pa.string())])
_AUDITS = _WORDS.replace("word string", "cost bigint, audit string")


def audits(found: DataFrame) -> DataFrame:
    """Cost and audit instead of the word. The ranges go by the reversed word, then the id: equal words may be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            names = [f.name for f in _WORDS_ARROW]
            rows = [(*r[:-1], *endings.best(r[-1])) for r in _columns(batch, names)]
            yield _batch(rows, _AUDITS_ARROW)

    dealt = found.withColumn("ending", F.reverse("word")).repartitionByRange("ending", "conv")
    return dealt.sortWithinPartitions("ending", "conv").drop("ending").mapInArrow(run, _AUDITS)


# ---------------------------------------------------------------- edits applied


def _joined(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Plan and rows of each conversation in one sorted stream: the plan first, as a row of its own."""
    plan = plans.select("conv", F.lit(0).alias("tag"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    kept = rows.where("not dropped").select("conv", F.lit(1).alias("tag"), "turn", "role", "text")
    return plan.union(kept).repartition("conv").sortWithinPartitions("conv", "tag", "turn", "role", "text")


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired rows. ``rows`` gives (role, text) in order, as many as the audit reads."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K" and state == START and role[:1] == "s":
            state = SYSTEM
        else:
            want, state = NEXT[state]
            role = role if edit == "K" else FULL[want]
        yield role, text


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, Iterator[tuple[str, str]]]]:
    """(conv, audit, rows) of each conversation; rows are read as they are asked for."""
    flat = (r for b in batches for r in _columns(b, ["conv", "role", "text"]))
    plan = next(flat, None)
    while plan is not None:
        yield plan[0], plan[2], ((role, text) for _, role, text in _take(flat, sum(plan[2].count(e) for e in "KRD")))
        plan = next(flat, None)


def _take(rows: Iterator[tuple], n: int) -> Iterator[tuple]:
    for _ in range(n):
        yield next(rows)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv, n, role, text): the repaired conversations, rows numbered from 0."""
    schema = pa.schema([("conv", pa.int64()), ("n", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, audit, own in _streams(batches):
            for n, (role, text) in enumerate(edited(audit, own)):
                out.append((conv, n, role, text))
                if len(out) >= 1024:
                    yield _batch(out, schema)
                    out = []
        yield _batch(out, schema)

    return _joined(rows, plans).mapInArrow(run, "conv bigint, n bigint, role string, text string")


def digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): hash of the repaired ``role:text`` lines, fed row by row."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, audit, own in _streams(batches):
            digest, gap = hashlib.sha256(), ""
            for role, text in edited(audit, own):
                digest.update(f"{gap}{role}:{text}".encode())
                gap = "\n"
            out.append((conv, digest.hexdigest()))
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return _joined(rows, plans).mapInArrow(run, "conv bigint, repaired_sha256 string")


def plan(rows: DataFrame, stage: Stage | None = None) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation in ``damaged`` form.

    Rows go by turn (nulls first), then role and text. Equal ids, a null id too, are one conversation; one whose rows are
    all dropped gives zeros and an empty audit. An empty table gives an empty result.
    """
    stage = stage or stage_for(rows.sparkSession, "repair")
    return stage(audits(stage(words(rows), "words")), "audits")


def repair_digests(conversations: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Damage, plan and repaired hash of every conversation of a table (conv_id, turn, role, text; others are not read).

    Ids and turns are integers. Null or empty roles and texts are ordinary values (a null is one blank); repeated rows are
    duplicates to be deleted. See ``plan`` for the other cases.
    """
    stage = stage or stage_for(conversations.sparkSession, "repair")
    rows = damaged(conversations)
    plans = plan(rows, stage)
    same: Column = F.col("p.conv").eqNullSafe(F.col("d.conv"))
    return plans.alias("p").join(digests(rows, plans).alias("d"), same).select(
        F.col("p.conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
