"""Packing of token documents into fixed windows by non-negative least squares over length combinations.

A document is cut into whole windows and one rest. The lengths of all pieces form a histogram of at most
``window / unit`` bins, the only thing that leaves Spark. On it, combinations of up to ``depth`` bins that fill a window are
enumerated, their repeat counts are solved by non-negative least squares, rounded down, and what stays is packed
greedily. The plan (a few thousand rows, whatever the corpus) is joined back by (bin, rank within the bin).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import Stage, stage_for
from tidewatch.llm.word_ids import id_batches
from tidewatch.session import ship_package

WINDOW, UNIT, DEPTH = 2048, 8, 4
#: The solver stops when this share of the histogram (as a norm) is left; the greedy step takes what stays.
CLOSE = 0.005
#: Columns that may enter the solution in one round.
ENTER = 16
PLAN = "bin bigint, low bigint, high bigint, sequence bigint, slot bigint"


# ---------------------------------------------------------------- the plan, on the histogram alone


def combinations(bins: int, depth: int) -> np.ndarray:
    """All multisets of at most ``depth`` bins (1..bins) that sum to ``bins``; rows are padded with 0."""
    done, open_ = [], [(np.zeros((1, 0), dtype=np.int16), np.array([bins]))]
    for level in range(depth):
        rows, left = open_[-1]
        top = rows[:, -1].astype(np.int64) if level else np.array([bins])
        last = left <= top  # the rest itself closes the row
        closed = np.column_stack([rows[last], left[last].astype(np.int16)])
        done.append(np.pad(closed, ((0, 0), (0, depth - closed.shape[1]))))
        if level + 1 == depth:
            break
        # Parts stand in descending order: the next one is at most the one before and leaves something.
        most = np.minimum(top, left - 1)
        least = -(-left // (depth - level))
        count = np.maximum(most - least + 1, 0)
        at = np.repeat(np.arange(len(rows)), count)
        part = np.repeat(least, count) + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        open_.append((np.column_stack([rows[at], part.astype(np.int16)]), left[at] - part))
    return np.concatenate(done)


def solve_counts(columns: np.ndarray, counts: np.ndarray, rounds: int | None = None) -> dict[int, float]:
    """Active-set non-negative least squares: repeat counts x >= 0 that minimise |A x - counts|.

    ``columns`` are rows of ``combinations``; the matrix is never built. Returns {column: x} of the positive ones.
    """
    bins = len(counts) - 1
    target = counts[1:].astype(float)
    scale = max(1.0, float(np.linalg.norm(target)))
    active: list[int] = []
    used = np.zeros((bins, 0))  # the active columns as vectors over the bins
    x = np.zeros(0)
    for _ in range(rounds or bins // 2):
        rest = target - used @ x
        gain = np.concatenate(([0.0], rest))[columns].sum(axis=1)
        gain[active] = -np.inf
        # Several columns enter at once, as long as they share no bin.
        entering, taken = [], np.zeros(bins + 1, dtype=bool)
        for c in np.argsort(-gain, kind="stable")[:ENTER * 8].tolist():
            parts = columns[c][columns[c] > 0]
            if gain[c] > 1e-9 * scale and not taken[parts].any():
                entering.append(c)
                taken[parts] = True
        entering = entering[:ENTER]
        if np.linalg.norm(rest) <= CLOSE * scale or not entering:
            break
        added = np.column_stack([np.bincount(columns[c], minlength=bins + 1)[1:] for c in entering]).astype(float)
        active += entering
        used, x = np.column_stack([used, added]), np.append(x, np.zeros(len(entering)))
        while active:
            z = np.linalg.solve(used.T @ used + 1e-9 * np.eye(len(active)), used.T @ target)
            low = z <= 1e-12 * scale
            if not low.any():
                x = z
                break
            fall = low & (x > z)
            step = float(np.min(x[fall] / (x[fall] - z[fall]))) if fall.any() else 0.0
            x = np.maximum(x + step * (z - x), 0.0)
            keep = ~(low & (x <= 1e-9 * scale))
            if keep.all():
                keep[np.flatnonzero(low)[x[low].argmin()]] = False
            active = [a for a, k in zip(active, keep, strict=True) if k]
            used, x = used[:, keep], x[keep]
    return dict(zip(active, x.tolist(), strict=True))


def make_plan(counts: np.ndarray, depth: int = DEPTH) -> list[tuple[int, int, int, int, int]]:
    """Rows (bin, low, high, sequence, slot): the pieces of ``bin`` with ranks low..high-1 take ``slot`` of the sequences
    sequence, sequence + 1, ..; every piece has exactly one place. ``counts[b]`` pieces have bin b."""
    bins = len(counts) - 1
    left, used = counts.astype(np.int64).copy(), np.zeros(bins + 1, dtype=np.int64)
    plan, sequence = [], 0

    def place(parts: np.ndarray, repeat: int) -> None:
        nonlocal sequence
        for slot, b in enumerate(parts):
            # Equal parts of a pattern take ranges one after another.
            plan.append((int(b), int(used[b]), int(used[b]) + repeat, sequence, slot))
            used[b] += repeat
            left[b] -= repeat
        sequence += repeat

    def room(parts: np.ndarray) -> int:
        kinds, times = np.unique(parts, return_counts=True)
        return int((left[kinds] // times).min())

    if left.sum():
        columns = combinations(bins, depth)
        columns = columns[(counts[columns] > 0).astype(bool).all(axis=1, where=columns > 0)]
        solved = solve_counts(columns, left) if len(columns) else {}
        for c, x in sorted(solved.items(), key=lambda kv: (-kv[1], kv[0])):
            parts = columns[c][columns[c] > 0]
            if (repeat := min(int(x + 1e-6), room(parts))) > 0:
                place(parts, repeat)
    while left.any():
        # Greedy: the longest piece, then always the longest that still fits; repeated as often as the bins allow.
        taken, free, have = [], bins, left.copy()
        while free and (fit := np.flatnonzero(have[: free + 1])).size:
            b = int(fit[-1])
            taken.append(b)
            have[b] -= 1
            free -= b
        parts = np.array(taken)
        place(parts, room(parts))
    return plan


# ---------------------------------------------------------------- pieces and their places


def cut(docs: DataFrame, vocabulary: str, end_id: int, window: int, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): every text's ids and the end id, cut at whole windows."""
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    encode = id_batches(vocabulary, end_id)
    step = 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                coded = encode(part.column(1).to_pylist())
                which = [i for i, ids in enumerate(coded) for _ in range(0, len(ids), step)]
                begin = [b for ids in coded for b in range(0, len(ids), step)]
                pieces = [memoryview(coded[i])[b : b + step] for i, b in zip(which, begin, strict=True)]
                columns = [
                    part.column(0).take(pa.array(which, pa.int64())),
                    pa.array([b // 4 for b in begin], pa.int64()),
                    pa.array([len(p) // 4 for p in pieces], pa.int64()),
                    pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                    pa.array([len(coded[i]) // 4 for i in which], pa.int64()),
                ]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.array([bytes(p) for p in pieces], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * keep_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def place(pieces: DataFrame, stage: Stage, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> DataFrame:
    """Add (sequence_id, offset) to pieces with a ``length`` of 1..window; other columns stay as they are.

    Lengths count in units, rounded up, so that what the plan puts together fits; offsets are exact. Ranks within a bin are
    taken in salted buckets with the counts of the buckets before added, so a length that a third of all pieces share is
    many groups. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    salts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [c for c in pieces.columns if pieces.schema[c].dataType.typeName() not in ("binary", "array", "map", "struct")]
    marked = pieces.withColumn("_bin", F.ceil(F.col("length") / unit)).withColumn(
        "_salt", F.pmod(F.xxhash64(*keys), F.lit(salts))
    )
    sizes = marked.groupBy("_bin", "_salt").agg(F.count("*").alias("_n")).collect()  # bins x salts at most
    counts = np.zeros(window // unit + 1, dtype=np.int64)
    before = []
    for r in sorted(sizes, key=lambda r: (r["_bin"], r["_salt"])):
        before.append((r["_bin"], r["_salt"], int(counts[r["_bin"]])))
        counts[r["_bin"]] += r["_n"]
    plan = spark.createDataFrame(make_plan(counts, depth), PLAN)
    first = spark.createDataFrame(before, "_bin bigint, _salt bigint, _before bigint")
    rank = F.row_number().over(Window.partitionBy("_bin", "_salt").orderBy(*keys)) - 1
    ranked = marked.withColumn("_rank", rank).join(F.broadcast(first), ["_bin", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_salt")
    # Both tables have a fixed bound: bins x salts rows, and a few rows per bin.
    placed = ranked.join(
        F.broadcast(plan), (F.col("_bin") == F.col("bin")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    ).withColumn("sequence_id", F.col("sequence") + F.col("_rank") - F.col("low"))
    within = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.sum("length").over(within) - F.col("length")
    return placed.withColumn("offset", offset).select(*pieces.columns, "sequence_id", "offset")


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
    stage: Stage | None = None,
) -> DataFrame:
    """Pack all documents: one row per piece (id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset).

    Null text counts as empty: its one id is the end id. Every input row is a document of its own, repeated rows and rows
    without an id too. ``keep_ids`` keeps each piece's ids as little-endian unsigned 32-bit integers, the input of
    ``sequences``. Pieces are stored once, so the plan and the join see the same rows.
    """
    stage = stage or stage_for(docs.sparkSession, "packing")
    return place(stage(cut(docs, vocabulary, end_id, window, id_col, text_col, keep_ids), "pieces"), stage, window)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids array<int> of ``window`` ids, used, pieces) of ``pack(keep_ids=True)``: the training rows.

    A sequence whose filled length is a power of two keeps that length. Each group is one window, so it is bounded.
    """
    ship_package(packed.sparkSession)
    piece = F.struct("offset", F.col(id_col).alias("id"), "start", "length", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for payloads in batch.column(1).to_pylist():
                ids = np.frombuffer(b"".join(payloads), "<u4").astype(np.int32)
                short = 0 if len(ids) & (len(ids) - 1) == 0 else window - len(ids)
                rows.append(np.concatenate([ids, np.full(short, pad_id, dtype=np.int32)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.int32())), batch.column(2)], ["sequence_id", "ids", "used"]
            )

    flat = grouped.select("sequence_id", F.col("p.ids").alias("ids"), F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("used"))
    return flat.mapInArrow(run, "sequence_id bigint, ids array<int>, used bigint")
