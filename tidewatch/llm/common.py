"""Shared helpers: staging in the shared folder, word hashing over Arrow batches, components of a link table."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ship_package
from tidewatch.sources.tables import Staging, read_raw, staging

#: Text bytes that one numpy step works on (a longer text is one step of its own).
STEP_BYTES = 1 << 20
#: The same for steps that take their texts out of a batch one after another; arrays of a step take some 40 bytes a text byte.
PART_BYTES = 1 << 18
Stage = Staging


def stage_for(spark: SparkSession, label: str) -> Stage:
    """A ``stage(df, name)`` hook into a new folder below ``spark.checkpoint.dir``; executors get the package."""
    ship_package(spark)
    return staging(spark, label)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it (in any case)."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_raw(spark, root, name)


# ---------------------------------------------------------------- words as 64-bit hashes

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_SPACE] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
ODD = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that sums of products become independent keys."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts.

    ``hashes``: one value per word; ``offsets``: word range of each text; ``starts``/``ends``: byte range of each word
    in the joined ``data``; ``text_at``: where each text begins in it.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        self.data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_at = np.concatenate(([0], np.cumsum(lengths)))
        space = _SPACE[self.data]
        before = np.concatenate(([True], space[:-1]))
        self.starts = np.flatnonzero(before & ~space)
        self.ends = np.flatnonzero(space & ~before)
        self.offsets = np.searchsorted(self.starts, self.text_at)
        if not len(self.starts):
            self.hashes = np.zeros(0, dtype=np.uint64)
            return
        size = self.ends - self.starts
        first = self.starts[0]
        run = np.diff(np.append(self.starts, len(self.data)))
        place = np.arange(first, len(self.data)) - np.repeat(self.starts, run)
        longest = int(size.max())
        power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(longest, _STEP))))
        value = (_BYTE_LOWER if lower else _BYTE)[self.data[first:]]
        value *= power[np.minimum(place, longest)]
        self.hashes = mix(np.add.reduceat(value, self.starts - first) ^ size.astype(np.uint64))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words (across text borders too; callers slice by offsets)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:count] * ODD[0]
    for j in range(1, n):
        out += words[j : j + count] * ODD[j]
    return mix(out)


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct n-word shingles; a shorter text is one shingle, a text without words none."""
    runs = ngrams(words.hashes, n)
    out = []
    for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            own = words.hashes[a:b]
            out.append(mix(np.array([np.sum(own * ODD[: b - a]) ^ np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def steps(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[slice]:
    """Row ranges whose texts together stay within the limit (one row at least)."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def text_steps(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[slice, list[bytes]]]:
    """Row ranges as ``steps`` has them, each with its texts; never more than one step's texts are taken out of the batch."""
    sizes = pc.binary_length(column.cast(pa.binary())).fill_null(0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > limit:
            yield slice(begin, i), bytes_of(column.slice(begin, i - begin))
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes)), bytes_of(column.slice(begin))


#: Dictionaries that last as long as a worker process.
_KEPT: list[dict] = []


def worker_cache() -> dict:
    """A dictionary for what tasks of one worker process share, such as a loaded vocabulary; ``let_go`` empties it."""
    _KEPT.append({})
    return _KEPT[-1]


def let_go() -> None:
    """Give back what earlier tasks of other operators left in this worker process, which Spark goes on using."""
    for held in _KEPT:
        held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # freed memory stays with the process else (glibc only)
    if trim is not None:
        trim(0)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from numpy arrays."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(offsets, pa.array(values, type=kind))


# ---------------------------------------------------------------- components of a link table


def components(links: DataFrame, stage: Stage, label: str) -> DataFrame:
    """(v, component) of every vertex of the undirected links (a, b): component is its smallest vertex.

    Alternating star contraction: every round is a minimum per vertex (combined before the shuffle) and a join, so a
    hub with a third of all links is never one group. Rounds go on until the link table no longer changes.
    """
    cur = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-0"
    )
    before = None
    for n in range(1, 200):
        mark = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            break
        before = mark
        both = cur.union(cur.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        far = both.where("v > u").join(low, "u").where("v <> m").select("v", "m").distinct().toDF("a", "b")
        least = far.groupBy("a").agg(F.min("b").alias("m"))
        near = far.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = near.union(least.select("a", F.col("m").alias("b"))).distinct()
        cur = stage(nxt, f"{label}-{n}")
        stage.drop(f"{label}-{n - 1}")
    roots = cur.select(F.col("b").alias("v")).distinct()
    return cur.select(F.col("a").alias("v"), F.col("b").alias("component")).union(
        roots.select("v", F.col("v").alias("component"))
    )


# ---------------------------------------------------------------- a filter of fixed size before a shuffle

FILTER_LOG = 24


def _bit(keys: np.ndarray, log: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) >> np.uint64(64 - log)).astype(np.int64)


def key_filter(keys: DataFrame, column: str, log: int = FILTER_LOG) -> bytes:
    """A bitmap of fixed size (2**log bits, 2 MB by default) of all 64-bit keys: lets every key through, and few others while
    it is sparse.

    It only spares a shuffle work; an exact join follows wherever it is used. Tasks set bits of their own keys, and words
    of the map are combined before they come together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << log) // 8, dtype=np.uint8)
        for batch in batches:
            at = _bit(batch.column(0).to_numpy(), log)
            np.bitwise_or.at(own, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        words = own.view(np.int64)
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], ["word", "bits"])

    ship_package(keys.sparkSession)
    found = keys.select(F.col(column).cast("bigint").alias("k")).where("k is not null").mapInArrow(run, "word bigint, bits bigint")
    got = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2**log / 64 rows
    words = np.zeros((1 << log) // 64, dtype=np.int64)
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return words.tobytes()


def key_hits(bitmap: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter lets through."""
    bits = np.frombuffer(bitmap, dtype=np.uint8)
    at = _bit(np.ascontiguousarray(keys), len(bits).bit_length() + 2)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def parted(rows: DataFrame, key: Column, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose 64-bit key may be among ``keys``, all other rows): a join for a few rows need not shuffle the others.

    ``key`` is never null. The first part has every row with one of the keys and few others, so a join must follow.
    """
    bits = rows.sparkSession.sparkContext.broadcast(key_filter(keys, column))

    @F.arrow_udf("boolean")
    def hit(k: pa.Array) -> pa.Array:
        return pa.array(key_hits(bits.value, k.to_numpy(zero_copy_only=False)))

    return rows.where(hit(key)), rows.where(~hit(key))
