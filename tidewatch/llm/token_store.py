"""Token ids as raw binary shards with a minimal perfect hash index for keyed access.

A store is a folder: ``manifest.json`` and, per shard, ``<n>.ids`` (little-endian unsigned ids of 16 bits where the
vocabulary allows it, else of 32; documents one after another in ascending id order), ``<n>.idx`` (the index) and ``<n>.keys`` (document ids in file order). The index
maps a key to (fingerprint, first id, number of ids) without storing keys: a few bit tests give the slot, the stored
fingerprint tells a foreign key. Shards cover ascending id ranges, so the manifest names the shard of an id.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import files
from tidewatch.llm.common import ODD, mix
from tidewatch.llm.word_ids import id_batches, id_limit
from tidewatch.session import ship_package

MAGIC = b"TWMPH001"
#: Bits per key of a level; more bits leave fewer keys for the next level.
GAMMA = 1.6
NULL_KEY = np.uint64(0x6E756C6C6E756C6C)


class PerfectHash:
    """Levels of bit arrays: a key takes the bit that no other key of its level wants; the bit's rank is its slot."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            ranks = base + np.cumsum(bits, dtype=np.int64) - bits
            self.ranks.append(ranks)
            base += int(bits.sum())
        self.size = base

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ mix(ODD[level % 32 : level % 32 + 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Distinct 64-bit keys -> slots 0..n-1."""
        levels, rest = [], keys
        while len(rest):
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
            size = max(8, int(len(rest) * GAMMA))
            at = cls._place(rest, len(levels), size)
            wanted = np.bincount(at, minlength=size)
            levels.append(wanted == 1)
            rest = rest[wanted[at] != 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot per key; a key that was not built in gets -1 or any slot (the fingerprint decides)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for n, bits in enumerate(self.levels):
            if not len(open_):
                break
            at = self._place(keys[open_], n, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.ranks[n][at[hit]]
            open_ = open_[~hit]
        return out


def _key(ids: np.ndarray, nulls: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The key of the nth row of a document id (rows may repeat)."""
    base = np.where(nulls, NULL_KEY, mix(ids.astype(np.int64).view(np.uint64)))
    return base + nth.astype(np.uint64) * ODD[63]


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ ODD[62]) >> np.uint64(32)).astype("<u4")


def pack_index(keys: np.ndarray, begin: np.ndarray, count: np.ndarray) -> bytes:
    """Index file: magic, number of levels and keys, level sizes, packed bits, then fingerprint, begin, count by slot."""
    hashed = PerfectHash.build(keys)
    order = np.argsort(hashed.slots(keys), kind="stable")
    sizes = np.array([len(b) for b in hashed.levels], dtype="<u8")
    parts = [MAGIC, np.array([len(sizes), len(keys)], dtype="<u8").tobytes(), sizes.tobytes()]
    parts += [np.packbits(b).tobytes() for b in hashed.levels]
    parts += [_fingerprint(keys)[order].tobytes(), begin[order].astype("<u8").tobytes(), count[order].astype("<u4").tobytes()]
    return b"".join(parts)


class Index:
    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not an index file")
        n_levels, n = (int(x) for x in np.frombuffer(raw, "<u8", 2, 8))
        sizes = np.frombuffer(raw, "<u8", n_levels, 24).astype(np.int64)
        at, levels = 24 + 8 * n_levels, []
        for size in sizes:
            took = (int(size) + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, took, at), count=int(size)).astype(bool))
            at += took
        self.hashed = PerfectHash(levels)
        self.fingerprints = np.frombuffer(raw, "<u4", n, at)
        self.begin = np.frombuffer(raw, "<u8", n, at + 4 * n)
        self.count = np.frombuffer(raw, "<u4", n, at + 12 * n)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, begin, count) per key, in constant time per key."""
        if not len(self.fingerprints):
            none = np.zeros(len(keys), dtype=np.int64)
            return none.astype(bool), none, none
        slots = self.hashed.slots(keys)
        safe = np.maximum(slots, 0)
        found = (slots >= 0) & (self.fingerprints[safe] == _fingerprint(keys))
        return found, np.where(found, self.begin[safe], 0), np.where(found, self.count[safe], 0)


def _nth(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """0, 1, 2.. within runs of equal ids (ids are sorted)."""
    if not len(ids):
        return np.zeros(0, dtype=np.int64)
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])))
    begin = np.flatnonzero(new)
    return np.arange(len(ids)) - np.repeat(begin, np.diff(np.append(begin, len(ids))))


def write_store(
    docs: DataFrame, base: str, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None
) -> list[dict]:
    """Encode every whole text, append the end id, write shards in ascending id order; returns the manifest.

    Null text counts as empty (its only id is the end id). Rows without an id come first; rows that repeat an id stay
    side by side, ordered by text, and are found one by one. An empty table gives a store without rows. Other columns
    are not read. A shard is written by one task in one pass, under a name of that attempt, and then moved into place.
    Texts are shuffled, not ids, so a range is sampled without encoding twice.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    encode = id_batches(vocabulary, end_id)
    width = 2 if id_limit(vocabulary, end_id) <= 1 << 16 else 4
    tie = F.xxhash64(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        ids, nulls, sizes = [], [], []

        def payload():
            for batch in batches:
                ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
                nulls.append(batch.column(0).is_null().to_numpy(zero_copy_only=False))
                for at in range(0, batch.num_rows, 256):
                    coded = encode(batch.column(1).slice(at, 256).to_pylist())
                    sizes.extend(len(c) // 4 for c in coded)
                    yield np.frombuffer(b"".join(coded), "<u4").astype(f"<u{width}").tobytes()

        parts = payload()
        first = next(parts, None)
        if first is None:
            return
        files.write_whole(base, f"{shard}.ids", chain([first], parts))
        own, null, size = np.concatenate(ids).astype(np.int64), np.concatenate(nulls).astype(bool), np.array(sizes, dtype=np.int64)
        begin = np.cumsum(size) - size
        files.write_whole(base, f"{shard}.idx", [pack_index(_key(own, null, _nth(own, null)), begin, size)])
        files.write_whole(base, f"{shard}.keys", [own.astype("<i8").tobytes(), null.astype(np.uint8).tobytes()])
        some = own[~null]
        row = {"shard": shard, "docs": len(own), "ids": int(size.sum()), "width": width, "nulls": int(null.sum())}
        row |= {"low": int(some[0]) if len(some) else None, "high": int(some[-1]) if len(some) else None}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, pa.int64()) for k in row]))

    ranged = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).repartitionByRange(n, "id", tie)
    schema = "shard bigint, docs bigint, ids bigint, width bigint, nulls bigint, low bigint, high bigint"
    found = ranged.sortWithinPartitions("id", tie, "text").mapInArrow(run, schema).collect()  # one row per shard
    manifest, start = [], 0
    for row in sorted((r.asDict() for r in found), key=lambda r: r["shard"]):
        manifest.append(row | {"start": start})
        start += row["ids"]
    files.write_whole(base, "manifest.json", [json.dumps(manifest).encode()])
    return manifest


def read_manifest(base: str) -> list[dict]:
    return json.loads(files.read_whole(base, "manifest.json"))


def read_store(spark: SparkSession, base: str) -> DataFrame:
    """Every document of a store, found through its index: (doc_id, start, n_tokens, ids_crc32, shard).

    One task per shard, which holds the shard's payload; the number of shards bounds it.
    """
    ship_package(spark)
    rows = [(r["shard"], r["start"], r["width"]) for r in read_manifest(base)]
    shards = spark.createDataFrame(rows, "shard bigint, start bigint, width bigint").repartition(max(1, len(rows)), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = files.read_whole(base, f"{row['shard']}.keys")
                n = len(raw) // 9
                ids, nulls = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
                found, begin, count = Index(files.read_whole(base, f"{row['shard']}.idx")).find(_key(ids, nulls, _nth(ids, nulls)))
                if not found.all():
                    raise ValueError(f"shard {row['shard']}: a key is missing in the index")
                payload = np.frombuffer(files.read_whole(base, f"{row['shard']}.ids"), f"<u{row['width']}")
                crc = [zlib.crc32(payload[b : b + c].astype("<u4")) for b, c in zip(begin.tolist(), count.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=nulls),
                        pa.array(row["start"] + begin.astype(np.int64)),
                        pa.array(count.astype(np.int64)),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(n, row["shard"], dtype=np.int64)),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                )

    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint")


class Reader:
    """Keyed access to a store: the manifest gives the shard, the index the place, one range read the ids."""

    def __init__(self, base: str):
        self.base, self.manifest, self.known = base, read_manifest(base), {}

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every row with this document id, in file order; an unknown id gives an empty list."""
        out = []
        for row in self.manifest:
            if doc_id is None and not row["nulls"] or doc_id is not None and not (row["low"] is not None and row["low"] <= doc_id <= row["high"]):
                continue
            shard = row["shard"]
            if shard not in self.known:
                self.known[shard] = Index(files.read_whole(self.base, f"{shard}.idx"))
            nth = 0
            while True:
                key = _key(np.array([doc_id or 0], dtype=np.int64), np.array([doc_id is None]), np.array([nth]))
                found, begin, count = self.known[shard].find(key)
                if not found[0]:
                    break
                wide = row["width"]
                raw = files.read_range(self.base, f"{shard}.ids", wide * int(begin[0]), wide * int(count[0]))
                out.append(np.frombuffer(raw, f"<u{wide}").astype("<u4"))
                nth += 1
        return out
