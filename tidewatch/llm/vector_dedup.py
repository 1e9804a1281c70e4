"""Near-duplicate vectors by cosine: int8 tile products with rigorous error bounds, full precision only where needed.

Equal vectors are one vertex with a weight. Vertices are dealt to the nearest of a few pivots and cut into tiles. The angle
is a metric, so two tiles whose angles to some pivot lie further apart than the limit hold no link and are never
multiplied. A pair of tiles gives link counts per vertex and a spanning forest, never its list of pairs.

Tiles are files in the shared folder, written once; a task is told the names of its pairs and reads their tiles. Pairs of
tiles grow with the square of the rows, so vectors never travel with them.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import files
from tidewatch.llm.common import Stage, components, stage_for

THRESHOLD = 0.95
PIVOTS = 16
#: Numbers in a tile at most (rows x dimensions), which bounds what a task holds.
TILE = 1 << 18
#: Tile pairs a task gets on average.
PAIRS_PER_TASK = 6
#: Pairs are dealt in squares of at most this many tiles a side; a task holds two sides.
SIDE = 8
#: Squares come to be larger than one pair once there are this many.
SQUARES = 256
#: Room for rounding in single precision products and in angles.
SLACK = 2e-5
#: Products of int8 values stay exact in single precision up to this many dimensions.
EXACT_DIMS = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors -> (int8 codes, scale per vector, length of each vector's rounding error)."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error * (1 + 1e-9) + 1e-12


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class Tile:
    def __init__(self, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray):
        self.ids, self.weights, self.vectors = ids, weights, vectors
        codes, self.scale, self.error = quantise(unit_rows(vectors))
        self.codes = codes.astype(np.float32)  # int8 values; single precision multiplies them without loss


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row pairs in double precision, from the vectors as they are."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def link_tiles(a: Tile, b: Tile, same: bool, limit: float, step: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links per row of a, links per row of b, label per row of both): links weighted by copies, labels join what links.

    ``same``: both are one tile; only pairs above the diagonal count, for both ends.
    """
    m, n = len(a.ids), len(b.ids)
    to_a, to_b = np.zeros(m, dtype=np.int64), np.zeros(n, dtype=np.int64)
    label = np.arange(m if same else m + n)
    shift = 0 if same else m
    for at in range(0, m, step):
        rows = slice(at, min(m, at + step))
        dims = a.codes.shape[1]
        product = a.codes[rows, :EXACT_DIMS] @ b.codes[:, :EXACT_DIMS].T
        for d in range(EXACT_DIMS, dims, EXACT_DIMS):
            product = product.astype(np.float64) + a.codes[rows, d : d + EXACT_DIMS] @ b.codes[:, d : d + EXACT_DIMS].T
        product *= a.scale[rows, None].astype(product.dtype)
        worst = a.error[rows].max() + b.error.max() + a.error[rows].max() * b.error.max() + SLACK
        i, j = np.nonzero(product >= ((limit - worst) / b.scale).astype(product.dtype))
        if same:
            above = j > i + at
            i, j = i[above], j[above]
        if not len(i):
            continue
        near = product[i, j].astype(np.float64) * b.scale[j]
        i = i + at
        # x = q + e per vector, so |x.y - q.q'| <= |e||q'| + |q||e'| + |e||e'|, and |q| <= 1 + |e|.
        room = a.error[i] * (1 + b.error[j]) + b.error[j] * (1 + a.error[i]) + a.error[i] * b.error[j] + SLACK
        linked = near - room >= limit
        open_ = np.flatnonzero(~linked & (near + room >= limit))
        for part in np.array_split(open_, max(1, len(open_) * a.vectors.shape[1] // (1 << 21))):
            linked[part] = exact(a.vectors[i[part]], b.vectors[j[part]]) >= limit
        i, j = i[linked], j[linked]
        to_a += np.bincount(i, weights=b.weights[j], minlength=m).astype(np.int64)
        to_b += np.bincount(j, weights=a.weights[i], minlength=n).astype(np.int64)
        begins = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))[: len(i)]
        for lo, hi in zip(begins, [*begins[1:], len(i)][: len(begins)], strict=True):
            found = np.unique(np.append(label[j[lo:hi] + shift], label[i[lo]]))
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    return to_a, to_b, label


def _keyed(rows: DataFrame, kind: str) -> DataFrame:
    """Each row with a digest of its vector, its numbers as bytes (of numpy type ``kind``) and their count. All three are
    null where the vector cannot link: null, empty or zero vectors and those with null or non-finite parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0  # null becomes NaN, -0.0 becomes 0.0
            ends = np.cumsum(size)
            begins = ends - size
            per_row = lambda flags: np.concatenate(([0], np.cumsum(flags)))
            bad, some = per_row(~np.isfinite(x)), per_row(x != 0)
            ok = (bad[ends] == bad[begins]) & (some[ends] > some[begins])
            raw = x.astype(kind)
            spans = [(a, b) if fit else None for a, b, fit in zip(begins.tolist(), ends.tolist(), ok.tolist(), strict=True)]
            keys = [t and hashlib.blake2b(x[t[0] : t[1]].tobytes(), digest_size=16).digest() for t in spans]
            own = [t and raw[t[0] : t[1]].tobytes() for t in spans]
            dims = pa.array(size, pa.int32(), mask=~ok)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(own, pa.binary()), dims], ["id", "key", "vector", "dims"])

    return rows.mapInArrow(run, "id bigint, key binary, vector binary, dims int")


def _dealt(vertices: DataFrame, pivots: dict[int, np.ndarray], kind: str) -> DataFrame:
    """Add the cell: the nearest pivot of the vector's dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            raw = batch.column(2).to_pylist()
            cells = np.zeros(len(dims), dtype=np.int32)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                for part in np.array_split(own, max(1, len(own) * int(d) // (1 << 18))):
                    vectors = np.frombuffer(b"".join(raw[i] for i in part), kind).reshape(-1, d)
                    cells[part] = (unit_rows(vectors) @ pivots[int(d)].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"])

    return vertices.mapInArrow(run, "id bigint, weight bigint, vector binary, dims int, cell int")


def _tiles(cut: DataFrame, pivots: dict[int, np.ndarray], kind: str, base: str, tasks: int) -> DataFrame:
    """Write one file per tile; one row each: its name, and per pivot the least and largest angle."""
    schema = "tile_id string, dims int, low array<double>, high array<double>"
    names = ["dims", "cell", "tile"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key: tuple, rows: list) -> pa.RecordBatch:
            ids, weights, vectors = zip(*rows, strict=True)
            dims, name = key[0], "-".join(map(str, key))
            raw = b"".join(vectors)
            angles = np.arccos(np.clip(unit_rows(np.frombuffer(raw, kind).reshape(-1, dims)) @ pivots[dims].T, -1, 1))
            head = np.array([len(ids), dims, *ids, *weights], dtype="<i8")
            files.write_whole(base, name, [head.tobytes(), raw])
            low, high = [angles.min(axis=0).tolist()], [angles.max(axis=0).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([dims], pa.int32()), pa.array(low), pa.array(high)], ["tile_id", "dims", "low", "high"])

        held, rows = None, []
        for batch in batches:
            for *key, own, weight, vector in zip(*[batch.column(c).to_pylist() for c in (*names, "id", "weight", "vector")], strict=True):
                if key != held and rows:
                    yield made(tuple(held), rows)
                    rows = []
                held = key
                rows.append((own, weight, vector))
        if rows:
            yield made(tuple(held), rows)

    return cut.repartition(tasks, *names).sortWithinPartitions(*names, "id").mapInArrow(run, schema)


class TileFiles:
    """Tiles by name, the ones used last kept."""

    def __init__(self, base: str, kind: str, most: int):
        self.base, self.kind, self.most = base, kind, most
        self.held: OrderedDict[str, Tile] = OrderedDict()

    def __getitem__(self, name: str) -> Tile:
        if name not in self.held:
            while len(self.held) >= self.most:
                self.held.popitem(last=False)
            raw = files.read_whole(self.base, name)
            n, dims = np.frombuffer(raw, "<i8", 2).tolist()
            ids, weights = np.frombuffer(raw, "<i8", 2 * n, 16).reshape(2, n)
            self.held[name] = Tile(ids, weights, np.frombuffer(raw, self.kind, n * dims, 16 + 16 * n).reshape(n, dims))
        self.held.move_to_end(name)
        return self.held[name]


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", limit: float = THRESHOLD, pivots: int = PIVOTS, stage: Stage | None = None
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero, or hold null or non-finite parts link with nothing, as do rows without an id
    (component null, not kept) and vectors of different lengths. Rows that share an id count as copies of one vector
    each. The pivots are a bounded sample (``pivots`` per dimension, smallest hash first); they steer which tiles are
    multiplied, never which links are found. Other columns are not read; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    stage = stage or stage_for(spark, "vectors")
    element = rows.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    read = _keyed(rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")), kind)
    keyed = stage(read.select("id", "key"), "keyed")
    plain = stage(
        read.where("key is not null and id is not null")
        .groupBy("key")
        .agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.min("vector").alias("vector"), F.min("dims").alias("dims"))
        .select("id", "weight", "vector", "dims"),
        "vertices",
    )
    stage.drop()  # the vectors' shuffle files
    chosen: dict[int, np.ndarray] = {}
    dims = [r["dims"] for r in plain.select("dims").distinct().collect()]  # the lengths that occur
    for d in dims:
        sample = plain.where(F.col("dims") == d).select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(pivots).collect()
        chosen[d] = unit_rows(np.array([np.frombuffer(r["vector"], kind) for r in sample]))
    dealt = _dealt(plain, chosen, kind)
    per_tile = F.greatest(F.lit(64), F.floor(F.lit(TILE) / F.col("dims")))
    # A cell table has at most ``pivots`` rows per vector length.
    counts = stage(dealt.groupBy("dims", "cell").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / per_tile)), "cells")
    n_tiles = counts.agg(F.sum("parts")).first()[0] or 0
    cut = dealt.join(F.broadcast(counts.select("dims", "cell", "parts")), ["dims", "cell"])
    cut = cut.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts")
    base = os.path.join(stage.base, "tile-files")
    bounds = stage(_tiles(cut, chosen, kind, base, max(1, -(-n_tiles // 2))), "tiles")
    stage.drop("vertices")
    angle = float(np.arccos(limit)) + 1e-6
    left = bounds.select(*[F.col(c).alias(f"l_{c}") for c in bounds.columns])
    right = bounds.select(*[F.col(c).alias(f"r_{c}") for c in bounds.columns])
    apart = F.exists(
        F.zip_with(
            F.zip_with("l_low", "r_high", lambda x, y: x - y), F.zip_with("r_low", "l_high", lambda x, y: x - y), lambda x, y: F.greatest(x, y)
        ),
        lambda gap: gap > angle,
    )
    pairs = stage(
        left.join(right, (F.col("l_dims") == F.col("r_dims")) & (F.col("l_tile_id") <= F.col("r_tile_id")))
        .where(~apart)
        .select(F.col("l_tile_id").alias("a"), F.col("r_tile_id").alias("b")),
        "tile-pairs",
    )
    n_pairs = pairs.count()
    side = max(1, min(SIDE, math.isqrt(n_pairs // SQUARES)))
    # Squares by number: the tiles of a cell lie side by side.
    numbers = bounds.select("tile_id").orderBy("tile_id").collect()  # one short row per tile
    square = spark.createDataFrame([(r["tile_id"], i // side) for i, r in enumerate(numbers)], "tile_id string, n bigint")
    work = (
        pairs.join(square.toDF("a", "x"), "a")
        .join(square.toDF("b", "y"), "b")
        .select("x", "y", "a", "b")
        .repartition(-(-max(1, n_pairs) // max(PAIRS_PER_TASK, side * side)), "x", "y")
        .sortWithinPartitions("x", "y", "a", "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = TileFiles(base, kind, 2 * side)
        for batch in batches:
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                left, right = tiles[a], tiles[b]
                same = a == b
                to_a, to_b, label = link_tiles(left, right, same, limit)
                ids = left.ids if same else np.concatenate([left.ids, right.ids])
                links = to_a + to_b if same else np.concatenate([to_a, to_b])
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some]), pa.array(ids[label[some]])], ["id", "links", "other"]
                )

    linked = stage(work.mapInArrow(run, "id bigint, links bigint, other bigint"), "linked")
    stage.drop("tile-files")
    sums = linked.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(linked.select(F.col("id").alias("a"), F.col("other").alias("b")), stage, "groups")
    vertices = keyed.where("key is not null and id is not null").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    found = (
        vertices.join(sums, "id", "left")
        .join(groups.withColumnRenamed("v", "id"), "id", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    )
    out = keyed.select("id", F.when(F.col("id").isNotNull(), F.col("key")).alias("key")).join(found, "key", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("c", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("c", "id"), F.lit(False)).alias("kept"),
    )
