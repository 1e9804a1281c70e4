"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import Words, _BYTE, _SPACE, _STEP, fresh, let_go, mix, ngrams, text_steps
from tidewatch.session import ship_package

BITS = 18
#: Labelled rows the model is fitted on at most: those with the smallest hash of their id.
TRAIN_ROWS = 6000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.4, 1.0, 0.02, 0.1
THRESHOLD = 0.7

_SAME = mix(np.array([0x53414D45], dtype=np.uint64))
_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = 97
_KIND[128:] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48


def _shapes(words: Words) -> np.ndarray:
    """One hash per word of its shape: letters, capitals, digits and signs with runs drawn together."""
    kind = _KIND[words.data]
    inside = ~_SPACE[words.data]
    first = np.zeros(len(kind), dtype=bool)
    first[words.starts] = True
    keep = np.flatnonzero(inside & (first | np.concatenate(([True], kind[1:] != kind[:-1]))))
    at = np.searchsorted(keep, words.starts)
    place = np.arange(len(keep)) - np.repeat(at, np.diff(np.append(at, len(keep))))
    power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(int(place.max()), _STEP))))
    return mix(np.add.reduceat(_BYTE[kind[keep]] * power[place], at) ^ np.uint64(0x5348415045))


def features(texts: list[bytes]) -> list[np.ndarray]:
    """Hashed features of each text, with repeats: words, word pairs, shapes, shape pairs, and "same word again"."""
    words = Words(texts, lower=False)
    if not len(words.hashes):
        return [np.zeros(0, dtype=np.int64) for _ in texts]
    h, s = words.hashes, _shapes(words)
    h2, s2 = ngrams(h, 2), ngrams(s, 2)
    out = []
    for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        again = int((h[a + 1 : b] == h[a : b - 1]).sum()) if b > a else 0
        parts = [h[a:b], h2[a : max(a, b - 1)], s[a:b], s2[a : max(a, b - 1)], np.repeat(_SAME, again)]
        out.append((np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64))
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """Sparse dot products: a feature's value is its count over the root of the number of features."""
        sums = np.array([self.weights[f].sum() / np.sqrt(len(f)) if len(f) else 0.0 for f in found], dtype=float)
        return 1.0 / (1.0 + np.exp(-np.clip(sums + self.bias, -40, 40)))


def fit(rows: Iterable[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> Model:
    """Follow the regularised leader, coordinate by coordinate, one row at a time in the order given.

    A row is kept as its distinct features (4 bytes each) and their counts (mostly 1 byte); values are made when it is met.
    """
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    packed = []
    for found, y in rows:
        at, count = np.unique(found, return_counts=True)
        small = np.min_scalar_type(int(count.max())) if len(count) else np.uint8
        packed.append((np.append(at, size).astype(np.int32), count.astype(small), np.sqrt(max(1, len(found))), y))

    def weight(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zz) <= L1, 0.0, w)

    for _ in range(epochs):
        for at, count, root, y in packed:
            x = np.append(count.astype(np.int64) / root, 1.0)
            w = weight(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -40, 40)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weight(np.arange(size + 1))
    return Model(w[:size].astype(np.float32), float(w[size]))


def held_out(id_col: str):
    """Rows never learned from: crc32 of the id as text is 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS
) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, chosen by a hash of their id.

    Rows without id or label are left out; an id labelled more than once takes the larger half of its labels, one with
    several documents brings each. Without any labelled row the model scores 0.5 throughout. Features are made by all
    tasks; only the bounded sample meets in the one task that fits it.
    """
    ship_package(docs.sparkSession)
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_y"))
        .where("_id is not null and _y is not null")
        .where(~held_out("_id"))
        .groupBy("_id")
        .agg((F.avg("_y") >= 0.5).cast("int").alias("_y"))
        .withColumn("_h", F.xxhash64("_id"))
        .orderBy("_h", "_id")
        .limit(rows)
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part, texts in text_steps(batch.column(1)):
                found = [f.astype(np.int32) for f in features(texts)]
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(2), pa.array(found, pa.list_(pa.int32()))], ["h", "y", "found"]
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        got = []
        for batch in batches:
            found = batch.column(2)
            got += [(h, y, np.asarray(f.values)) for h, y, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), found, strict=True)]
        # Features themselves decide the order only among rows alike in hash and length.
        alike = Counter((h, len(f)) for h, _, f in got)
        got.sort(key=lambda r: (r[0], len(r[2]), r[2].tobytes() if alike[r[0], len(r[2])] > 1 else b""))
        model = fit((f, y) for _, y, f in got)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    # The sample's ids have a fixed bound, so the text table is not shuffled for them.
    made = (
        docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .select("_h", "_text", "_y")
        .mapInArrow(make, "h bigint, y int, found array<int>")
    )
    row = made.repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The documents with one more column, the chance of label 1 for the whole text (null: as empty).

    All columns stay; one that is already named like the new one is replaced. Empty texts score by the bias alone.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast((model.weights, model.bias))  # 2**BITS numbers
    kept = [c for c in docs.columns if c != out]
    [own_text] = fresh(docs, "_text_")
    body = docs.select(F.col(text).alias(own_text), *[F.col(c) for c in kept])
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        own = Model(*sent.value)
        for batch in batches:
            got = [own.scores(features(texts)) for _, texts in text_steps(batch.column(0))]
            values = pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], values], [*kept, out])

    return body.mapInArrow(run, schema)
