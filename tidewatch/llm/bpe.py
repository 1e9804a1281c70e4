"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewatch.session import ship_package

#: Texts longer than this many code points are cut at safe places before they reach the library's pattern.
SAFE_CUT = 20_000
#: Places where no match of the pattern can reach across: white space begins, the last blank before a word begins, or
#: ASCII letters, digits and signs change (a sign before letters is no such place: it may be an apostrophe). Classes
#: are spelled out so that they do not hang on the Unicode version of a library.
_SAFE = regex.compile(
    r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{White_Space})(?=\p{White_Space}\P{White_Space})"
    r"|(?<=[A-Za-z])(?=[!-/0-9:-@\[-`{-~])|(?<=[0-9])(?=[!-/A-Za-z:-@\[-`{-~])|(?<=[!-/:-@\[-`{-~])(?=[0-9])"
)
_BLANK = regex.compile(r"\p{White_Space}+")


def safe_parts(text: str, limit: int = SAFE_CUT) -> Iterator[str]:
    """Consecutive parts of about ``limit`` code points whose separate encodings join to the encoding of the whole.

    A part is longer where no safe place comes (one run of letters, digits, signs or white space).
    """
    begin = 0
    while len(text) - begin > limit:
        # The look-behind needs the character before; a match at the very begin would give an empty part.
        found = _SAFE.search(text, begin + limit)
        if found is None:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


class ByteBpe:
    """Ranks from a file; ``encode`` gives ids, ``decode`` raw bytes."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        found: list[int] = []
        for part in safe_parts(text):
            if len(part) > SAFE_CUT and _BLANK.fullmatch(part):
                # One match: a long run of white space needs no pattern with look-ahead.
                found += self.library._encode_single_piece(part)
            else:
                found += self.library.encode_ordinary(part)
        return np.asarray(found, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.library.decode_bytes(ids.tolist())


_MADE: dict[tuple[str, str], ByteBpe] = {}


def bpe(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _MADE:
        _MADE[path, pattern] = ByteBpe(path, pattern)
    return _MADE[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text; null counts as empty; rows repeat as they come."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                ids = [model.encode(t or "").astype(np.int32) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    ship_package(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>").toDF(id_col, "ids")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids, and return digests: (id, n_tokens, ids_sha256, decoded_sha256).

    Null text counts as empty (no ids, digests of nothing). Every input row gives one row, repeated rows and rows
    without an id too; other columns are not read. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern)
        for batch in batches:
            counts, ids_sha, back_sha = [], [], []
            for t in batch.column(1).to_pylist():
                ids = model.encode(t or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back_sha.append(hashlib.sha256(model.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship_package(docs.sparkSession)
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
