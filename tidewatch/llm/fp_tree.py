"""Ranked lexical search: documents as frequency-ordered term vectors in a prefix tree, searched by branch and bound.

Spark restricts every document to the terms of the query set and counts document frequencies over all documents. Each
task then puts its vectors, a bounded number at a time, into a prefix tree: terms stand in order of falling document
frequency, so vectors share their first steps and equal vectors share a leaf. A node knows the largest count of every
term below it and the least length factor; both together bound every score below it. The search goes down depth first with
the queries that the bound leaves, and only a leaf is scored exactly. Ten rows a query and task are all that is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import Stage, bytes_of, list_array, stage_for

#: Vectors of one tree, and vectors of one leaf: both bound a task's memory only.
TREE_VECTORS, LEAF_VECTORS = 4096, 48
#: Queries are taken in blocks of about so many bytes of text; each block is one pass over the documents.
BLOCK_BYTES = 1 << 20
#: Top lists of one query are merged in so many parts before the last merge.
MERGE_PARTS = 32

#: Everything below 0x80 except digits and letters parts terms; capitals A-Z become small.
_TERM_BYTES = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of UTF-8 text in order, repeats included."""
    return text.translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's score that depends on the document: grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ---------------------------------------------------------------- restricted vectors, in Spark


def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of every row with a term: its length, the query terms in it (places in ``vocabulary``), counts."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, counts = [], [], []
            for raw in bytes_of(batch.column(1)):
                words = terms_of(raw)
                held = Counter(filter(place.__contains__, words))
                lengths.append(len(words))
                terms.append(np.fromiter((place[w] for w in held), dtype=np.int32, count=len(held)))
                counts.append(np.fromiter(held.values(), dtype=np.int64, count=len(held)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), list_array(terms, pa.int32()), list_array(counts, pa.int64())],
                ["id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, tfs array<bigint>").where("n > 0")


def corpus_counts(held: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Number of documents with a term, all their terms, document frequency of each query term. Tasks add up their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    total = held.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    got = held.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_terms, dtype=np.int64)
    df[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return total["docs"], total["terms"] or 0, df


# ---------------------------------------------------------------- the tree of one task


@dataclass
class Node:
    """Vectors ``lo`` to ``hi`` of a tree; they agree in their first terms."""

    lo: int
    hi: int
    tf_max: np.ndarray
    m_min: int
    children: list[Node] = field(default_factory=list)


class Tree:
    """A prefix tree over vectors in the order of their term sequences: a node is a range of them.

    Unary chains are folded into their end. Equal vectors (terms, counts and m) are one, with all their ids.
    """

    def __init__(self, n_terms: int, vectors: list[tuple[bytes, bytes, int]], ids: list[list[int]]):
        order = sorted(range(len(vectors)), key=vectors.__getitem__)
        self.n_terms = n_terms
        self.ids = [ids[i] for i in order]
        keys = [vectors[i][0] for i in order]
        self.terms = [np.frombuffer(k, dtype=">u4").astype(np.int64) for k in keys]
        self.tfs = [np.frombuffer(vectors[i][1], dtype=np.int64) for i in order]
        self.m = np.array([vectors[i][2] for i in order], dtype=np.int64)
        self.root = self._node(0, len(keys), 0)

    def _node(self, lo: int, hi: int, depth: int) -> Node:
        first, last = self.terms[lo], self.terms[hi - 1]
        if hi - lo <= LEAF_VECTORS or (len(first) == len(last) and bool((first == last).all())):
            return self._leaf(lo, hi)
        short = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:short] != last[depth:short])
        depth = depth + int(differ[0]) if len(differ) else short
        # One term on: -1 stands for a vector that ends here.
        step = np.fromiter((t[depth] if len(t) > depth else -1 for t in self.terms[lo:hi]), dtype=np.int64, count=hi - lo)
        cuts = [lo, *(lo + 1 + np.flatnonzero(np.diff(step))).tolist(), hi]
        children: list[Node] = []
        begin = 0
        while begin < len(cuts) - 1:  # neighbours that are small together share a leaf
            end = begin + 1
            while end < len(cuts) - 1 and cuts[end + 1] - cuts[begin] <= LEAF_VECTORS:
                end += 1
            a, b = cuts[begin], cuts[end]
            children.append(self._node(a, b, depth + 1) if end == begin + 1 else self._leaf(a, b))
            begin = end
        best = np.maximum.reduce([c.tf_max for c in children])
        return Node(lo, hi, best, min(c.m_min for c in children), children)

    def _leaf(self, lo: int, hi: int) -> Node:
        best = np.zeros(self.n_terms, dtype=np.int64)
        for t, tf in zip(self.terms[lo:hi], self.tfs[lo:hi], strict=True):
            best[t] = np.maximum(best[t], tf)
        return Node(lo, hi, best, int(self.m[lo:hi].min()))


class Search:
    """The best ``top`` rows of every query so far, and the search of a tree for better ones."""

    def __init__(self, queries: list[np.ndarray], weights: np.ndarray, top: int):
        self.top = top
        self.n_terms = len(weights)
        self.sizes = np.array([len(q) for q in queries], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.flat = np.concatenate(queries) if queries else np.zeros(0, dtype=np.int64)
        self.flat_weight = weights[self.flat]
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in queries]  # (-score, id is null, id), ascending
        self.least = np.ones(len(queries), dtype=np.int64)  # a row must reach this

    def _scores(self, factor: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Scores of rows (their ``saturated`` values by term) for the active queries, none of them empty."""
        sizes = self.sizes[active]
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at = np.arange(sizes.sum()) + np.repeat(self.starts[active] - begin, sizes)
        return np.add.reduceat(factor[:, self.flat[at]] * self.flat_weight[at], begin, axis=1)

    def visit(self, tree: Tree) -> None:
        self._down(tree, tree.root, np.flatnonzero(self.sizes > 0))

    def _down(self, tree: Tree, node: Node, active: np.ndarray) -> None:
        stack = [(node, active)]
        while stack:
            node, active = stack.pop()
            if len(active):
                bound = self._scores(saturated(node.tf_max, np.int64(node.m_min))[None, :], active)[0]
                active = active[bound >= self.least[active]]
            if not len(active):
                continue
            if node.children:
                # The child with the longest counts last, so it is searched first and raises the limits.
                stack += [(c, active) for c in sorted(node.children, key=lambda c: int(c.tf_max.sum()))]
            else:
                self._leaf(tree, node, active)

    def _leaf(self, tree: Tree, node: Node, active: np.ndarray) -> None:
        for lo in range(node.lo, node.hi, LEAF_VECTORS):  # a leaf of equal term sequences may be longer
            hi = min(lo + LEAF_VECTORS, node.hi)
            factor = np.zeros((hi - lo, self.n_terms), dtype=np.int64)
            for k in range(lo, hi):
                factor[k - lo, tree.terms[k]] = saturated(tree.tfs[k], tree.m[k])
            scores = self._scores(factor, active)
            for column in np.flatnonzero((scores >= self.least[active]).any(axis=0)):
                query = int(active[column])
                rows = np.flatnonzero(scores[:, column] >= self.least[query])
                found = [(-int(scores[r, column]), i is None, i or 0) for r in rows for i in tree.ids[lo + r]]
                self.best[query] = sorted(self.best[query] + found)[: self.top]
                if len(self.best[query]) == self.top:
                    self.least[query] = max(1, -self.best[query][-1][0])


def _best_of(
    held: DataFrame, queries: list[np.ndarray], df: np.ndarray, n_docs: int, n_terms: int, top: int
) -> DataFrame:
    """(query, id, score): the best rows of every task."""
    # Places by falling document frequency: the order of terms in the tree.
    order = np.argsort(-df, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    weights = np.array([weight(n_docs, int(x)) for x in df[order]], dtype=np.int64)
    ranked = [rank[q] for q in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(ranked, weights, top)
        where: dict[tuple[bytes, bytes, int], int] = {}
        ids: list[list] = []

        def finish() -> None:
            if ids:
                search.visit(Tree(len(weights), list(where), ids))
                where.clear()
                ids.clear()

        for batch in batches:
            n = batch.column(1).to_numpy()
            m = 10 + (90 * n * n_docs) // n_terms
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            terms, tfs = rank[lists.values.to_numpy()], batch.column(3).values.to_numpy()
            for k, doc in enumerate(batch.column(0).to_pylist()):
                own = slice(ends[k], ends[k + 1])
                by = np.argsort(terms[own])
                key = (terms[own][by].astype(">u4").tobytes(), tfs[own][by].tobytes(), int(m[k]))
                at = where.setdefault(key, len(ids))
                if at == len(ids):
                    ids.append([doc])
                else:  # of equal rows only the first ``top`` ids can be among the best
                    same = ids[at]
                    same.append(doc)
                    if len(same) > 4 * top:
                        same.sort(key=lambda i: (i is None, i or 0))
                        del same[top:]
                if len(ids) >= TREE_VECTORS:
                    finish()
        finish()
        rows = [(q, None if null else i, -s) for q, best in enumerate(search.best) for s, null, i in best]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "id", "score"])

    return held.where(F.size("terms") > 0).mapInArrow(run, "query bigint, id bigint, score bigint")


# ---------------------------------------------------------------- the operator


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    top: int = 10,
    stage: Stage | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item, rank, id, score): the ``top`` best documents above 0 of each item; fewer where fewer have a common term.

    Ids are integers. Every row of ``docs`` is a document of its own, so repeated rows are counted and ranked each. Equal
    scores stand by ascending id, null ids last. Null or empty texts have no terms: such a document is not counted and such an
    item has no rows. Rows of ``items`` with one id are one item with all their terms; a null id is an item too. Empty
    tables give an empty result; other columns, whatever their names, are not read. Items are taken in blocks of about
    ``block_bytes`` of text, each one pass over all documents.
    """
    spark = docs.sparkSession
    stage = stage or stage_for(spark, "search")
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    parts = []
    for block in range(blocks):
        # At most about block_bytes of text come to the driver.
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        held: dict = {}
        for r in rows:
            held.setdefault(r["item"], set()).update(terms_of(r["text"].encode()))
        names = list(held)
        vocabulary = sorted(set().union(*held.values()))
        if not vocabulary:
            continue
        place = {t: i for i, t in enumerate(vocabulary)}
        queries = [np.array(sorted(place[t] for t in held[i]), dtype=np.int64) for i in names]
        own = stage(vectors(docs, vocabulary, id_col, text), f"vectors-{block}")
        n_docs, n_terms, df = corpus_counts(own, len(vocabulary))
        if not n_docs:
            continue
        best = _best_of(own, queries, df, n_docs, n_terms, top)
        items_of = spark.createDataFrame(list(enumerate(names)), asked.select(F.lit(0).cast("bigint").alias("query"), "item").schema)
        parts.append(_merged(stage(best, f"best-{block}"), top).join(F.broadcast(items_of), "query"))
    if not parts:
        kind = asked.schema["item"].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` bigint, score bigint")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _merged(best: DataFrame, top: int) -> DataFrame:
    """The best rows of each query with their rank: first within parts of the ids, then of all."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    part = F.pmod(F.xxhash64("id"), F.lit(MERGE_PARTS))
    some = best.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
    ranked = some.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).drop("part")
