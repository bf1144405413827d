"""Ranked lexical search with a document FP-tree and branch and bound.

Documents are cut down to the terms that some item asks for. A document's terms are put in
order of document frequency, rarest first, and documents with the same first terms
share a path of the tree: a node stands for the documents below it. Rarest first, so that a path
soon rules out all rarer terms that are not on it. Each node knows, for every
term, the largest tf below it, and the least m; together they bound the score of
all its documents for an item. The search goes depth first, best child first,
and leaves out every subtree whose bound is below the item's 50th score so far.

Each task builds one tree after another over bounded batches of documents and
carries the best scores of its items from tree to tree. The best of all
tasks meet in a window that Spark limits before its shuffle.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.llm.common import as_bytes, col, released, stage

#: Distinct terms of the items of one block, about; every block searches all documents.
BLOCK_TERMS = 5_000
#: Documents of one tree, term entries of one tree, and documents below which a node is not divided.
TREE_DOCS, TREE_ENTRIES, LEAF_DOCS = 4096, 1_000_000, 16
#: A-Z in lower case; every ASCII byte that is no letter or digit as a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


Item = tuple[int, list[bytes]]


def item_blocks(items: DataFrame, text_col: str, block_terms: int) -> Iterator[list[Item]]:
    """The items that have terms, as number and distinct terms, in blocks.

    The items are the stated query set of this operator; they pass through the driver one by one.
    """
    block: list[Item] = []
    held: set[bytes] = set()
    for row in items.select("item", col(text_col).cast("binary").alias("text")).filter("text is not null").toLocalIterator():
        terms = sorted(set(terms_of(bytes(row["text"]))))
        if block and len(held.union(terms)) > block_terms:
            yield block
            block, held = [], set()
        if terms:
            block.append((row["item"], terms))
            held.update(terms)
    if block:
        yield block


def restricted(docs: DataFrame, places: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` (terms with repeats), ``terms`` (their places in the block's list of terms) and ``tfs`` of every row."""
    slim = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    fields = [T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([slim.schema.fields[0], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = places.value.get
        for batch in batches:
            sizes, found, times, ends = [], [], [], [0]
            for text in as_bytes(batch.column(1)):
                words = terms_of(text)
                sizes.append(len(words))
                own = np.array([p for p in map(known, words) if p is not None], np.int32)
                own, tfs = np.unique(own, return_counts=True)
                found.append(own)
                times.append(tfs.astype(np.int32))
                ends.append(ends[-1] + len(own))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*x, np.zeros(0, np.int32)]))) for x in (found, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=schema.names)

    return slim.mapInArrow(released(run), schema)


class Tree:
    """FP-tree of documents given as vectors of (rank of term, tf), rarest first.

    Documents are sorted by their vectors, so a subtree is a range of them. Paths without a branch
    are one step. Nodes of fewer than ``LEAF_DOCS`` documents are leaves. Column t
    of ``most`` holds the largest tf of term ``terms[t]`` below each node, ``least`` the least m.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], m: np.ndarray, leaf: int):
        keys = [ranks.astype(">u4").tobytes() for ranks, _ in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=keys.__getitem__), np.int64)
        vectors, keys = [vectors[i] for i in self.order], [keys[i] for i in self.order]
        self.m = m[self.order]
        lengths = np.array([len(r) for r, _ in vectors], np.int64)
        self.edges = np.concatenate(([0], np.cumsum(lengths)))
        none = np.zeros(0, np.int64)
        self.terms, self.ranks = np.unique(np.concatenate([none, *(r for r, _ in vectors)]), return_inverse=True)
        tfs = np.concatenate([none, *(t for _, t in vectors)]).astype(np.int64)
        self.parts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * np.repeat(self.m, lengths))
        self._grow(self._shared(), leaf)
        self.most = np.zeros((len(self.first), len(self.terms)), np.int32)
        self.least = np.zeros(len(self.first), np.int64)
        for node in range(len(self.first) - 1, -1, -1):  # children come after their parent
            if self.children[node]:
                self.most[node] = self.most[self.children[node]].max(axis=0)
                self.least[node] = self.least[self.children[node]].min()
            else:
                first, last = self.first[node], self.last[node]
                at = slice(self.edges[first], self.edges[last])
                np.maximum.at(self.most[node], self.ranks[at], tfs[at])
                self.least[node] = self.m[first:last].min()

    def _shared(self) -> np.ndarray:
        """Terms that each document's path shares with that of the one before it."""
        n = len(self.order)
        shared = np.zeros(n, np.int64)
        for i in range(1, n):
            a = self.ranks[self.edges[i - 1]:self.edges[i]]
            b = self.ranks[self.edges[i]:self.edges[i + 1]]
            k = min(len(a), len(b))
            apart = np.flatnonzero(a[:k] != b[:k])
            shared[i] = apart[0] if len(apart) else k
        return shared

    def _grow(self, shared: np.ndarray, leaf: int) -> None:
        """Nodes from the root down; a node divides where its documents share least."""
        self.first, self.last, self.children = [0], [len(shared)], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            first, last = self.first[node], self.last[node]
            inner = shared[first + 1:last]
            if last - first < max(2, leaf) or inner.min() == self._length(first, last):  # few, or all the same path
                continue
            cuts = [first, *(np.flatnonzero(inner == inner.min()) + first + 1).tolist(), last]
            for a, b in zip(cuts, cuts[1:]):
                self.children[node].append(len(self.first))
                todo.append(len(self.first))
                self.first.append(a)
                self.last.append(b)
                self.children.append([])

    def _length(self, first: int, last: int) -> int:
        return int((self.edges[first + 1:last + 1] - self.edges[first:last]).max())

    def bounds(self, columns: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document below a node scores more for these terms."""
        tf = self.most[:, columns].astype(np.float64)
        return ((1e9 * tf) / (1000 * tf + 20 * self.least[:, None])) @ weights + 1

    def scores(self, first: int, last: int, weight: np.ndarray) -> np.ndarray:
        """Exact scores of the documents ``first`` to ``last``; ``weight`` by column."""
        a, b = self.edges[first], self.edges[last]
        sums = np.concatenate(([0], np.cumsum(weight[self.ranks[a:b]] * self.parts[a:b])))
        return sums[self.edges[first + 1:last + 1] - a] - sums[self.edges[first:last] - a]


class Best:
    """The highest scores of one item so far; equal scores by ascending id, null ids last."""

    def __init__(self, k: int):
        self.k, self.heap, self.met = k, [], 0

    def room(self) -> int:
        """A score below this can't enter."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc) -> None:
        self.met += 1  # repeated rows are told apart by the order in which they come
        entry = (score, doc is not None, -doc if doc is not None else 0, -self.met)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


def descend(tree: Tree, ids: list, columns: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Depth-first branch and bound for one item; the number of documents that were scored."""
    bounds = tree.bounds(columns, weights.astype(np.float64))
    weight = np.zeros(len(tree.terms), np.int64)
    weight[columns] = weights
    todo, scored = [0], 0
    while todo:
        node = todo.pop()
        if bounds[node] < best.room():
            continue
        below = tree.children[node]
        if below:
            below = np.array(below)
            below = below[bounds[below] >= best.room()]
            todo.extend(below[np.argsort(bounds[below], kind="stable")].tolist())  # the best is taken next
            continue
        first, last = tree.first[node], tree.last[node]
        found = tree.scores(first, last, weight)
        scored += last - first
        for i in np.flatnonzero(found >= best.room()).tolist():
            best.add(int(found[i]), ids[tree.order[first + i]])
    return scored


def _searched(vectors: DataFrame, n_docs: int, n_terms: int, asked: Broadcast, k: int, id_type: T.DataType) -> DataFrame:
    """``item``, ``doc`` and ``score``: the ``k`` best of each task for each item.

    ``asked`` holds the order of the block's terms (rank by place), their weights (by rank) and the items as ranks.
    """
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc", id_type), T.StructField("score", T.LongType())])

    def trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[tuple[Tree, list]]:
        vectors, m, ids, held = [], [], [], 0
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            terms, tfs = (c.flatten().to_numpy() for c in batch.columns[2:])
            ends = np.concatenate(([0], np.cumsum(batch.column(2).value_lengths().to_numpy())))
            for i, name in enumerate(names):
                own, times = rank[terms[ends[i]:ends[i + 1]]], tfs[ends[i]:ends[i + 1]]
                rare_first = np.argsort(own)
                vectors.append((own[rare_first].astype(np.int64), times[rare_first]))
                m.append(50 + 50 * int(sizes[i]) * n_docs // n_terms)
                ids.append(name)
                held += len(own)
                if len(ids) == TREE_DOCS or held >= TREE_ENTRIES:
                    yield Tree(vectors, np.array(m, np.int64), LEAF_DOCS), ids
                    vectors, m, ids, held = [], [], [], 0
        if ids:
            yield Tree(vectors, np.array(m, np.int64), LEAF_DOCS), ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, weights, items = asked.value
        best = [Best(k) for _ in items]
        for tree, ids in trees(batches, rank):
            for (_, ranks), found in zip(items, best):
                at = np.minimum(np.searchsorted(tree.terms, ranks), max(0, len(tree.terms) - 1))
                own = tree.terms[at] == ranks if len(tree.terms) else np.zeros(len(ranks), bool)
                if own.any():
                    descend(tree, ids, at[own], weights[ranks[own]], found)
        rows = [(item, -entry[2] if entry[1] else None, entry[0]) for (item, _), found in zip(items, best) for entry in found.heap]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()).cast(kind), pa.array(columns[2], pa.int64())], names=schema.names)

    kind = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[id_type.simpleString()]
    return vectors.mapInArrow(released(run), schema)


def _block_best(docs: DataFrame, block: list[Item], k: int, id_col: str, text_col: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    terms = sorted({t for _, own in block for t in own})
    place = {t: i for i, t in enumerate(terms)}
    vectors = stage(restricted(docs, context.broadcast(place), id_col, text_col))
    n_docs, n_terms = vectors.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(terms), np.int64)
    for row in counts.collect():  # one row for each term of the block at most
        df[row["term"]] = row["df"]
    order = np.argsort(df, kind="stable")
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df[order]], np.int64)
    items = [(item, np.sort(rank[[place[t] for t in own]])) for item, own in block]
    return _searched(vectors.filter(F.size("terms") > 0), n_docs, max(1, n_terms), context.broadcast((rank, weights, items)), k, vectors.schema["id"].dataType)


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of ``items``, the ``k`` highest-scoring rows of ``docs`` with a score above 0:
    the item's id, ``rank`` from 1, the document's id and ``score``.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case. Null, empty and
    term-less texts have none: such items get no rows, such documents count nowhere. Equal scores go by ascending
    id (whole numbers), null ids last. Repeated rows of ``docs`` are ranked each; repeated rows
    of ``items`` get results each. Empty tables: no rows. Other columns are ignored.

    Memory: a task holds one tree of at most ``TREE_DOCS`` documents and ``k`` scores for each item of a block.
    """
    named = stage(items.select(F.monotonically_increasing_id().alias("item"), col(item_col).alias("item_id"), col(item_text_col).alias("text")))
    found: DataFrame | None = None
    for block in item_blocks(named, "text", block_terms):
        best = stage(_block_best(docs, block, k, id_col, text_col))
        found = best if found is None else found.union(best)
    if found is None:
        found = docs.select(F.lit(0).cast("long").alias("item"), col(id_col).alias("doc"), F.lit(0).cast("long").alias("score")).limit(0)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.join(named.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
