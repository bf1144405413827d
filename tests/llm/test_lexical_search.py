import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import SF, lower
from conftest import EDGE

from abode.llm import lexical_search, queries

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=50):
    """Every item against every document; ids of documents and scores, best first."""
    bags = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        rows = []
        for i, bag in bags:
            n = sum(bag.values())
            if not n:
                continue
            m = 50 + 50 * n * n_docs // n_terms
            score = 0
            for t in set(TERM.findall(lower(text or ""))):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * bag[t] // (1000 * bag[t] + 20 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, rank, None if r[1] else r[2], -r[0]) for rank, r in enumerate(sorted(rows)[:k], 1)]
    return out


def as_rows(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert as_rows(queries.op12_lexical_search(spark, SF)) == sorted(plain_search(docs, items), key=str)


@pytest.mark.parametrize("tree_docs, leaf, block, k", [(8192, 16, 20_000, 50), (64, 2, 30, 3), (7, 1, 1, 10)])
def test_trees_and_blocks(spark, monkeypatch, tree_docs, leaf, block, k):
    monkeypatch.setattr(lexical_search, "TREE_DOCS", tree_docs)
    monkeypatch.setattr(lexical_search, "LEAF_DOCS", leaf)
    rnd = random.Random(k)
    words = [f"w{int(rnd.paretovariate(0.5))}" for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    docs = [(i, say(rnd.randrange(0, 60))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(70)] + [(2000 + i, docs[i][1] + " extra") for i in range(30)]
    rnd.shuffle(docs)
    items = [(i, say(rnd.randrange(1, 25))) for i in range(12)] + [(12, "absent"), (13, docs[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lexical_search.search(frame, spark.createDataFrame(items, "item_id long, text string"), k=k, block_terms=block)
    assert as_rows(got) == sorted(plain_search(docs, items, k), key=str)


def test_subtrees_are_left_out():
    """Bounds hold for every node, and the search scores a part of the documents only."""
    rnd = random.Random(4)
    vectors = []
    for i in range(2000):
        ranks = np.unique(np.array([min(199, int(200 / rnd.paretovariate(1))) for _ in range(20)] + [rnd.randrange(200)]))
        vectors.append((ranks, np.array([rnd.choice([1, 1, 2, 5]) for _ in ranks])))
    tree = lexical_search.Tree(vectors, np.array([rnd.randrange(50, 200) for _ in vectors]), 8)
    weights = np.linspace(7000, 100, 200).astype(np.int64)
    columns = np.array([3, 50, 120, 199])
    columns = columns[np.isin(columns, tree.terms)]
    weight = np.zeros(len(tree.terms), np.int64)
    weight[columns] = weights[columns]
    bounds = tree.bounds(columns, weights[columns].astype(float))
    for node in range(len(tree.first)):
        assert tree.scores(tree.first[node], tree.last[node], weight).max() <= bounds[node]
        for child in tree.children[node]:
            assert tree.first[node] <= tree.first[child] < tree.last[child] <= tree.last[node]
    best = lexical_search.Best(10)
    scored = lexical_search.descend(tree, list(range(2000)), columns, weights[columns], best)
    every = tree.scores(0, 2000, weight)
    want = sorted(((-int(s), int(tree.order[i])) for i, s in enumerate(every)))[:10]
    assert sorted((-e[0], -e[2]) for e in best.heap) == want
    assert scored < 1000


def test_edges(spark, edge_docs, no_docs):
    items = [(1, "One TWO three"), (2, None), (3, ""), (None, "same text"), (5, "word3 of a very long text"), (1, "One TWO three"), (7, "中文 ...")]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    docs = [(i, t) for i, t, _ in EDGE]
    assert as_rows(lexical_search.search(edge_docs, asked)) == sorted(plain_search(docs, items), key=str)
    assert lexical_search.search(no_docs, asked).count() == 0 and lexical_search.search(edge_docs, asked.limit(0)).count() == 0
