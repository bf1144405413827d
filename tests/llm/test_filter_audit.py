import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from brute import SF, WORD
from conftest import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st

from abode.llm import filter_audit, queries

FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def counts(text):
    words = WORD.findall(text or "")
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""), len(re.findall(r"[#$%&*|]", text or ""))]


def plain_audit(docs, labels):
    """By filtering the documents in every order. ``docs`` are (id, text, part), ``labels`` (id, quality, toxic)."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    rows = []
    for i, text, part in docs:
        n, distinct, capitals, points, symbols = counts(text)
        failed = {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * capitals > 10 * points, "D": symbols > 0,
                  "E": i is not None and first[text or ""] < i}
        rows.append((i, part or "", {k for k, v in failed.items() if v}))
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in rows}:
        own = [(i, f) for i, p, f in rows if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                fell = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[part, name] += len(fell)
                out[part, "".join(order), step] = [len(left), len(fell), sum(name in f for _, f in own) - len(fell), sum(f == {name} for _, f in own),
                                                   sum(i in good for i, _ in fell), sum(i in toxic for i, _ in fell)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def as_dict(frame):
    rows = frame.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in FIELDS) for r in rows}
    assert len(out) == len(rows)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbB# \né中\U0001f600| ", max_size=60)), max_size=8), st.sampled_from([1, 5, 1 << 20]))
def test_transducer_matches_brute_force(texts, piece):
    before, filter_audit.PIECE = filter_audit.PIECE, piece
    try:
        got = filter_audit.text_counts(pa.array(texts, pa.string()))
    finally:
        filter_audit.PIECE = before
    assert [list(map(int, c)) for c in zip(*got)] == [counts(t) for t in texts]


def test_slots_are_verified(monkeypatch):
    """All words in one chain of slots: bytes decide, not hashes."""
    monkeypatch.setattr(filter_audit.Words, "hashes", lambda self, starts, lengths, owners: np.zeros(len(starts), np.uint64))
    texts = ["ab ab abcdefgh abcdefgi abcdefgh" + " x" * 9, "ab " + "y" * 30 + " " + "y" * 30 + " " + "y" * 29 + "z"]
    got = filter_audit.text_counts(pa.array(texts))
    assert got[0].tolist() == [14, 4] and got[1].tolist() == [4, 3]


def test_sliced_batches():
    texts = pa.array(["one", None, "Two three", "", "four FOUR four"])
    assert [c.tolist() for c in filter_audit.text_counts(texts.slice(2))][:2] == [[2, 0, 3], [2, 0, 2]]


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert as_dict(queries.op11_filter_audit(spark, SF)) == plain_audit(docs, labels)


def test_long_texts_and_copies(spark):
    rnd = random.Random(3)
    docs = [(i, " ".join(rnd.choice(["Aa", "b", "C", "word", "#", "été"]) + str(rnd.randrange(k)) for _ in range(rnd.choice([5, 99, 100, 400]))), rnd.choice(["x", "y", None]))
            for i, k in enumerate([3, 40, 10**6] * 30)]
    docs += [(i + 50, t, p) for i, t, p in docs[:20]]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(100)] * 2
    got = filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert as_dict(got) == plain_audit(docs, labels)


@pytest.mark.parametrize("wanted", [None, "AD"])
def test_edges(spark, edge_docs, no_docs, wanted):
    labels = spark.createDataFrame([(1, 1, None), (8, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = as_dict(filter_audit.audit(edge_docs, labels, part_col="source", wanted=wanted))
    if wanted is None:
        assert got == plain_audit([(i, t, p) for i, t, p in EDGE], [(1, 1, None), (8, 0, 1)])
    else:
        assert {k[1] for k in got} == {"AD", "DA"}
    assert filter_audit.audit(no_docs, labels, part_col="source").count() == 0
