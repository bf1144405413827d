import numpy as np
import pytest
from brute import SF, quality_counts
from conftest import EDGE

from abode.llm import quality, queries


def test_counts_match_brute_force():
    texts = [t for _, t, _ in EDGE] + ["a b c d e f g h " * 3, "x " * 40, "one\ntwo\none\n\n \ntwo", "#a*$ %&|<>", "a b c d e f g h i a b c d e f g h"]
    counts, _ = quality.statistics([(t or "").encode() for t in texts])
    assert [tuple(r) for r in counts.tolist()] == [quality_counts(t) for t in texts]


def test_forest_is_monotonic_and_accurate_on_held_out_rows():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.2)).astype(float)
    y[rng.random(3000) < 0.03] = 0
    forest = quality.fit_forest(x[:2000], y[:2000], [-1, 1, 0, -1])
    assert ((forest.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.93
    line = np.repeat(x[:50], 40, axis=0)
    for f, way in ((0, -1), (1, 1), (3, -1)):
        moved = line.copy()
        moved[:, f] = np.tile(np.linspace(0, 1, 40), 50)
        steps = np.diff(forest.score(moved).reshape(50, 40), axis=1) * way
        assert (steps >= -1e-12).all()


def test_one_kind_of_label_gives_the_base_rate():
    forest = quality.fit_forest(np.random.default_rng(0).random((30, 2)), np.ones(30), [0, 0])
    assert (forest.score(np.zeros((3, 2))) > 0.99).all()


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        counts = quality_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_held_out_labels_are_met(spark):
    from pyspark.sql import functions as F

    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    even = F.xxhash64("doc_id") % 2 == 0
    judged = quality.judge(docs, quality.train(docs, labels.filter(even))).select("row.doc_id", "kept")
    rows = judged.join(labels.filter(~even), "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.93


@pytest.mark.parametrize("labels", [[], [(1, 1), (5, None), (None, 0), (77, 0), (1, 0)]])
def test_edges(spark, edge_docs, no_docs, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = quality.quality_rules(edge_docs, frame).collect()
    assert len(rows) == len(EDGE) and sorted(r.n_words for r in rows) == sorted(quality_counts(t)[0] for _, t, _ in EDGE)
    assert all(r["base_failed"] for r in rows if not r["text"]) and all(isinstance(r["kept"], bool) and r["row"] == "r" for r in rows)
    assert quality.accepted(edge_docs, frame).columns == edge_docs.columns
    assert quality.quality_rules(no_docs, frame).count() == 0
