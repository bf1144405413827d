"""The pipeline against a brute-force version, and the driver contract of the corpus queries."""

from collections import Counter

import numpy as np
from brute import SF, components, contamination, shingles, windows_of
from conftest import EDGE
from test_sharding_mixing import laws, queue

import __spark_entry__ as entry
import corpus_pipeline
from abode.llm import quality


def plain(spark, docs, benchmark, forest):
    """Rows after stages 1 to 4, as a count by id."""
    counts, x = quality.statistics([(t or "").encode() for _, t, _ in docs])
    good = ~quality.base_failed(counts) & (forest.score(x) >= 0.5)
    docs = [d for d, k in zip(docs, good) if k]
    groups = components({i: shingles(t, 5) for i, t, _ in docs}, 80)
    docs = [d for d in docs if groups[d[0]] == d[0]]
    windows = windows_of(benchmark)
    docs = [d for d in docs if not contamination(d[1], windows)[1]]
    taken, _ = queue(docs)
    words = [len(t.split()) for _, t, _ in docs]
    return Counter({d[0]: round(n / w) for d, n, w in zip(docs, taken, words) if n})


def test_pipeline_matches_brute_force(spark):
    frame, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = [(r.doc_id, r.text, r.source) for r in frame.collect()]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain(spark, docs, benchmark, quality.train(frame, labels))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in rows) == want
    laws(rows, corpus_pipeline.SHARDS)


def test_stages_keep_columns_and_take_edges(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge_docs, SF).columns == edge_docs.columns, name
        assert stage(spark, no_docs, SF).count() == 0, name
    kept = corpus_pipeline.STAGES[1][1](spark, edge_docs, SF)
    assert kept.count() < len(EDGE)
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF).count() == kept.count()


def test_training_needs_no_more_than_its_bound(spark):
    frame, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    x, y = quality.training_sample(frame, labels, 40)
    assert len(x) == len(y) == 40 and np.isfinite(x).all()


def test_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "source mix", "sharding"]
