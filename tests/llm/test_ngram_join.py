import random
import time

import numpy as np
import pyarrow as pa
import pytest
from brute import SF, components, shingles
from conftest import EDGE

from abode.llm import ngram_join, queries
from abode.llm import shingles as shingles_module
from abode.llm.components import components as connected
from abode.llm.shingles import sequence_digest, shingle_sets, word_hashes


def families(seed):
    """Groups of near copies around bases of several lengths, and texts of their own."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for copies in (5, 30, 90, 40):
        base = [rnd.choice(words) for _ in range(rnd.choice([12, 60, 150]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            texts.append(" ".join(text))
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 30))) for _ in range(40)]
    texts += [None, "", "  \n ", "W1 w2", "w1  W2", "w1", "w1 w2 w3", "w1 w2 w3 w4"]
    ids = rnd.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("size, percent, block", [(3, 90, 2048), (3, 90, 16), (5, 80, 16)])
def test_families_match_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    rows = families(size + block)
    want = components({i: shingles(t, size) for i, t in rows}, percent)
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), size, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t, size)) for i, t in rows}


def test_texts_fetched_through_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_CLASSES", 0)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    rows = families(9)
    want = components({i: shingles(t, 5) for i, t in rows}, 80)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.similar_components(frame).collect()} == want
    kept = ngram_join.one_of_each(frame).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sets = {i: shingles(t, 3) for i, t in docs.items()}
    rows = queries.op4_ngram_join(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in rows} == components(sets, 90)
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in sets.items()}


def test_edges(spark, edge_docs, no_docs):
    rows = ngram_join.similar_components(edge_docs).collect()
    assert len(rows) == len(EDGE)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert by[2, 0] == 2 and by[3, 0] == 3 and by[4, 0] == 4 and by[6, by_n(LONG_ID, rows)] == 5 and by[1, 7] == 1
    assert {r.component_id for r in rows if r.doc_id in (8, 9)} == {8, 9}
    kept = ngram_join.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "None", "7", "8", "9"])
    assert ngram_join.similar_components(no_docs).count() == 0 and ngram_join.one_of_each(no_docs).count() == 0


def test_one_row_stays_of_groups_with_null_ids(spark):
    text = lambda name, last="": " ".join(f"{name}{k}" for k in range(40)) + last
    rows = [(None, text("a")), (5, text("a")), (6, text("a", " x")), (None, text("a", " y"))]  # one null id or more
    rows += [(None, text("b")), (None, text("b")), (None, text("b", " x"))]  # null ids only
    rows += [(None, text("c")), (9, text("d"))]  # alone
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text[0], r.doc_id) for r in kept if r.doc_id) == [("a", 5), ("d", 9)]
    assert sorted(r.text[0] for r in kept) == ["a", "b", "c", "d"]


LONG_ID = 5


def by_n(doc_id, rows):
    return next(r.n_shingles for r in rows if r.doc_id == doc_id)


def test_prefixes_of_similar_sets_meet():
    rule = ngram_join.Similarity(3, 90)
    rnd = np.random.default_rng(5)
    for _ in range(300):
        n = int(rnd.integers(1, 60))
        base = np.unique(rnd.integers(0, 2**60, n).astype(np.uint64))
        other = np.unique(np.concatenate((base[rnd.random(len(base)) > 0.05], rnd.integers(0, 2**60, int(rnd.integers(0, 4))).astype(np.uint64))))
        listed = np.unique(base[: n // 2]), np.arange(1, len(np.unique(base[: n // 2])) + 1)
        common = len(np.intersect1d(base, other))
        if len(other) and rule.similar(common, len(base), len(other)):
            a, b = (ngram_join.rare_first(s, listed) for s in (base, other))
            assert np.intersect1d(a[: rule.prefix(len(a))], b[: rule.prefix(len(b))]).size
            assert common >= rule.least_common(len(a), len(b))


def test_words_split_at_ascii_white_space_only():
    texts = ["A b\x0bC d\x0c e", "É é", "", None, " \n", "a b c"]
    words = list(word_hashes(pa.array(texts)))
    assert [len(w) for w in words] == [4, 2, 0, 0, 0, 3] and words[1][0] != words[1][1] and words[0][0] == words[5][0]
    assert [len(s) for _, s in shingle_sets(pa.array(texts), 3)] == [2, 1, 0, 0, 0, 1]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 21])
def test_word_hashes_do_not_depend_on_chunks(monkeypatch, chunk):
    whole = ["ab cd  ef " * 9, "", "x" * 50, None, " a ", "ab CD EF"]
    want = list(word_hashes(pa.array(whole)))
    monkeypatch.setattr(shingles_module, "_CHUNK", chunk)
    got = list(word_hashes(pa.array(whole)))
    assert [g.tolist() for g in got] == [w.tolist() for w in want]
    assert [len(w) for w in got] == [len((t or "").split()) for t in whole] and (got[0][:3] == got[5]).all()


def test_connected_components(spark):
    rnd = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(50)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    sets = {}
    for a, b in edges:
        sets.setdefault(a, set()).add(a), sets.setdefault(b, set()).add(b)
    merged = {n: n for n in sets}
    for _ in range(100):
        for a, b in edges:
            merged[a] = merged[b] = min(merged[a], merged[b])
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(n, n) == root for n, root in merged.items())
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_equal_hashes_lose_no_row(spark, monkeypatch):
    """All rows share one hash: id and digest tell them apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ngram_join, "row_hash", lambda id_col, text_col: F.lit(5).cast("long"))
    rows = [(i, f"text {i} of its own with a few words {i}") for i in range(20)]
    rows += [(100 + i, "a text that is there three times or more") for i in range(3)] + [(7, rows[7][1]), (None, rows[8][1]), (None, "left alone"), (None, None), (30, None), (31, "")]
    for many in (500_000, 0):
        monkeypatch.setattr(ngram_join, "BROADCAST_CLASSES", many)
        kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        want = [*range(20), 100, 30, 31, None, None]
        assert sorted(map(str, (r.doc_id for r in kept))) == sorted(map(str, want))


def test_same_row_stays_of_rows_that_agree_in_id_and_text(spark):
    rows = [(1, "one two three four five six", x) for x in "cab"] + [(2, "one two three four five six", "z")]
    for parts in (1, 3):
        frame = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(parts, "extra")
        assert [tuple(r) for r in ngram_join.one_of_each(frame).collect()] == [(1, "one two three four five six", "a")]


def test_fine_cells_tell_long_sets_apart():
    """Never more than the shingles of one side only; more than the limit for long sets that differ, which 32 cells pass."""
    rule, rnd, cells, limit = ngram_join.Similarity(5, 80), np.random.default_rng(3), [], []
    some = lambda n: np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
    base = some(9_000)
    sets = [base, base[rnd.random(len(base)) < 0.95], np.union1d(base[:8_000], some(300)), some(9_000), some(8_000), some(5_000), some(600), some(400)]
    cells = [ngram_join.fine_cells(s) for s in sets]
    assert cells[-1] is None and all(len(s) / 8 <= len(c) <= len(s) / 4 for s, c in zip(sets[:-1], cells))
    fine = ngram_join.Fine(cells)
    for i, a in enumerate(sets):
        got = fine.apart(i, np.arange(len(sets)))
        for j, b in enumerate(sets):
            least = ngram_join.least_apart(cells[i], cells[j])
            assert least <= len(np.setxor1d(a, b)) and got[j] in (0, least)
            if rule.similar(len(np.intersect1d(a, b)), len(a), len(b)):
                assert got[j] == least or len(cells[i]) not in (len(cells[j]), 2 * len(cells[j]), len(cells[j]) // 2)
    a, b = sets[0], sets[3]
    limit = len(a) + len(b) - 2 * rule.least_common(len(a), len(b))
    coarse = [np.bincount((s >> np.uint64(59)).astype(np.int64), minlength=ngram_join.CELLS) for s in (a, b)]
    assert np.abs(coarse[0] - coarse[1]).sum() <= limit < fine.apart(0, np.array([3]))[0]


def test_buckets_of_a_range():
    """Pairs of small buckets and members of large ones, whatever batch they come from; a class once a bucket."""
    rule, order = ngram_join.Similarity(3, 80), type("Order", (), {"value": (np.zeros(0, np.uint64), np.zeros(0, np.int32))})
    text = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    many = [text("m", 30) + f" x{k}" for k in range(ngram_join.SMALL_BUCKET + 4)]
    few = [text("f", 30), text("f", 30) + " y", text("f", 30), text("own", 30), text("f", 12), None, ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(b, pa.string())], names=["text"]) for b in (many[:9] + few[:2], many[9:] + few[2:], [None])]
    rows = [r for b in ngram_join._prefix_rows(rule, order, 5)(iter(batches)) for r in b.to_pylist()]
    rows = pa.RecordBatch.from_pylist(sorted(rows, key=lambda r: r["bucket"]))
    met = [r for b in ngram_join._meetings(rule)(iter([rows])) for r in b.to_pylist()]
    buckets = {}
    for name, found in {sequence_digest(w): f for w, f in shingle_sets(pa.array(many + few), 3) if len(f)}.items():
        for pos, token in enumerate(found[:rule.prefix(len(found))].view(np.int64).tolist()):
            buckets.setdefault(token, []).append((name, len(found), pos))
    large = {(t, *c, len(b)) for t, b in buckets.items() if len(b) > ngram_join.SMALL_BUCKET for c in b}
    small = [(x, y) for b in buckets.values() if len(b) <= ngram_join.SMALL_BUCKET for x in b for y in b if x[0] < y[0]]
    pairs = {(x[0], y[0]) for x, y in small if 100 * min(x[1], y[1]) >= 80 * max(x[1], y[1])
             and min(x[2], y[2]) + min(x[1] - x[2], y[1] - y[2]) >= rule.least_common(x[1], y[1])}
    assert large and pairs and len(pairs) < len({(x[0], y[0]) for x, y in small})
    got = [tuple(r[k] for k in ("token", "cls", "n", "pos", "m")) for r in met if r["token"] is not None]
    assert sorted(got) == sorted(large) and {(r["a"], r["b"]) for r in met if r["token"] is None} == pairs


def test_staged_frames_leave_no_shuffle_files(spark):
    from abode.llm.common import RELEASE, stage

    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, setting = files(), spark.conf.get(RELEASE)
    staged = stage(spark.range(5000).selectExpr("id % 1000 as k").groupBy("k").count())
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(RELEASE) == setting and staged.count() == 1000
