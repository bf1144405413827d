import random
import time

import numpy as np
import pytest
from brute import SF, repeats
from conftest import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st

from abode.llm import queries, suffix_dedup


def result(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame).collect()}


def planted(seed):
    """Copies, near copies, shared passages, periodic texts and passages cut short by the ends of texts."""
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdefgh é\n\0") for _ in range(n))
    passages = [text(n) for n in (90, 99, 100, 101, 150, 400, 1200)]
    rows = [text(rnd.randrange(0, 300)) + "".join(rnd.choice(passages) + text(rnd.choice([0, 1, 40])) for _ in range(rnd.randrange(0, 4))) for _ in range(60)]
    base = text(2000)
    for _ in range(90):
        near = list(base)
        for _ in range(rnd.choice([0, 1, 3, 20])):
            near[rnd.randrange(len(near))] = rnd.choice("xyz")
        rows.append("".join(near))
    rows += ["a" * 1000, "a" * 99, "a" * 100, "ab" * 400, "b" + "ab" * 60, None, "", passages[-1][5:], passages[-1][:-7], *passages]
    rnd.shuffle(rows)
    return [(k * 3 - 50, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("run, chunk", [(200_000, 1 << 20), (37, 300)])
def test_planted_rows_match_brute_force(spark, monkeypatch, run, chunk):
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    monkeypatch.setattr(suffix_dedup, "GROUP", 4 * chunk)
    rows = planted(run)
    want = repeats(rows)
    shuffled = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(shuffled) == want


def test_query_matches_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op5_suffix_dedup(spark, SF).collect()}
    assert got == repeats(rows)


def test_edges(spark, edge_docs, no_docs):
    rows = suffix_dedup.remove_repeats(edge_docs).collect()
    assert len(rows) == len(EDGE)
    sizes = sorted((str(r.doc_id), r.n_bytes) for r in rows)
    assert sizes == sorted((str(i), len((t or "").encode())) for i, t, _ in EDGE)
    assert {r.n_removed == r.n_bytes for r in rows if r.doc_id == 6} == {True} and all(r.n_removed == 0 for r in rows if r.doc_id in (1, 2, 3, 5, 8))
    assert all(r.kept is not None for r in rows)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=1, max_size=4).map(lambda b: (b * 200)[:suffix_dedup.WIDTH]), max_size=8).map(sorted), min_size=1, max_size=6), st.integers(1, 4))
def test_loser_tree_merges_front_coded_runs(runs, decoded):
    before, suffix_dedup.DECODED = suffix_dedup.DECODED, decoded
    try:
        _check_merge(runs)
    finally:
        suffix_dedup.DECODED = before


def _check_merge(runs):
    coded = []
    for run in runs:
        rows = np.frombuffer(b"".join(run), np.uint8).reshape(-1, suffix_dedup.WIDTH)
        common, rest = suffix_dedup.front_coded(rows) if len(rows) else (np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        assert not len(rows) or (suffix_dedup.from_front_coded(common, rest) == rows).all()
        coded.append(suffix_dedup.Run(common.tobytes(), rest.tobytes()))
    out = list(suffix_dedup.merge_runs(coded))
    assert [key for key, *_ in out] == sorted(key for run in runs for key in run)
    assert all(runs[run][k] == key for key, _, run, k in out)
    for (before, *_), (key, common, *_) in zip(out, out[1:]):
        assert common == next((n for n in range(suffix_dedup.WIDTH) if before[n] != key[n]), suffix_dedup.WIDTH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 10)), max_size=12))
def test_merged_stretches(spans):
    first = np.array([a for a, _ in spans], np.int64)
    last = np.array([a + n for a, n in spans], np.int64)
    a, b = suffix_dedup.merged_stretches(first, last)
    covered = {k for s, n in spans for k in range(s, s + n)}
    assert {k for s, e in zip(a, b) for k in range(s, e)} == covered and (a[1:] > b[:-1]).all()


def _lines(n):
    """Rows with many equal strings at many offsets."""
    rnd = np.random.default_rng(n)
    return rnd.choice(np.frombuffer(b"ab", np.uint8), (6, suffix_dedup.LENGTH + suffix_dedup.BACK))[rnd.integers(0, 6, n)]


@pytest.mark.parametrize("collide", [False, True])
def test_equal_strings_by_hash_and_by_bytes(collide):
    """All but the first of equal strings at each offset, also where hashes of different strings agree."""
    line, length, back = _lines(300), suffix_dedup.LENGTH, suffix_dedup.BACK
    for offset in (0, 1, back):
        (hashes,) = suffix_dedup._window_hashes(line, range(offset, offset + 1))
        strings = line[:, back - offset:back - offset + length]
        of = {}
        for i, h in enumerate(hashes.tolist()):
            assert of.setdefault(strings[i].tobytes(), h) == h  # the same string, the same hash, at any offset
        able = np.arange(0, 300, 2)
        seen, want = set(), []
        for i in able:
            want.append(strings[i].tobytes() in seen)
            seen.add(strings[i].tobytes())
        assert suffix_dedup._not_first(strings, hashes * np.uint64(not collide), able).tolist() == want


def test_large_groups_like_small_ones(spark, monkeypatch):
    """A gram with hundreds of different suffixes, and one place held by hundreds of documents."""
    monkeypatch.setattr(suffix_dedup, "FLUSH", 7)
    rnd = random.Random(5)
    core = "".join(rnd.choice("abcdefgh ") for _ in range(60))
    say = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    ends = [say(50) for _ in range(12)]
    rows = [(i, say(rnd.randrange(5, 40)) + rnd.choice(ends) + core + rnd.choice(ends) + say(rnd.randrange(5, 40))) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == repeats(sorted(rows))


def test_filter_has_every_repeated_gram():
    """None is missed in the ranges that have a piece, few others pass, and nothing does elsewhere."""
    rnd, ranges = np.random.default_rng(8), 7
    grams = rnd.integers(0, 2**64, 20_000, dtype=np.uint64)
    pieces = {b: suffix_dedup.GramFilter.piece(grams[part] >> suffix_dedup.CUT) for b, part in suffix_dedup.split_by_range(grams, ranges) if b not in (2, 5)}
    pieces[5] = suffix_dedup.GramFilter.piece(grams[:0])
    may = suffix_dedup.GramFilter(*suffix_dedup.GramFilter.whole(ranges, pieces)).may_have
    of = {b: part for b, part in suffix_dedup.split_by_range(grams, ranges)}
    assert all(may(grams[part]).all() == (b not in (2, 5)) and may(grams[part]).any() == (b not in (2, 5)) for b, part in of.items())
    assert may(rnd.integers(0, 2**64, 20_000, dtype=np.uint64)).mean() < 0.05 and not len(may(grams[:0]))


def test_slices_hold_all_that_repeats(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FILTERS", 100)
    rows = [(3, 40, 10, 100), (0, 40, 30, 100), (1, 0, 0, 100), (2, 40, 10, 100), (4, 10, 190, 200), (5, 300, 1, 100)]
    assert suffix_dedup.slices(rows) == [[0, 2], [3, 4], [5]]
    monkeypatch.setattr(suffix_dedup, "SLICE", 0.25)
    assert suffix_dedup.slices(rows) == [[0, 2], [3], [4], [5]] and suffix_dedup.slices([(0, 0, 0, 9)]) == []


def test_many_slices_match_brute_force_and_leave_no_runs(spark, monkeypatch):
    """A slice for each range: the same result, and no slice's runs are left on disk when the next one starts."""
    files = lambda: sum(f.length() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_"))
    monkeypatch.setattr(suffix_dedup, "SLICE", 0)
    rows, parts, left = planted(5), [], []
    cut = suffix_dedup.slices
    monkeypatch.setattr(suffix_dedup, "slices", lambda ranges: parts.extend(cut(ranges)) or parts)
    before = files()
    frame = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    end = time.time() + 20
    while (left := files() - before) > 0 and time.time() < end:
        time.sleep(0.2)
    assert len(parts) > 8 and left <= 0
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()} == repeats(rows)


def test_anchors_are_spread_over_the_ranges():
    """Anchors are the least hashes near them; their ranges are even all the same."""
    text = "".join(random.Random(2).choices("abcdefgh ", k=200_000)).encode()
    _, _, hashes = suffix_dedup._batch_anchors([text])
    held = [len(part) for _, part in suffix_dedup.split_by_range(hashes, 20)]
    assert len(held) == 20 and max(held) < 2 * np.mean(held)
