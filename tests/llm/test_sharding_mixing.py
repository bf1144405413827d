import zlib
from collections import Counter, defaultdict

import pytest
from brute import SF, WORD, spark_hash
from conftest import EDGE

from abode.llm import mixing, queries, sharding


def laws(rows, shards):
    counts = Counter(r.shard for r in rows)
    per = [counts.get(s, 0) for s in range(shards)]
    assert max(per) - min(per) <= 1 and sum(per) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts.get(s, 0)))


def test_shards_of_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op2_interleaved_shards(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    laws(rows, 16)
    assert all(r.size == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)
    by_source = Counter((r.source, r.shard) for r in rows)
    totals = Counter(r.source for r in rows)
    assert all(abs(by_source[s, k] - totals[s] / 16) < 2 for s in totals for k in range(16))
    again = queries.op2_interleaved_shards(spark, SF).collect()
    assert sorted(again, key=str) == sorted(rows, key=str)


def test_order_follows_fractional_ranks(spark):
    rows = sharding.interleaved_shards(spark.read.parquet(f"{SF}/documents.parquet"), 4).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    by_source = defaultdict(list)
    for i, d in docs.items():
        by_source[d.source].append((spark_hash(("i", 20), i, zlib.crc32(d.text.encode())), i))
    ranked = sorted(((k + 0.5) / len(v), s, h, i) for s, v in by_source.items() for k, (h, i) in enumerate(sorted(v)))
    got = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert got == [i for *_, i in ranked]


def test_shard_edges(spark, edge_docs, no_docs):
    rows = sharding.interleaved_shards(edge_docs, 5).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _, _ in EDGE)
    laws(rows, 5)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(1, 0)}
    assert sharding.interleaved_shards(no_docs, 5).count() == 0


def fill(sizes, weights, share, repeats):
    """Water filling one source at a time."""
    budget, targets, open_ = share * sum(sizes.values()), {}, dict(zip(sizes, weights))
    while True:
        level = (budget - sum(targets.values())) / sum(open_.values()) if open_ else 0
        over = [s for s in open_ if open_[s] * level > repeats * sizes[s] * (1 + 1e-12)]
        if not over:
            return targets | {s: w * level for s, w in open_.items()}
        for s in over:
            targets[s] = repeats * sizes[s]
            del open_[s]


def queue(docs, seed=8, share=1.5, repeats=2):
    """The mix one copy at a time: (taken by row, target by source)."""
    words = [len(WORD.findall(t or "")) for _, t, _ in docs]
    keys = ["~" if s is None else f"={s}" for _, _, s in docs]
    sizes = {k: sum(w for w, x in zip(words, keys) if x == k) for k in sorted(set(keys))}
    weights = [(5, 2, 1)[n % 3] for n in range(len(sizes))]
    weight = dict(zip(sizes, weights))
    order = sorted(range(len(docs)), key=lambda n: (spark_hash(("i", seed), docs[n][0], spark_hash(docs[n][1])), docs[n][0] or 0, words[n]))
    sent, copies = dict.fromkeys(sizes, 0), []
    for n in order:
        sent[keys[n]] += words[n]
        h = spark_hash(("i", seed), docs[n][0], spark_hash(docs[n][1]))
        copies += [((sent[keys[n]] + e * sizes[keys[n]]) / weight[keys[n]], keys[n], h, n) for e in range(repeats)]
    taken, left = Counter(), share * sum(words)
    for _, _, _, n in sorted(copies):
        if words[n] > left:
            break
        left -= words[n]
        taken[n] += words[n]
    return [taken[n] for n in range(len(docs))], fill(sizes, weights, share, repeats)


def test_mix_of_the_table_matches_brute_force(spark):
    table = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.op8_source_mix(spark, SF).collect()
    taken, targets = queue(table)
    assert {r.doc_id: r.taken for r in rows} == {d[0]: t for d, t in zip(table, taken)}
    assert all(r.target == pytest.approx(targets[f"={r.source}"]) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    assert all(r.source_size == sizes[r.source] and r.taken in (0, r.size, 2 * r.size) for r in rows)
    most = Counter()
    for r in rows:
        most[r.source] = max(most[r.source], r.size)
    got = Counter()
    for r in rows:
        got[r.source] += r.taken
    assert all(abs(got[s] - targets[f"={s}"]) <= 2 * max(most.values()) for s in sizes)


def test_mix_edges(spark, edge_docs, no_docs):
    decisions = mixing.mix_sources(edge_docs)
    rows = decisions.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _, _ in EDGE)
    assert sum(r.taken for r in rows) <= 1.5 * sum(r.size for r in rows) + 1
    mixed = mixing.apply_mix(edge_docs, decisions)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(no_docs).count() == 0
    empty = mixing.mix_sources(edge_docs.filter("doc_id in (2, 3, 4)")).collect()
    assert [(r.size, r.taken, r.target) for r in empty] == [(0, 0, 0.0)] * 3
    one = mixing.mix_sources(edge_docs, share=9.0).collect()
    assert all(r.copies == (2 if r.size else 0) for r in one)


def test_mix_applied_through_a_shuffle(edge_docs, monkeypatch):
    decisions = mixing.mix_sources(edge_docs)
    want = sorted(map(str, mixing.apply_mix(edge_docs, decisions).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(str, mixing.apply_mix(edge_docs, decisions).collect())) == want
