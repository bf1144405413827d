import random

import numpy as np
import pytest
import xxhash
from brute import SF, WORD, lower
from conftest import EDGE

from abode.llm import queries, simhash


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_ids(prints, most=3):
    """Least id of the component of each id, by all pairs."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    rows = queries.op13_simhash(spark, SF).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == least_ids(prints)
    assert len(set(least_ids(prints).values())) < len(prints)


@pytest.mark.parametrize("large", [1024, 4, 1])
def test_links_of_dense_groups(spark, monkeypatch, large):
    """Groups of fingerprints a few bits apart, lonely ones, and buckets that are dealt again."""
    monkeypatch.setattr(simhash, "LARGE_BUCKET", large)
    rnd = random.Random(large)
    prints = {0, 2**64 - 1, 7, 2**63}
    for _ in range(12):
        base = rnd.getrandbits(64)
        prints |= {base} | {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6))) for _ in range(25)}
    prints = dict(enumerate(sorted(prints)))
    signed = [(i, p - 2**64 if p >= 2**63 else p) for i, p in prints.items()]
    found = simhash.links(spark.createDataFrame(signed, "id long, fp long").select("fp")).collect()
    of = {p: i for i, p in signed}
    assert all((r.a ^ r.b).bit_count() <= 3 or ((r.a ^ r.b) % 2**64).bit_count() <= 3 for r in found)
    want, label = least_ids(prints), {i: i for i in prints}
    for _ in prints:
        for r in found:
            label[of[r.a]] = label[of[r.b]] = min(label[of[r.a]], label[of[r.b]])
    assert label == want


def test_bounds_of_lanes():
    free = [2**64 - 1]
    for _ in range(simhash.LEVELS):
        cut = [(f, simhash.lanes(f, 4)) for f in free]
        assert all(sum(c) == f for f, c in cut)
        free = list({f & ~lane for f, c in cut for lane in c})
    assert max(f.bit_count() for f in free) <= 12
    values = np.arange(2**16, dtype=np.uint64)
    assert len(np.unique(simhash.distances(values, 2**16 - 1), axis=0)) == 2**16


def test_edges(spark, edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert sorted((r.doc_id or -1, r.fp % 2**64) for r in rows) == sorted((i or -1, plain_fingerprint(t)) for i, t, _ in EDGE)
    of = {}
    for r in rows:
        of.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(c) == 1 for c in of.values()) and of[0] == {2}
    alone = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (5, "other words here"), (6, None), (None, "")], "doc_id long, text string")
    assert sorted(map(str, (r.component_id for r in simhash.near_duplicates(alone).collect()))) == ["5", "6", "6", "None", "None"]
    assert simhash.near_duplicates(no_docs).count() == 0
