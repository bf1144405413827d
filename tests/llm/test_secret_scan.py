import re
from dataclasses import replace

from brute import SF, sha
from conftest import EDGE

from abode.llm import queries, secret_scan

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
TEXTS = ["password = hunter2hunter2 PASSWD:'abc' token: ABCDEFGH", "AKIA" + "A1" * 8 + " AKIA123 xAKIAAKIAAKIAAKIA", "0" * 31 + " " + "ab" * 16 + "g" + "f" * 40,
         "\U0001f600é api_key: Key=12345678 API-KEY", "ſecret=12345678 secret=12345678", "-----BEGIN RSA PRIVATE KEY-----", "token==" + "a" * 64]


def base(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_rules_match_brute_force():
    for text in TEXTS:
        got = sorted((a, n, r.kind, b) for n, r in enumerate(secret_scan.BASE_RULES) for a, b in r.find(text))
        assert [(k, a, b) for a, _, k, b in got] == base(text)


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op7_secret_scan(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = base(docs[r.doc_id])
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, *_ in found) for kind in ("assign", "access", "hex"))
        assert set(f"{k}:{a}:{b}" for k, a, b in found) <= set(r.spans.split(","))


def test_ledger_scans_unseen_pairs_only(spark, scratch):
    ledger = f"{scratch}/ledger"
    first = spark.createDataFrame([("a", 1, TEXTS[0]), ("a", 2, TEXTS[1]), ("b", 1, TEXTS[0])], "path string, version int, text string")
    found = lambda df, rules: {(r.path, r.version): [(s.kind, s.start, s.end) for s in r.found]
                               for r in secret_scan.scan_history(df, ["path", "version"], rules=rules, ledger=ledger).collect()}
    rules = secret_scan.BASE_RULES
    want = {("a", 1): base(TEXTS[0]), ("a", 2): base(TEXTS[1]), ("b", 1): base(TEXTS[0])}
    assert found(first, rules) == want
    entries = lambda: sorted((r.blob, tuple(sorted(r.rules))) for r in spark.read.parquet(ledger).collect())
    assert len(entries()) == 2  # two blobs, though three paths
    assert found(first, rules) == want and len(entries()) == 2
    more = first.union(spark.createDataFrame([("c", 1, TEXTS[2]), ("c", 2, TEXTS[1])], first.schema))
    assert found(more, rules) == want | {("c", 1): base(TEXTS[2]), ("c", 2): base(TEXTS[1])} and len(entries()) == 3
    newer = (*rules[:2], replace(rules[2], version=2))
    before = set(entries())
    assert found(more, newer)["c", 1] == base(TEXTS[2])
    assert sorted(r for _, r in entries()) == sorted([*(r for _, r in before), *[("hex@2",)] * 3])


def test_findings_of_old_rule_versions_are_not_returned(spark, scratch):
    docs = spark.createDataFrame([(1, "token=12345678 " + "a" * 40 + " " + "b" * 70 + " AKIA" + "A1" * 8)], "doc_id long, text string")
    found = lambda rules: [(s.kind, s.place, s.start, s.end) for r in secret_scan.scan_history(docs, ["doc_id"], rules=rules, ledger=f"{scratch}/l").collect() for s in r.found]
    assign, access, hexes = secret_scan.BASE_RULES
    assert found((assign, access, hexes)) == [("assign", 0, 0, 14), ("hex", 2, 15, 55), ("hex", 2, 56, 126), ("access", 1, 127, 147)]
    narrower = replace(hexes, version=2, pattern=re.compile(r"[0-9a-f]{64,}"))
    assert found((assign, access, narrower)) == [("assign", 0, 0, 14), ("hex", 2, 56, 126), ("access", 1, 127, 147)]
    assert found((narrower, assign)) == [("assign", 1, 0, 14), ("hex", 0, 56, 126)]


def test_edges(spark, edge_docs, no_docs):
    rows = secret_scan.scan_history(edge_docs, ["doc_id"]).collect()
    assert len(rows) == len(EDGE) and all(r.found == [] for r in rows)
    odd = spark.createDataFrame([(1, "x token=12345678", "b", [1])] * 3 + [(None, "x token=12345678", None, None)], "doc_id long, text string, blob string, found array<int>")
    assert [[(s.kind, s.start, s.end) for s in r.found] for r in secret_scan.scan_history(odd, ["doc_id"]).collect()] == [[("assign", 2, 16)]] * 4
    assert secret_scan.scan_history(no_docs, ["doc_id"]).count() == 0
