import duckdb
from brute import SF, contamination, sha, windows_of
from conftest import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st

from abode.llm import decontamination, oracles, queries


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab ", max_size=40), max_size=5), st.text("ab ", max_size=120), st.integers(1, 4))
def test_search_matches_brute_force(items, text, window):
    named = [(str(i), t.encode()) for i, t in enumerate(items)]
    words = decontamination.words_of(text.encode())
    mask, found = decontamination.search(words, decontamination.search_tables(named, window))
    assert (len(words), int(mask.sum()), sorted(found)) == contamination(text, windows_of(enumerate(items), window))


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    windows = windows_of([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    rows = queries.op3_decontamination(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words, hit, items = contamination(docs[r.doc_id], windows)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (words, hit, len(items), sha(",".join(items)), hit > 0)


def test_edges_and_blocks(spark, edge_docs, no_docs):
    items = [(1, "One TWO three"), (2, None), (3, ""), (None, "same text"), (5, "word3 of a very long text word4 of a very long text word5"), (6, "one two three"), (7, "中文")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = windows_of(items)
    for words in (1, 10**6):  # an item a block, or all in one
        rows = decontamination.contamination_report(edge_docs, benchmark, block_words=words).collect()
        assert len(rows) == len(EDGE)
        for r in rows:
            n, hit, found = contamination(r.text, windows)
            assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (n, hit, found, hit > 0)
            assert sum(s["last"] - s["first"] + 1 for s in r.spans) == hit
    assert {r.doc_id: r["items"] for r in rows if r.n_hit and not r["items"]} == {8: [], 9: []}  # hit by the item without id
    clean = decontamination.decontaminate(edge_docs, benchmark)
    assert clean.columns == edge_docs.columns
    assert clean.count() == sum(not contamination(t, windows)[1] for _, t, _ in EDGE)
    assert decontamination.contamination_report(no_docs, benchmark).count() == 0
    assert decontamination.decontaminate(edge_docs, benchmark.limit(0)).count() == len(EDGE)


def test_sql_counts_items_without_id():
    duck = duckdb.connect()
    words = " ".join(f"word{i}" for i in range(12))
    duck.execute("CREATE TABLE benchmark AS SELECT * FROM (VALUES (NULL, ?), (3, 'other words')) AS b(item_id, text)", [words])
    duck.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, ?), (2, 'some other words')) AS d(doc_id, text)", [f"so {words} so"])
    rows = duck.execute(f"SELECT doc_id, n_hit, n_items, contaminated FROM ({oracles.OP3}) ORDER BY doc_id").fetchall()
    assert rows == [(1, 12, 0, True), (2, 2, 1, True)]


def test_tables_are_built_once_by_a_worker(monkeypatch):
    built = []
    monkeypatch.setattr(decontamination, "_kept", {})
    monkeypatch.setattr(decontamination, "search_tables", lambda items, window: built.append(items) or [])
    for _ in range(3):
        for k in range(decontamination.KEPT_BLOCKS):
            decontamination.kept_tables(("a", k), [(str(k), b"x")], 10)
    assert len(built) == decontamination.KEPT_BLOCKS
    decontamination.kept_tables(("b", 0), [], 10)
    assert len(decontamination._kept) == decontamination.KEPT_BLOCKS
