import math
import random
import re
import time

import pytest
import regex
from brute import SF, sha
from conftest import EDGE

from abode.llm import privacy, queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TEXTS = ["a@b.c_d@e.f x..@y.z- @q.r a@b a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.001.0 1.2.3 1.2.3.4", "4539 1488 0343 6467 4539-1488-0343-6468 4539148803436467",
         "+1 (386) 555-3733 +12 +1234567 +1234567890123456 +1 2 3 4 5 6 7 8 x +1()...9", "\U0001f600é a@b.de 中 10.0.0.1", "9" * 5000 + ".1.2.3", "a" * 5000 + "@", "+1" + " " * 3000]


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p.lstrip("0")[:4] or 0) <= 255 for p in value.split("."))
    if kind == "card":
        turned = [d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(turned) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def base(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def spans(row):
    return [(k, s.start, s.end) for k in privacy.KINDS[:-1] for s in row[k]]


def test_base_kinds_match_brute_force(spark):
    rows = privacy.find_personal_data(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    assert {r.doc_id: spans(r) for r in rows} == {n: base(t) for n, t in enumerate(TEXTS)}


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_privacy(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = [f"{k}:{a}:{b}" for k, a, b in base(docs[r.doc_id])]
        assert r.base_sha256 == sha(",".join(found)) and [s for s in r.spans.split(",") if s and not s.startswith("term")] == found


@pytest.fixture()
def planted(spark):
    rnd = random.Random(1)
    words = [f"{a}{b}{c}" for a in ("kol", "amir", "tes") for b in ("eno", "aru", "ipa", "ost") for c in ("bel", "dim", "fan")]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(i, say(40)) for i in range(200)]
    rows += [(1000 + i, f"{say(10)} Zanzibarix joe.doe@mail.example.com {say(10)}") for i in range(4)]
    rows += [(2000 + i, f"{say(3)} lonely ann{i}@mail.example.com {say(3)}") for i in range(3)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("most", [50_000, 0])
def test_terms_that_disclose_an_entity(planted, monkeypatch, most):
    monkeypatch.setattr(privacy, "BROADCAST_TERMS", most)
    rows = {r.doc_id: r for r in privacy.find_personal_data(planted).collect()}
    assert all([s.value for s in rows[1000 + i].term] == ["zanzibarix"] for i in range(4))
    assert all(not r.term for i, r in rows.items() if not 1000 <= i < 2000)  # common words, and words seen near one text's entity only
    texts = {r.doc_id: r.text for r in planted.collect()}
    clean = {r.doc_id: r.text for r in privacy.sanitise(planted).collect()}
    assert clean[1000] == texts[1000].replace("Zanzibarix joe.doe@mail.example.com", "[term] [email]")
    assert clean[5] == texts[5]
    assert {r.text for r in privacy.sanitise(planted, generalise=False).filter("doc_id = 1001").collect()} == {texts[1001].replace("Zanzibarix joe.doe@mail.example.com", " [email]")}


def test_terms_of_an_entity_of_one_text(spark):
    rows = [(i, f"plain words of text {'odd' if i % 2 else 'even'}") for i in range(400)]
    rows += [(500, "plain Quentinius q.v@mail.example.com words"), (501, "plain words z.z@mail.example.com text")]
    found = {r.doc_id: [s.value for s in r.term] for r in privacy.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found.pop(500) == ["quentinius"] and not any(found.values())


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_TERMS": 0}, {"BROADCAST_TERMS": 0, "BROADCAST_HASHES": 0, "BROADCAST_DOCS": 0}])
def test_terms_are_marked_in_whole_texts_of_all_documents(spark, monkeypatch, limits):
    for name, most in limits.items():
        monkeypatch.setattr(privacy, name, most)
    far = "plain words " * 20
    rows = [(i, f"plain words of text {i}") for i in range(200)]
    rows += [(1000 + i, f"Zanzibarix joe.doe@mail.example.com {far}\u00c9t\u00e9 ZANZIBARIX {far}") for i in range(8)] + [(2000, f"{far}zanzibarix")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = privacy.find_personal_data(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        want = [m.span() for m in re.finditer("zanzibarix", texts[r.doc_id], re.I)]
        assert [(s.start, s.end) for s in r.term if s.value == "zanzibarix"] == want
    assert not any("zanzibarix" in r.text.lower() for r in privacy.sanitise(docs).collect())


def test_words_are_counted_after_a_cut_by_hash(spark, monkeypatch):
    """Too many terms for a broadcast of their texts: words of other hashes stay out of the shuffle."""
    docs = spark.createDataFrame([(f"zanzibarix common {i}",) for i in range(20)] + [("common zanzibarix zanzibarix",), (None,)], "text string")
    entities = spark.createDataFrame([("email:a@b.de", i, i) for i in range(20)], "entity string, doc_key long, text_hash long")
    near = spark.createDataFrame([("email:a@b.de", "zanzibarix", i, i) for i in range(20)], "entity string, term string, doc_key long, text_hash long")
    args = docs, 1000, entities, near, 0.9, 1
    want = privacy._disclosing(*args).collect()
    monkeypatch.setattr(privacy, "BROADCAST_TERMS", 0)
    cut = privacy._disclosing(*args)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, (xxhash64(term" in plan
    monkeypatch.setattr(privacy, "BROADCAST_HASHES", 0)
    assert [r.term for r in want] == ["zanzibarix"] and cut.collect() == want == privacy._disclosing(*args).collect()


def plain_terms(docs):
    """Spans of disclosing words by document, from sets of documents. ``docs`` are (id, text), ids and texts differ."""
    word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
    holding, near, has, spans = {}, {}, {}, {}
    for i, text in docs:
        spans[i] = base(text)
        places = [(m.group().lower(), *m.span()) for m in word.finditer(text or "")]
        for w, *_ in places:
            has.setdefault(w, set()).add(i)
        free = [p for p in places if not any(p[1] < b and p[2] > a for _, a, b in spans[i])]
        for kind, a, b in spans[i]:
            entity = f"{kind}:{text[a:b].lower()}"
            holding.setdefault(entity, set()).add(i)
            for w, first, last in free:
                if first >= a - privacy.REACH and last <= b + privacy.REACH:
                    near.setdefault((entity, w), set()).add(i)
    terms = set()
    for (entity, w), joint in near.items():
        rate = len(holding[entity]) / len(docs)
        information = math.log(1 / rate)
        if information > 0 and math.log((len(joint) + privacy.PRIOR * rate) / ((len(has[w]) + privacy.PRIOR) * rate)) >= privacy.THRESHOLD * information:
            terms.add(w)
    return {i: [(m.start(), m.end()) for m in word.finditer(text or "") if m.group().lower() in terms
                and not any(m.start() < b and m.end() > a for _, a, b in spans[i])] for i, text in docs}


def test_terms_of_the_tables_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_terms(docs)
    rows = queries.op10_privacy(spark, SF).collect()
    assert {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term")] for r in rows} == want
    assert any(want.values())


def test_short_names_and_staff_numbers_disclose(spark):
    rows = [(i, f"plain words of text {'odd' if i % 2 else 'even'}") for i in range(400)]
    rows += [(500, "plain Bob kx42 q.v@mail.example.com \u674e words"), (501, "plain words z.z@mail.example.com text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [s.value for s in r.term] for r in privacy.find_personal_data(docs).collect()}
    assert found.pop(500) == ["bob", "kx42", "\u674e"] and not any(found.values())
    assert [(i, [(s, e) for s, e in v]) for i, v in plain_terms(rows).items() if v] == [(500, [(6, 9), (10, 14), (36, 37)])]


def test_one_text_of_many_entities(spark):
    """Time and places of a mailing list dump: eight thousand addresses in one text."""
    text = " ".join(f"name{i} user{i}@mail.example.com" for i in range(8000))
    docs = spark.createDataFrame([(1, text), (2, "name5 and others")], "doc_id long, text string")
    began = time.perf_counter()
    rows = {r.doc_id: r for r in privacy.find_personal_data(docs).collect()}
    took = time.perf_counter() - began
    assert [(s.start, s.end) for s in rows[1].email] == [m.span() for m in re.finditer(r"user\d+@mail.example.com", text)]
    assert took < 60  # about 5 s alone; the square of the entities would take minutes


def test_query_marks_terms_in_the_tables(spark):
    assert queries.op10_privacy(spark, SF).filter("spans like '%term:%'").count() > 0


def test_edges(spark, edge_docs, no_docs):
    rows = privacy.find_personal_data(edge_docs).collect()
    assert len(rows) == len(EDGE) and all(not spans(r) and r.term == [] for r in rows)
    clean = privacy.sanitise(edge_docs)
    assert clean.columns == edge_docs.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, edge_docs.collect()))
    assert privacy.find_personal_data(no_docs).count() == 0 and privacy.sanitise(no_docs).count() == 0
    twice = spark.createDataFrame([(1, "a@b.cd")] * 2 + [(None, "a@b.cd")], "doc_id long, text string")
    assert [r.text for r in privacy.sanitise(twice).collect()] == ["[email]"] * 3
