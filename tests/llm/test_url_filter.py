import re

from brute import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from abode.llm import queries, url_filter

URLS = ["http://example.com/en/x", "https://www.EXAMPLE.com/en/", "http://a.b.net/es/1?x=/fr/", "http://net/fr/", "http://net", "no scheme", "", None,
        "x://h?://net/es/", "http://notexample.com/en/", "http://example.com/EN/", "http://example.com", "http://" + "a." * 500 + "com/" + "p/" * 500, "http://a..net//es/"]


def judge(url, rules=queries.URL_RULES):
    m = re.search(r"://([^/?#]*)([^?#]*)", url) if url else None
    host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[3:] if fits else (None, "allow"))


def check(spark, urls, rules):
    frame = spark.createDataFrame([(n, u) for n, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter.filter_urls(frame, url_filter.rule_frame(spark, rules)).collect()
    assert {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in rows} == {n: judge(u, rules) for n, u in enumerate(urls)}
    assert len(rows) == len(urls)


def test_fixed_urls(spark):
    check(spark, URLS, queries.URL_RULES)


def test_more_rules_than_a_broadcast_may_hold(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 2)
    check(spark, URLS, queries.URL_RULES)


def test_rules_are_broadcast_and_urls_stay(spark, capsys):
    pages = spark.createDataFrame([(1, "http://a.com/b")], "page_id long, url string")
    url_filter.filter_urls(pages, url_filter.rule_frame(spark, queries.URL_RULES)).explain()
    plan = capsys.readouterr().out
    joins = [line for line in plan.splitlines() if "Join" in line and "startswith" in line.lower()]
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0]


def test_rules_without_slash_at_the_end(spark):
    check(spark, URLS + ["http://net/es", "http://x.net/esp/fr/"], [("block", "net", "/es"), ("allow", "x.net", ""), ("block", "x.net", "/esp/f"), ("allow", "", "")])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ab./?#:-", max_size=14).map(lambda s: "h://" + s), min_size=1, max_size=30))
def test_random_urls(spark, urls):
    check(spark, urls, [("block", "a", "/"), ("allow", "b.a", "/a/"), ("block", "a.b", "/b"), ("allow", "b", "")])


def test_query_and_edges(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in queries.op9_url_filter(spark, SF).collect()} == {i: judge(u) for i, u in pages.items()}
    rules = url_filter.rule_frame(spark, queries.URL_RULES)
    twice = spark.createDataFrame([(1, URLS[0], "v", 3), (1, URLS[0], "v", 3), (None, None, None, None)], "page_id long, url string, verdict string, digest int")
    rows = url_filter.filter_urls(twice, rules)
    assert rows.columns == ["page_id", "url", "digest", "host", "path", "rule", "verdict"] and rows.count() == 3
    assert url_filter.filter_urls(twice.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(twice, rules.limit(0)).collect()} == {"allow"}
