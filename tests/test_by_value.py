"""Classification by distinct value: the same answers as rules on rows, and a small plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import _plan

import __spark_entry__ as entry
from abode.operators import by_value
from abode.operators.by_value import ValueTable, classify_by_value, value_lookup
from abode.plans import catalogue_feeds, measures
from abode.rules import e2

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def tables(spark):
    return [
        ValueTable(("a",), {"CA": ([(("~", "a", "(?i)x"), "has x"), (("null", "a"), "none")], "ERROR"), "CA2": ([(("=", "CA", "has x"), "again")], None)}),
        ValueTable(("a", "b"), {"CAB": ([(("and", ("null", "a"), ("=", "b", "y")), "only y"), ((">", "n", 3), "above 3")], "ERROR")},
                   {"n": F.col("b").try_cast("double")}),
    ]


def _direct(df, tables):
    for table in tables:
        df = table.classified(df)
    return df


@pytest.mark.parametrize("most", [100_000, 2, 0])
def test_same_answers_as_rules_on_rows(spark, tables, monkeypatch, most):
    monkeypatch.setattr(by_value, "BROADCAST_VALUES", most)
    rows = [(a, b, "o") for a in (None, "", "x", "X y", "z") for b in (None, "y", "7", "2", "")] * 3
    df = spark.createDataFrame(rows, "a string, b string, o0 string")
    got, want = classify_by_value(df, tables), _direct(df, tables)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_and_unseen(spark, tables):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    assert classify_by_value(df.limit(0), tables).count() == 0
    lookup = value_lookup(df.limit(0), tables)
    assert lookup.sizes == {} and lookup.apply(df).first().CA is None  # a value that nobody gathered has no class


def test_hot_value_is_one_row_a_task(spark, tables):
    df = spark.range(100_000).selectExpr("CASE WHEN id % 3 > 0 THEN 'x' ELSE concat('z', id % 5) END AS a", "CAST(NULL AS STRING) AS b")
    lookup = value_lookup(df, tables)
    assert lookup.sizes == {0: 6, 1: 6}
    assert lookup.apply(df).groupBy("CA").count().where("CA = 'has x'").first()["count"] == 66_666


def test_claims_plan_holds_no_rules(spark):
    """Each pattern runs on distinct values; what is left in the plan is short and compiles."""
    claims = catalogue_feeds._claims(spark, SF)
    lookup = measures.claim_tables()
    assert {o for t in lookup for o in t.outputs} >= set(e2.GATED_COLUMNS)
    for df in measures.clean_claims(claims, dt.date(2025, 4, 1), strict=False)[::2]:
        plan = _plan(df)
        filters = [line for line in plan.splitlines() if "Filter" in line]
        assert filters and max(map(len, filters)) < 5_000
        assert "RLIKE" not in "".join(filters) and "(?i)maisonette" not in plan
    for name in ("claims_cleaning", "claims_offenders"):
        assert "BroadcastHashJoin" in _plan(entry.queries()[name](spark, SF))
