"""Plan-shape checks: the properties the design relies on at scale."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return re.sub(r"#\d+L?", "", buf.getvalue())


def test_first_per_key_limits_before_the_shuffle(spark):
    plan = _plan(entry.queries()["resolve_latest_events"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan  # hot keys are cut map-side


def test_master_is_one_aggregation(spark):
    plan = _plan(entry.queries()["master_assembly"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in plan


def test_flagship_reads_the_fact_table_once(spark):
    plan = _plan(entry.queries()["attribute_master"](spark, SF))
    assert plan.count("FileScan parquet [c_custkey,c_nationkey,c_mktsegment]") == 1


@pytest.mark.parametrize("name,pushed", [("population_semi", "o_orderstatus"),
                                         ("region_lookup_required", "n_regionkey")])
def test_filters_reach_the_scan(spark, name, pushed):
    plan = _plan(entry.queries()[name](spark, SF))
    assert any("PushedFilters" in line and pushed in line for line in plan.splitlines())


def test_scans_are_pruned(spark):
    plan = _plan(entry.queries()["resolve_latest_events"](spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan  # unused JSON column is never read


@pytest.mark.parametrize("name,hashed,scans,lookups", [
    ("attribute_master", 8, 8, 0), ("feed1_cleaning", 2, 3, 0), ("feed2_cleaning", 0, 1, 0),
    ("claims_cleaning", 3, 2, 8), ("master_refresh", 5, 4, 0), ("provenance_extract", 7, 13, 0)])
def test_exchanges_with_large_sides(spark, name, hashed, scans, lookups):
    """Shuffles, scans of tables, and lookups of classified values (broadcast after a count of
    them) of a plan in which no other side is small enough to broadcast."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        plan = _plan(entry.queries()[name](spark, SF))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    read = [line for line in plan.splitlines() if "FileScan" in line]
    values = [line for line in read if "classified-values" in line]
    assert plan.count("Exchange hashpartitioning") <= hashed and len(read) - len(values) <= scans
    assert plan.count("BroadcastExchange") == len(values) == lookups and "InMemoryTableScan" not in plan  # no hints, no cached tables
