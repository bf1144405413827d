"""Resolution semantics: latest / first / numeric / technology matrix, and
invariance to partitioning."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from abode.operators import reshape as R
from abode.operators import resolve as W

D1, D2 = dt.date(2019, 1, 1), dt.date(2020, 1, 1)
OBS_SCHEMA = "key long, attr string, value string, num double, ts date, source string, source_rank int, seq long"


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBS_SCHEMA)


def test_latest_equal_dates_warehouse_wins(spark):
    df = spark.createDataFrame([
        (1, "b", D2, "feed1", 1, 10), (1, "c", D2, "feed2", 2, 5), (1, "a", D2, "wh", 0, 99),
        (2, "x", None, "wh", 0, 1), (2, "y", D1, "feed2", 2, 2),
    ], "k long, v string, ts date, src string, source_rank int, seq long")
    got = {r.k: (r.v, r.src) for r in W.resolve_latest(df, "k", "v", "ts").collect()}
    assert got == {1: ("a", "wh"), 2: ("y", "feed2")}  # NULL date loses to any date


def test_latest_skips_excluded_newest(spark):
    df = spark.createDataFrame([(1, "Unknown", D2, 0, 1), (1, "Gas", D1, 0, 2)],
                               "k long, v string, ts date, source_rank int, seq long")
    assert W.resolve_latest(df, "k", "v", "ts", exclude=("Unknown",)).first().v == "Gas"


def test_first_policy_ignores_dates(spark):
    df = spark.createDataFrame([(1, "Floor A", D1, 1, 5), (1, "Floor B", D2, 2, 1)],
                               "k long, v string, ts date, source_rank int, seq long")
    assert W.resolve_first(df, "k", "v").first().v == "Floor A"  # older feed-1 beats newer feed-2


def test_latest_numeric_coalesces_first(spark):
    df = spark.createDataFrame([(1, None, 50.0, D2, 0, 1), (1, 70.0, None, D1, 0, 2), (1, None, None, D2, 0, 3)],
                               "k long, post double, pre double, ts date, source_rank int, seq long")
    r = W.resolve_latest_numeric(df, "k", "ts", "post", "pre", "SAP").first()
    assert r.SAP == 50.0 and r.ts == D2


def test_window_and_aggregate_methods_agree(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 37).alias("k"), (F.col("id") % 11).cast("string").alias("v"),
        F.date_add(F.lit(D1), (F.col("id") % 5).cast("int")).alias("ts"),
        (F.col("id") % 3).cast("int").alias("source_rank"), F.col("id").alias("seq"))
    order = [("ts", "desc"), ("source_rank", "asc"), ("seq", "asc")]
    a = W.pick_per_key(df, "k", order).orderBy("k").collect()
    b = W.pick_per_key(df, "k", order, method="window").orderBy("k").collect()
    assert a == b


def test_invariant_under_repartition(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 13).alias("k"), F.col("id").cast("string").alias("v"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.date_add(F.lit(D1), (F.col("id") % 4).cast("int"))).alias("ts"),
        (F.col("id") % 3).cast("int").alias("source_rank"), F.col("id").alias("seq"))
    base = sorted(W.resolve_latest(df, "k", "v", "ts").collect())
    for n in (1, 7, 31):
        assert sorted(W.resolve_latest(df.repartition(n), "k", "v", "ts").collect()) == base


def test_hot_key_is_resolved(spark):
    # one key holds a third of all rows; the pick is still exact
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"), F.lit(D1).alias("ts"),
        F.lit(1).alias("source_rank"), F.col("id").alias("seq"))
    r = W.resolve_latest(df, "k", "v", "ts").where("k = 0").first()
    assert r.v == "0"


def test_group_size_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k long, v string")
    sizes = {r.v: r.n for r in W.with_group_size(df, "k").collect()}
    assert sizes == {"a": 2, "b": 2, "c": 1, "d": 2, "e": 2}  # NULL keys form one group
    assert sorted(r.v for r in W.duplicated_rows(df, "k").collect()) == ["a", "b", "d", "e"]


def test_technology_matrix(spark):
    rows = [
        (1, "RENEWABLES", "ASHP", None, None, "feed1", 1, 1),
        (1, "RENEWABLES", "ASHP", None, D2, "feed2", 2, 2),      # twice: count 1, first source kept
        (1, "RENEWABLES", "SOLAR_PV", None, D1, "feed2", 2, 3),
        (2, "RENEWABLES", "Unknown", None, D1, "feed1", 1, 4),
        (3, "RENEWABLES", "BATTERY", None, D1, "feed1", 1, 5),
    ]
    m = R.technology_matrix(_obs(spark, rows), ["SOLAR_PV", "BATTERY", "ASHP", "BIO_BOILER", "SOLAR_THERMAL"])
    got = {r.key: r for r in m.collect()}
    assert set(got) == {1, 3}
    r1 = got[1]
    assert (r1.ASHP, r1.SOLAR_PV, r1.BATTERY, r1.BIO_BOILER, r1.RENEWABLE_COUNT) == ("Yes", "Yes", "", "", 2)
    assert r1.ASHP_SOURCE == "feed1" and r1.ASHP_TIMESTAMP is None  # first row's NULL date stays NULL
    assert r1.BATTERY_SOURCE == "" and "SOLAR_THERMAL_TIMESTAMP" in m.columns


def test_resolve_wide_one_shuffle(spark):
    rows = [(k, "A", str(k), None, D1, "s", 0, k) for k in range(50)]
    wide = R.resolve_wide(_obs(spark, rows), [R.AttributeSpec("A", "A_NAME")])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        wide.explain()
    assert buf.getvalue().count("Exchange hashpartitioning") <= 1


def test_order_that_is_no_number_stops_the_run(spark):
    from abode.operators.columns import order_number
    from abode.plans.runs import ordered

    df = spark.createDataFrame([("1", "2"), ("2", "10")], "UPRN string, seq string")
    assert [r.seq for r in ordered(df).orderBy("seq").collect()] == [2, 10]
    for bad in ("x", None, "1.5.2"):
        broken = df.union(spark.createDataFrame([("3", bad)], df.schema))
        with pytest.raises(Exception, match="seq is no number"):
            broken.select(order_number("seq")).collect()
