"""Observations side by side: the same winners and counts as a row for each, and code that HotSpot compiles."""

import contextlib
import datetime as dt
import io
import random
import re

import pytest

import __spark_entry__ as entry
from abode.functions import text as X
from abode.operators import reshape as R
from abode.plans import attributes as E1

SF = "/root/testdata/sf0.001"
FIELDS = "key long, ts date, source string, source_rank int, seq long, tenure string, loft string, floor string, tech string, score double"
ATTRS = {"PROPERTY_TENURE": "tenure", "LOFT_INSULATION": "loft", "FLOOR_INSULATION": "floor", "RENEWABLES": "tech"}


def _rows(seed, n=400):
    rnd = random.Random(seed)
    pick = lambda *values: rnd.choice([None, "Unknown", *values])
    return [(rnd.choice([None, *range(60)]), rnd.choice([None, dt.date(2020, 1, rnd.randrange(1, 4))]), f"s{seq % 3}", seq % 3, seq,
             pick("Owner", "Rented", "Other"), pick("Loft"), pick("Solid", "Suspended"), pick("ASHP", "BATTERY", "ODD"),
             rnd.choice([None, float(seq)])) for seq in range(n)] + [(900, None, "s", 0, 1, "Unknown", None, None, "Other", None),
                                                                     (901, None, "s", 0, 2, None, None, None, "ODD", None)]


def _both(df):
    names = [s.name for s in E1.attribute_specs()] + ["RENEWABLES"]
    df = df.selectExpr("*", "CAST(NULL AS DOUBLE) AS bill")
    numeric = {"SAP_SCORE": "score", "SAP_FUEL_BILL": "bill"}
    long = R.to_observations(df, "key", "ts", ATTRS, source="source", numeric=numeric, exclude=E1.excluded_values())
    rows = R.to_observed_rows(df, "key", "ts", ATTRS, names, source="source", numeric=numeric, exclude=E1.excluded_values())
    return long, rows


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_resolve_like_single_observations(spark, seed):
    long, rows = _both(spark.createDataFrame(_rows(seed), FIELDS).repartition(5))
    want, got = E1.resolve_attributes(long, counts=True), E1.resolve_attributes(rows, counts=True)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    keys = {r.UPRN for r in got.collect()}
    assert 900 not in keys and 901 in keys  # without an observation; with one of an unlisted technology
    assert sorted(E1.duplicate_report(rows).collect()) == sorted(E1.duplicate_report(long).collect())
    assert E1.duplicate_report(rows.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["attribute_master", "duplicates_before_resolution", "timestamped_master"])
def test_no_row_is_made_of_an_observation(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry.queries()[name](spark, SF).explain()
    made = [line for line in buf.getvalue().splitlines() if "Generate explode" in line]
    # the warehouse's codes become rows; the cells of feeds don't, and totals only after all counting
    assert not any("WALL_CONSTRUCTION" in line and "rows_WALL_CONSTRUCTION" not in line for line in made)
    assert "partial_min_by" not in buf.getvalue()  # one struct a winner, not order and payload


def test_feed_cleaning_compiles(spark):
    """No generated method of the feed is above 8000 bytes of code, HotSpot's limit, in a session that cuts none."""
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            entry.queries()["feed2_cleaning"](spark, SF).explain("codegen")
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue())]
    assert sizes and max(sizes) < 8000


def test_words_in_any_white_space(spark):
    cells = ["yes", "YES", " Yes ", " yes\t", "　 yEs\n", "y es", "yess", "no", "", None, "yes yes", "oh yes"]
    got = spark.createDataFrame([(c,) for c in cells], "c string").select(X.is_word("c", "yes")).collect()
    assert [r[0] for r in got] == [True] * 5 + [False] * 7
