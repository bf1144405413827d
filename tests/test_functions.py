"""Text, number and date expressions against the FIXTURES.md cases."""

import datetime as dt

from pyspark.sql import functions as F

from abode.functions import dates as D
from abode.functions import text as X
from abode.functions.numbers import to_key, to_number


def _one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_squish_unicode_whitespace(spark):
    out = _one_col(spark, ["  a   b\t\nc  ", None, " x　"], X.squish)
    assert out == ["a b c", None, "x"]


def test_title_case_addresses(spark):
    cases = ["12 HIGH-STREET , ,", "o'neill park", "10A main  st", None]
    out = _one_col(spark, cases, X.tidy_address)
    assert out == ["12 High-Street", "O'neill Park", "10a Main St", None]


def test_blank_and_membership(spark):
    out = _one_col(spark, [None, "", " ", "x"], X.is_blank)
    assert out == [True, True, True, False]
    out = _one_col(spark, [None, "a", "b"], lambda c: X.null_safe_isin(c, ["a"]))
    assert out == [False, True, False]


def test_paste_na_and_postcode_key(spark):
    df = spark.createDataFrame([("a", None, "BT1 2AB")], "x string, y string, pc string")
    row = df.select(X.paste_na("x", "y").alias("p"), X.postcode_key("pc").alias("k"),
                    X.strip_postcode_noise(F.lit(' B T"1?')).alias("s")).first()
    assert (row.p, row.k, row.s) == ("aNA", "bt12ab", "BT1")


def test_to_number_guards(spark):
    out = _one_col(spark, ["1950", " 12.5 ", "1950d", "NaN", "Infinity", "abc", None, "1e3"], to_number)
    assert out == [1950.0, 12.5, None, None, None, None, None, 1000.0]
    out = _one_col(spark, ["123456789012", "12.5", "#N/A"], to_key)
    assert out == [123456789012, None, None]


FEED1_CASES = [
    # text, programme year text, expected date, expected YEAR
    ("05/06/2019", None, dt.date(2019, 6, 5), "2019"),
    ("5/6/2019", None, dt.date(2019, 6, 5), "2019"),
    ("05.06.2019", None, dt.date(2019, 6, 5), "2019"),
    ("01/1/2020 10:00", None, dt.date(2020, 1, 1), "2020"),
    ("01/01/2020 10:00", "2018/19", dt.date(2018, 1, 1), "2018"),
    ("43500", None, dt.date(2019, 2, 2), "2019"),
    ("39641", None, dt.date(2015, 1, 1), "2008"),
    ("42500", "2018/19", dt.date(2018, 1, 1), "2018"),
    ("31/02/2020", "2018/19", dt.date(2018, 1, 1), "2018"),
    ("31/02/2020", None, dt.date(2015, 1, 1), None),
    ("Wk com 18/10/2021", None, dt.date(2020, 10, 18), "2020"),
    ("30/09/2106", None, dt.date(2016, 9, 30), "2016"),
    (None, "FY1819", dt.date(2015, 1, 1), "1819"),
    (None, None, dt.date(2015, 1, 1), None),
]


def test_feed1_date_repair(spark):
    df = spark.createDataFrame([(i, t, p) for i, (t, p, _, _) in enumerate(FEED1_CASES)],
                               "i int, t string, p string")
    got = D.with_dmy_dates(df, "t", D.year_start("p"), "ts", "y").orderBy("i").collect()
    assert [(r.ts, r.y) for r in got] == [(d, y) for _, _, d, y in FEED1_CASES]


FEED2_CASES = [
    ("2020-05-01", dt.date(2020, 5, 1), "2020"),
    ("5/6/2019", dt.date(2015, 1, 1), "2015"),
    ("2008-02-03", dt.date(2015, 1, 1), "2008"),
    ("2020-02-31", None, None),
    (None, dt.date(2015, 1, 1), "2015"),
]


def test_feed2_date_repair(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(FEED2_CASES)], "i int, t string")
    got = D.with_iso_dates(df, "t", "ts", "y").orderBy("i").collect()
    assert [(r.ts, r.y) for r in got] == [(d, y) for _, d, y in FEED2_CASES]


def test_warehouse_cap_and_labels(spark):
    df = spark.createDataFrame([(dt.date(2016, 3, 1),), (dt.date(2015, 12, 31),), (None,)], "d date")
    out = [r[0] for r in df.select(D.cap_year("d", 2015, "2000-01-01")).collect()]
    assert out == [dt.date(2000, 1, 1), dt.date(2015, 12, 31), None]
    assert D.fiscal_label(dt.date(2025, 4, 1)) == "2425"
    assert D.fiscal_label(dt.date(2010, 4, 1)) == "0910"


def test_not_day_first(spark):
    out = _one_col(spark, ["05/06/2019", "2019-06-05", "", None, "5/6/2019"], D.not_day_first)
    assert out == [False, True, True, True, True]


def test_staged_date_steps_match_column_versions(spark):
    df = spark.createDataFrame([(i, t, p) for i, (t, p, _, _) in enumerate(FEED1_CASES)],
                               "i int, t string, p string")
    staged = D.with_dmy_dates(df.withColumn("pd", D.year_start("p")), "t", F.col("pd"), "ts", "y")
    assert [(r.ts, r.y) for r in staged.orderBy("i").collect()] == [(d, y) for _, _, d, y in FEED1_CASES]
    df2 = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(FEED2_CASES)], "i int, t string")
    staged2 = D.with_iso_dates(df2, "t", "ts", "y")
    assert [(r.ts, r.y) for r in staged2.orderBy("i").collect()] == [(d, y) for _, d, y in FEED2_CASES]
