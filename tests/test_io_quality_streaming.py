"""Sources, sinks, quality operators and the claims stream (round trips in scratch folders)."""

import contextlib
import csv
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F

from abode.operators import columns as P
from abode.operators import quality as Q
from abode.operators import sinks as S
from abode.plans import measures as E2
from abode.rules import e2
from abode.session import stage_table
from abode.sources.landed import HeaderError, normalise_headers, peek_header, read_landed
from abode.streaming.claims import start_claims_stream


def _write_csv(path, header, rows, banner=None):
    with open(path, "w", newline="") as fh:
        if banner:
            fh.write(banner + "\n")
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_read_landed_with_banner(spark, scratch):
    path = os.path.join(scratch, "claims.csv")
    _write_csv(path, ["Postcode", "House type"], [["BT1 1AA", "Detached"], ["", "Flat, top"]],
               banner="Claims Master - Domestic")
    assert peek_header(spark, path, banner_rows=1) == ["Postcode", "House type"]
    df = read_landed(spark, path, banner_rows=1)
    rows = sorted(((r["Postcode"], r["House type"]) for r in df.collect()), key=lambda t: (t[0] or "", t[1]))
    assert rows == [(None, "Flat, top"), ("BT1 1AA", "Detached")]
    assert "seq" in df.columns


def test_read_landed_drops_lines_by_place(spark, scratch):
    folder = os.path.join(scratch, "sheets")
    os.makedirs(folder)
    rows = [["Title", "", ""], ["A, total", "B", "C"], ["", "", ""], ["1", "2, x", ""]]
    _write_csv(os.path.join(folder, "a.csv"), ["A, total", "B", "C"], rows, banner="Title,,")
    _write_csv(os.path.join(folder, "b.csv"), ["A, total", "B", "C"], [["9", "8", "7"]], banner="Other banner")
    df = read_landed(spark, folder, banner_rows=1)
    got = [tuple(r)[:3] for r in df.orderBy("seq").collect()]
    # rows that look like the banner or the header are data; the banner of the second file is not
    assert got == [("Title", None, None), ("A, total", "B", "C"), (None, None, None), ("1", "2, x", None), ("9", "8", "7")]
    seqs = [r.seq for r in df.orderBy("seq").collect()]
    assert [r.seq for r in read_landed(spark, folder, banner_rows=1).repartition(5).orderBy("seq").collect()] == seqs
    assert peek_header(spark, folder, banner_rows=1) == ["A, total", "B", "C"]
    _write_csv(os.path.join(folder, "c.csv"), ["A", "B"], [["1", "2"]], banner="x")
    with pytest.raises(HeaderError):
        read_landed(spark, folder, banner_rows=1)
    with pytest.raises(HeaderError):
        read_landed(spark, os.path.join(folder, "a.csv"), columns=["X"], banner_rows=1)


def test_session_keeps_what_is_set(spark):
    from abode.session import build_session

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert build_session("local[1]").conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_staged_folders_go_with_the_run(spark):
    from abode.session import checkpoint_root, staging

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with staging(spark) as stage:
        assert stage(spark.range(5), "kept-for-a-while").count() == 5
        assert set(os.listdir(root)) - before
    assert set(os.listdir(root)) == before


def test_normalise_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`Completion.Date..(of.measure)` int, `  Tenure ` int")
    assert normalise_headers(df).columns == ["Completion Date (of measure)", "Tenure"]
    with pytest.raises(ValueError):
        normalise_headers(spark.createDataFrame([(1, 2)], "`a.b` int, `a b` int"))


def test_sinks_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'say "hi"', "x")], "k long, v string, w string")
    p1 = S.write_attribute_csv(df, os.path.join(scratch, "attr"))
    back = spark.read.option("header", "true").option("escape", '"').option("nullValue", "NA").csv(p1)
    assert sorted(tuple(r) for r in back.collect()) == [("1", "a,b", None), ("2", 'say "hi"', "x")]
    p2 = S.write_tsv(P.blank_nulls(df), os.path.join(scratch, "master"))
    text = "".join(open(os.path.join(p2, f)).read() for f in sorted(os.listdir(p2)) if f.endswith(".csv"))
    assert "1\ta,b\t\n" in text
    p3 = S.write_quoted_csv(df, os.path.join(scratch, "extract"))
    text = "".join(open(os.path.join(p3, f)).read() for f in os.listdir(p3) if f.endswith(".csv"))
    assert '"say ""hi"""' in text and '"1"' in text


def test_publish_versions(spark, scratch):
    df = spark.createDataFrame([(1,)], "k long")
    assert S.current_versions(spark, scratch) == {}
    first = S.publish({"a": df, "b": df}, scratch, dt.date(2025, 4, 1))
    assert S.current_versions(spark, scratch) == first
    second = S.publish({"a": df.union(df), "b": df}, scratch, dt.date(2025, 4, 1))  # the same day again
    assert S.current_versions(spark, scratch) == second != first
    assert spark.read.parquet(second["a"]).count() == 2 and spark.read.parquet(first["a"]).count() == 1  # the archive
    broken = df.select(F.raise_error(F.lit("lost")).alias("k"))
    with pytest.raises(Exception):
        S.publish({"a": df, "b": broken}, scratch, dt.date(2026, 4, 1))
    assert S.current_versions(spark, scratch) == second  # both or none


def test_stage_table_cuts_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = stage_table(df, "t")
    assert staged.count() == 10
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        staged.explain()
    assert "FileScan parquet" in buf.getvalue() and "Range" not in buf.getvalue()


def test_profiles_and_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (3, "a")], "k long, v string")
    p = Q.profile_counts(df, "k").first()
    assert (p.n_rows, p.n_keys, p.n_duplicates) == (5, 3, 2)
    freq = {(r.column, r.value): r.n for r in Q.frequency(df, ["v"]).collect()}
    assert freq[("v", None)] == 1 and freq[("v", "a")] == 2
    assert ("v", None) not in {(r.column, r.value) for r in Q.frequency(df, ["v"], keep_null=False).collect()}
    s = Q.five_number(spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "x double"), "x", exact=True).first()
    assert (s.min, s.q1, s.median, s.q3, s.max, s.mean) == (1.0, 2.0, 3.0, 4.0, 10.0, 4.0)
    assert Q.check_columns(df, ["k"], strict=False) == ["v"]
    with pytest.raises(Q.GateError):
        Q.check_columns(df, ["k"])
    with pytest.raises(Q.GateError):
        Q.assert_unique(df, "k")
    assert sorted(r.value for r in Q.unseen_values(df, "v", ["a"]).collect()) == ["b", "c"]


def test_drop_matching(spark):
    df = spark.createDataFrame([(1, "s", None, "v")], "UPRN long, SOURCE_X string, x_timestamp date, VALUE string")
    assert P.drop_matching(df, "(SOURCE|TIMESTAMP)").columns == ["UPRN", "VALUE"]


def test_prefix_suffix_rename(spark):
    df = spark.createDataFrame([(1, None, "s")], "UPRN long, ASHP_TIMESTAMP date, ASHP_SOURCE string")
    out = P.prefix_suffix_rename(df, ["TIMESTAMP", "SOURCE"], ["ASHP"])
    assert out.columns == ["UPRN", "TIMESTAMP_ASHP", "SOURCE_ASHP"]


def test_claims_stream(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    header = list(e2.CLAIM_COLUMNS)

    def claim(dup, postcode, house="Detached"):
        row = {c: "" for c in header}
        row.update({"Duplicate address check": dup, "Postcode": postcode, "House type": house, "Tenure": "Owner",
                    "Year built": "1950", "No. bedrooms": "3", "Wall Insulation Category": "Cavity",
                    "Wall insulation type": "Full", "Predominant LI - depth": "Loft Insulation 100-300mm",
                    "Fuel type before install": "Oil", "New fuel type installed": "Gas",
                    "New heating type installed": "Combi boiler", "Total cost H.W.T. J (£)": "10"})
        row["Remove"] = None
        return [row[c] for c in header]

    _write_csv(os.path.join(landing, "year1.csv"), header, [claim("a", "BT1 1AA"), claim("b", "BT1 1AA", "Terrace")])
    directory = spark.createDataFrame([("BT1 1AA", "N09000003", "P1")], "pcds string, lad25cd string, pcon24cd string")
    geo = E2.postcode_geography(directory)
    names = spark.createDataFrame([("P1", "Belfast East", 0)], "PCON24CD string, PCON24NM string, seq long")
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    q = start_claims_stream(spark, landing, out, ckpt, dt.date(2025, 4, 1), geo, names)
    q.awaitTermination(120)
    measures = spark.read.parquet(os.path.join(out, "measures"))
    assert measures.select("Postcode").distinct().count() == 1
    first = measures.count()
    assert spark.read.parquet(os.path.join(out, "offenders")).count() == 1  # the "Terrace" claim
    _write_csv(os.path.join(landing, "year2.csv"), header, [claim("c", "BT1 1AA")])
    q = start_claims_stream(spark, landing, out, ckpt, dt.date(2026, 4, 1), geo, names)
    q.awaitTermination(120)
    measures = spark.read.parquet(os.path.join(out, "measures"))
    assert measures.count() > first and measures.select("batch_id").distinct().count() == 2


def test_read_lookup_csv(spark, scratch):
    from abode.sources.landed import read_lookup_csv

    path = os.path.join(scratch, "onsud.csv")
    _write_csv(path, ["UPRN", "LAD", "PCON24CD"], [["100000000001", "x", "S14000001"], ["bad", "y", "S14000002"]])
    df = read_lookup_csv(spark, path, {"UPRN": "double", "PCON24CD": "string"})
    assert df.columns == ["UPRN", "PCON24CD"]
    assert sorted(df.collect(), key=lambda r: r.PCON24CD) == [(100000000001.0, "S14000001"), (None, "S14000002")]


def test_five_number_approx(spark):
    df = spark.range(0, 1001).selectExpr("CAST(id AS DOUBLE) AS x")
    s = Q.five_number(df, "x", exact=False).first()
    assert (s.min, s.median, s.max) == (0.0, 500.0, 1000.0) and abs(s.q1 - 250.0) <= 1
