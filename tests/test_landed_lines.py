"""Landed files by split scans: places, cells with line breaks, types by guess."""

import csv
import datetime as dt
import os

import pytest

from abode.sources import lines
from abode.sources.landed import HeaderError, guess_types, guessed, misfits, read_landed
from abode.sources.lines import RecordError, landed_lines, landed_records


def _sheet(path, rows, banner=None, end="\r\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as fh:
        if banner:
            fh.write(banner + end)
        csv.writer(fh, lineterminator=end).writerows(rows)


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes."""
    changed = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ROWS = [[str(i), f"x, {i}\nline two of {i}\n\nlast" if i % 7 == 3 else f'say "{i}"' if i % 5 == 0 else "plain", "" if i % 3 else "end\n"] for i in range(400)]


def _want(rows):
    return [tuple(c or None for c in r) for r in rows]


def test_lines_of_split_files(spark, scratch, small_splits):
    folder = os.path.join(scratch, "texts")
    os.makedirs(folder)
    texts = {"b.csv": [f"line {i} " + "y" * (i % 90) for i in range(300)], "a.csv": ["only"], "c.csv": []}
    for name, own in texts.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join(own))
    assert spark.read.text(folder).rdd.getNumPartitions() > 20
    rows = landed_lines(spark, folder).orderBy("nth", "line").collect()
    assert [(r.nth, r.line, r.text) for r in rows] == [(1, 0, "only"), *((2, i, t) for i, t in enumerate(texts["b.csv"]))]


@pytest.mark.parametrize("most", [500_000, 0])
def test_quoted_line_breaks_stay_in_their_cells(spark, scratch, monkeypatch, most):
    """The same rows and places in one split and in many, on both paths."""
    monkeypatch.setattr(lines, "BROADCAST_LINES", most)
    folder = os.path.join(scratch, "sheets")
    os.makedirs(folder)
    _sheet(os.path.join(folder, "1.csv"), [["id", "note\nof the row", "more"], *ROWS], banner='"Title, with\r\na line break"')
    _sheet(os.path.join(folder, "2.csv"), [["id", "note\nof the row", "more"], ["900", "one\rtwo", "z"]], banner="Other", end="\n")
    seen = []
    for size in ("128m", "300b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            df = read_landed(spark, folder, banner_rows=1)
            assert df.columns == ["id", "note\nof the row", "more", "seq"]
            seen.append([tuple(r) for r in df.orderBy("seq").collect()])
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1]
    assert [r[:3] for r in seen[0]] == [*_want(ROWS), ("900", "one\ntwo", "z")]
    places = [r[3] for r in seen[0]]
    assert places == sorted(set(places)) and places[0] == 4 and places[-1] >> 32 == 1  # banner and header take two lines each


def test_open_quote_and_empty_inputs(spark, scratch):
    path = os.path.join(scratch, "open.csv")
    with open(path, "w") as fh:
        fh.write('a,b\n1,"never closed\n2,x\n')
    with pytest.raises(RecordError):
        read_landed(spark, path)
    empty = os.path.join(scratch, "empty.csv")
    open(empty, "w").close()
    assert landed_records(spark, empty).count() == 0
    folder = os.path.join(scratch, "mixed")
    os.makedirs(folder)
    _sheet(os.path.join(folder, "1.csv"), [["a", "b"], ["1", "2"]])
    open(os.path.join(folder, "2.csv"), "w").close()
    assert [tuple(r)[:2] for r in read_landed(spark, folder).collect()] == [("1", "2")]  # an empty file is no sheet
    _sheet(os.path.join(folder, "3.csv"), [["only a banner"]])
    with pytest.raises(HeaderError):
        read_landed(spark, folder, banner_rows=1)


def test_one_column_keeps_blank_lines(spark, scratch):
    path = os.path.join(scratch, "one.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("﻿name\nx\n\ny\n")
    df = read_landed(spark, path)
    assert df.columns == ["name", "seq"] and [r.name for r in df.orderBy("seq").collect()] == ["x", None, "y"]


def test_wide_encoding_is_read_whole(spark, scratch):
    path = os.path.join(scratch, "wide.csv")
    _sheet(path, [["a", "b"], ["é", "two\nlines"]], encoding="utf-16")
    assert [tuple(r)[:2] for r in read_landed(spark, path, encoding="UTF-16").collect()] == [("é", "two\nlines")]


def test_types_are_guessed(spark):
    rows = [(str(i), f"{i}.5", "TRUE" if i % 2 else "false", "2024-02-01" if i % 2 else "31/12/2023", f"{i}" if i else "x", "", str(i), i) for i in range(50)]
    rows += [("7", "8", None, " ", "2", None, "late text", 50), ("9", "1e3", "", "30/02/2024", "3", "", "5", 51)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, `g.h` string, seq long")
    want = {"a": "long", "b": "double", "c": "boolean", "d": "date", "e": "string", "f": "string", "g.h": "long"}
    for parts in (1, 4):
        assert guess_types(df.repartition(parts, "a"), rows=50) == want
    assert guess_types(df, rows=None) == want | {"g.h": "string", "d": "string"}
    got = guessed(df, rows=50)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "double", "boolean", "date", "string", "string", "bigint", "bigint"]
    late = got.where("seq = 50").first()
    assert late["g.h"] is None and late["a"] == 7 and late["d"] is None and got.first()["d"] == dt.date(2023, 12, 31)
    lost = {r.column: (r.type, r.n, r.first_seq, r.first_value) for r in misfits(df, want).collect()}
    assert lost == {"g.h": ("long", 1, 50, "late text"), "d": ("date", 1, 51, "30/02/2024")}
    assert guess_types(df.limit(0)) == dict.fromkeys(want, "string")
    assert misfits(df, {"e": "string"}).count() == 0
