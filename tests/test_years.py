"""Masters published in parts: only changed years are written, and the rows are those of a whole refresh."""

import datetime as dt
import glob
import os

import pytest
from abode.operators import sinks as S
from abode.plans import measures as E2
from abode.plans import runs
from abode.rules import e2
from abode.session import setting, staging

DAY = dt.date(2025, 4, 1)
MASTER = ", ".join(f"{c} string" for c in e2.MASTER_COLUMNS)
HISTORY = ", ".join(f"`{c}` string" for c in e2.HISTORY_COLUMNS)
GEO = [("bt11aa", "L1", "One", "P1"), ("bt22bb", "L2", "Two", "P2")]


def _master(spark, rows):
    """Rows of (FY, POSTCODE, STREET, LAUA_CODE, LAUA_NAME, PCON_CODE, PCON_NAME), other columns empty."""
    names = ["FY", "POSTCODE", "STREET", *E2.GEOGRAPHY_COLUMNS]
    full = [{c: "" for c in e2.MASTER_COLUMNS} | dict(zip(names, r)) for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in e2.MASTER_COLUMNS) for r in full], MASTER)


def _lookups(spark, geo=GEO):
    return (spark.createDataFrame(geo, "pcds string, LAUA_CODE string, LAUA_NAME string, PCON_CODE string"),
            spark.createDataFrame([("P1", "North", 1), ("P2", "South", 2)], "PCON24CD string, PCON24NM string, seq long"))


ONE, TWO = ("L1", "One", "P1", "North"), ("L2", "Two", "P2", "South")
PREVIOUS = [("FY2021", "BT1 1AA", "High Street", *ONE),
            ("FY2122", "BT2 2BB", "Low Street", "old", "Old", "old", "Old"),
            ("FY2223", "BT2 2BB", "low street, ,", *TWO),
            ("FY2324", "ZZ1 1ZZ", "Elsewhere", "x", "X", "x", "X"),
            (None, "BT1 1AA", "No Year", *ONE), ("", "BT1 1AA", "Empty Year", *ONE)]


def _rows(df):
    return sorted(map(str, df.select(*e2.MASTER_COLUMNS).collect()))


def test_changed_years(spark):
    geo, names = _lookups(spark)
    new = _master(spark, [("FY2425", "BT1 1AA", "New", *ONE)])
    assert E2.changed_years(_master(spark, PREVIOUS), new, geo, names) == ["FY2122", "FY2223", "FY2425"]
    twice, _ = _lookups(spark, [*GEO, GEO[0]])  # a postcode with two lookup rows multiplies its rows
    assert E2.changed_years(_master(spark, PREVIOUS), new, twice, names) == ["", "FY2021", "FY2122", "FY2223", "FY2425", None]
    assert E2.changed_years(_master(spark, []), _master(spark, []), geo, names) == []


def _start(spark, root, previous=PREVIOUS):
    history = spark.createDataFrame([("A", "B", "C", "D", "E", "F")], HISTORY)
    runs.import_masters(_master(spark, previous), history, root, DAY)


def _refresh(spark, root, new, replace=False, geo=GEO):
    with staging(spark) as stage:
        return runs.refresh_published(new, *_lookups(spark, geo), root, DAY, replace, stage)


def test_only_changed_years_are_written(spark, scratch):
    _start(spark, scratch)
    before = S.published_parts(S.current_versions(spark, scratch)["measures_master"])
    assert sorted(before) == sorted([*map(S.part_label, ["FY2021", "FY2122", "FY2223", "FY2324", "", None])])
    new = _master(spark, [("FY2425", "BT2 2BB", "b road", *TWO), ("FY2425", "BT1 1AA", "a road", *ONE)])
    now, years = _refresh(spark, scratch, new)
    after = S.published_parts(now["measures_master"])
    assert years == ["FY2122", "FY2223", "FY2425"]
    for label, folders in before.items():
        assert (after[label] == folders) == (label not in map(S.part_label, years))
    whole = E2.refresh_master(_master(spark, PREVIOUS), new, *_lookups(spark))
    assert _rows(S.read_published(spark, now["measures_master"])) == _rows(whole)
    # a second year: nothing else changes any more
    later = _master(spark, [("FY2526", "BT1 1AA", "C Road", *ONE)])
    again, years = _refresh(spark, scratch, later)
    assert years == ["FY2526"]
    assert _rows(S.read_published(spark, again["measures_master"])) == _rows(whole.union(later))
    assert S.read_published(spark, again["measures_history"]).count() == 1 + 2 + 1
    assert _rows(S.read_published(spark, again["measures_master"], ["FY2425", "FY1900"])) == _rows(whole.where("FY = 'FY2425'"))


def test_repeated_year_and_replacement(spark, scratch):
    _start(spark, scratch)
    new = _master(spark, [("FY2425", "BT1 1AA", "A Road", *ONE)])
    _refresh(spark, scratch, new)
    twice, _ = _refresh(spark, scratch, new)
    assert S.read_published(spark, twice["measures_master"]).where("FY = 'FY2425'").count() == 2
    assert S.read_published(spark, twice["measures_history"]).count() == 3
    once, _ = _refresh(spark, scratch, new, replace=True)
    assert S.read_published(spark, once["measures_master"]).where("FY = 'FY2425'").count() == 1
    assert S.read_published(spark, once["measures_history"]).count() == 2


def test_command_line_import(spark, scratch):
    from abode.__main__ import main

    _master(spark, PREVIOUS).write.parquet(f"{scratch}/master")
    spark.createDataFrame([], HISTORY).write.parquet(f"{scratch}/history")
    result = main(["import", "--input", f"master={scratch}/master", "--input", f"history={scratch}/history",
                   "--out", f"{scratch}/out", "--as-of", "2025-04-01"], spark=spark)
    assert result == S.current_versions(spark, f"{scratch}/out")
    assert _rows(S.read_published(spark, result["measures_master"])) == _rows(_master(spark, PREVIOUS))
    with pytest.raises(S.PublishConflict):  # masters are imported once
        runs.import_masters(_master(spark, PREVIOUS), spark.createDataFrame([], HISTORY), f"{scratch}/out", DAY)


def test_restore_and_conflict(spark, scratch):
    _start(spark, scratch)
    new = _master(spark, [("FY2425", "BT1 1AA", "A Road", *ONE)])
    _refresh(spark, scratch, new)
    with staging(spark) as stage, pytest.raises(S.PublishConflict):
        runs.refresh_published(new, *_lookups(spark), scratch, DAY, False, stage, expected=1)
    S.restore(spark, scratch, 1)
    assert _rows(S.read_published(spark, S.current_versions(spark, scratch)["measures_master"])) == _rows(_master(spark, PREVIOUS))


def test_empty_masters(spark, scratch):
    runs.import_masters(_master(spark, []), spark.createDataFrame([], HISTORY), scratch, DAY)
    now = S.current_versions(spark, scratch)
    assert S.published_parts(now["measures_master"]) == {}
    empty = S.read_published(spark, now["measures_master"])
    assert empty.columns == e2.MASTER_COLUMNS and empty.count() == 0
    now, years = _refresh(spark, scratch, _master(spark, []))
    assert years == [] and S.read_published(spark, now["measures_history"]).count() == 0


def test_rows_of_a_part_are_sorted(spark, scratch):
    rows = [("FY1" if i % 3 else "FY/2 =%", f"BT{(i * 7919) % 400:03d}", f"s {i}", *ONE) for i in range(3000)]
    runs.import_masters(_master(spark, rows).repartition(5), spark.createDataFrame([], HISTORY), scratch, DAY)
    parts = S.published_parts(S.current_versions(spark, scratch)["measures_master"])
    assert sorted(parts) == ["is-FY/2 =%", "is-FY1"]
    odd = S.read_published(spark, S.current_versions(spark, scratch)["measures_master"], ["FY/2 =%"])
    assert odd.count() == 1000 and {r.FY for r in odd.select("FY").distinct().collect()} == {"FY/2 =%"}
    for label, (folder,) in parts.items():
        codes = []
        for file in sorted(glob.glob(os.path.join(folder.removeprefix("file:"), "*.parquet"))):
            codes += [r.POSTCODE for r in spark.read.parquet(f"file:{file}").collect()]
        assert codes == sorted(codes) and len(codes) == sum(S.part_label(r[0]) == label for r in rows)


def test_a_frame_without_parts(spark, scratch):
    now = S.publish({"a": spark.range(3), "b": S.Parts(spark.range(4))}, scratch, DAY)
    assert S.read_published(spark, now["a"]).count() == 3 and S.read_published(spark, now["b"]).count() == 4
    assert list(S.published_parts(now["b"])) == ["none"] and S.published_parts(None) == {}
    with pytest.raises(ValueError):
        S.published_parts(now["a"])


def test_one_year_is_written_by_many_tasks(spark, scratch):
    """No task gets a whole year: neither without an order, nor where a third of all rows tie."""
    rows = spark.range(0, 60_000, 1, 4).selectExpr("id", "'FY1' AS FY", "if(id % 3 = 0, 'hot', concat('p', id)) AS place")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        now = S.publish({"plain": S.Parts(rows, "FY"), "sorted": S.Parts(rows, "FY", ("place",))}, scratch, DAY)
    for name in ("plain", "sorted"):
        (folder,) = S.published_parts(now[name])["is-FY1"]
        sizes = [r["count"] for r in spark.read.parquet(folder).groupBy("_metadata.file_path").count().collect()]
        assert sum(sizes) == 60_000 and len(sizes) >= 4 and max(sizes) <= 60_000 / 3
