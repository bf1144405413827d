"""Numbered publications, reports as one file, exact quantiles, kept resolve state."""

import csv
import datetime as dt
import os
import random
import statistics

import pytest
from abode.operators import quality as Q
from abode.operators import reshape as R
from abode.operators import sinks as S
from abode.plans import runs

DAY = dt.date(2025, 4, 1)


def test_two_publishers_of_which_one_fails(spark, scratch):
    df = spark.createDataFrame([(1,)], "k long")
    S.publish({"a": df}, scratch, DAY)
    read = S.publication_number(spark, scratch)  # both publishers start from here
    won = S.publish({"a": df.union(df)}, scratch, DAY, expected=read)
    with pytest.raises(S.PublishConflict):
        S.publish({"a": df.limit(0)}, scratch, DAY, expected=read)
    assert S.current_versions(spark, scratch) == won and S.publication_number(spark, scratch) == 2
    assert not [n for n in os.listdir(os.path.join(scratch, "publications")) if not n.isdigit() and not n.startswith(".")]


def test_last_moment_conflict(spark, scratch, monkeypatch):
    """The number is taken between the look at the log and the rename."""
    df = spark.createDataFrame([(1,)], "k long")
    first = S.publish({"a": df}, scratch, DAY)
    second = S.publish({"a": df}, scratch, DAY)
    monkeypatch.setattr(S, "publication_number", lambda spark, root: 1)
    with pytest.raises(S.PublishConflict):
        S.publish({"a": df}, scratch, DAY)
    monkeypatch.undo()
    assert [v for _, v in S.publications(spark, scratch)] == [first, second]


def test_restore_an_archived_version(spark, scratch):
    frames = [spark.range(n) for n in (1, 2, 3)]
    made = [S.publish({"a": f}, scratch, DAY) for f in frames]
    assert S.restore(spark, scratch, 1) == made[0] == S.current_versions(spark, scratch)
    assert spark.read.parquet(S.current_versions(spark, scratch)["a"]).count() == 1
    assert [n for n, _ in S.publications(spark, scratch)] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        S.restore(spark, scratch, 9)
    with pytest.raises(S.PublishConflict):
        S.restore(spark, scratch, 2, expected=3)


@pytest.mark.parametrize("encoding", ["UTF-8", "windows-1252"])
def test_report_is_one_file(spark, scratch, encoding):
    rows = [(i, f'café "{i}", x' if i % 3 else None, "") for i in range(500)]
    df = spark.createDataFrame(rows, "`the key` long, `a 'b'` string, c string").repartition(7).orderBy("the key")
    path = os.path.join(scratch, "out", "report.csv")
    for _ in range(2):  # a second report replaces the first
        S.write_one_file(df, path, encoding=encoding)
    assert sorted(n for n in os.listdir(os.path.dirname(path)) if not n.startswith(".")) == ["report.csv"]
    with open(path, encoding=encoding, newline="") as fh:
        got = list(csv.reader(fh))
    assert got == [["the key", "a 'b'", "c"], *([str(k), v or "", ""] for k, v, _ in rows)]
    S.write_one_file(df.limit(0), path, encoding=encoding)
    assert open(path, encoding=encoding).read().count("\n") == 1


@pytest.mark.parametrize("most", [10_000, 50, 1])
def test_exact_quantiles(spark, most):
    rnd = random.Random(most)
    sample = [rnd.gauss(0, 1) for _ in range(3000)] + [0.0] * 4000 + [1e9] * 2500 + [-5.5] * 10
    df = spark.createDataFrame([(x,) for x in sample] + [(None,)], "`a.b` double").repartition(5)
    probabilities = [0, 0.001, 0.1, 0.25, 1 / 3, 0.5, 0.7, 0.74, 0.9, 1]
    got = Q.exact_quantiles(df, "a.b", probabilities, most)
    ordered = sorted(sample)
    for p in probabilities:
        at = p * (len(ordered) - 1)
        low, high = ordered[int(at)], ordered[min(len(ordered) - 1, int(at) + 1)]
        assert got[p] == pytest.approx(low + (at - int(at)) * (high - low), rel=1e-12), p
    assert got[0.5] == statistics.median(sample)


def test_quantiles_of_few_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert Q.exact_quantiles(df, "x", [0.5]) == {0.5: None}
    assert Q.exact_quantiles(spark.createDataFrame([(7.0,)], "x double"), "x", [0.0, 0.5, 1.0]) == {0.0: 7.0, 0.5: 7.0, 1.0: 7.0}


SPECS = [R.AttributeSpec("A", "A"), R.AttributeSpec("B", "B", "first"), R.AttributeSpec("N", "N", numeric=True)]


def _observed(seed, n):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        attr = rnd.choice(["A", "B", "N", "RENEWABLES"])
        day = rnd.choice([None, dt.date(2020, 1, rnd.randrange(1, 5))])
        value = rnd.choice(["PV", "HEAT", "ODD"]) if attr == "RENEWABLES" else None if attr == "N" else f"v{rnd.randrange(9)}"
        key = rnd.choice([None, 1, 1, 1, *range(2, 30)])
        rows.append((key, attr, value, float(seq) if attr == "N" else None, day, f"s{seq % 3}", seq % 3, seq))
    return rows


OBS = "key long, attr string, value string, num double, ts date, source string, source_rank int, seq long"


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_state_of_states_resolves_like_everything(spark, parts):
    rows = _observed(parts, 600)
    techs = ["PV", "HEAT"]
    want = R.resolve_wide(spark.createDataFrame(rows, OBS).where("key IS NOT NULL"), SPECS, techs)
    cut = [rows[i::parts] for i in range(parts)]
    state = R.observation_state(spark.createDataFrame(cut[0], OBS), SPECS, techs)
    for more in cut[1:]:
        state = R.merge_observations(state, spark.createDataFrame(more, OBS), SPECS, techs)
    assert state.count() < len(rows)
    keys = {r.key for r in state.collect()}
    got = R.resolve_wide(state, SPECS, techs)
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in want.collect() if r.key in keys)


def test_attribute_update_merges_the_published_state(spark, scratch):
    from abode.plans import attributes as E1

    def feed(rows):
        return spark.createDataFrame(rows, OBS)

    d = dt.date
    old = [(1, "PROPERTY_TENURE", "Owner Occupier", None, d(2020, 1, 1), "a", 0, 1), (2, "SAP_SCORE", None, 60.0, d(2020, 1, 1), "a", 0, 2)]
    new = [(1, "PROPERTY_TENURE", "Privately Rented", None, d(2021, 1, 1), "a", 0, 3), (3, "RENEWABLES", "SOLAR_PV", None, d(2021, 1, 1), "a", 0, 4)]
    runs.run_attribute_update(feed(old), scratch, DAY)
    paths = runs.run_attribute_update(feed(new), scratch, DAY)
    got, want = spark.read.parquet(paths["attribute_wide"]), E1.resolve_attributes(feed(old + new))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert S.publication_number(spark, scratch) == 2
    assert spark.read.parquet(paths["attribute_state"]).count() == 3
