"""Driver contract: entry smoke, query/oracle pairing, and every query
checked against its SQL oracle on the smallest driver tables."""

import datetime as dt
import os
import re
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_runs(spark):
    from abode.rules import e1

    df = entry.entry(spark)
    assert df.columns == e1.MASTER_COLUMNS + ["DATA_COUNT"]
    assert df.count() > 0


#: Queries of the optional corpus operators have tests of their own.
OWN = sorted(n for n in entry.queries() if n != "pipeline" and not n.startswith("op"))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


def _canon(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = duck.execute(entry.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    cols = sorted(got.column_names)

    def rows(t):
        data = [t.column(c).to_pylist() for c in cols]
        return sorted((tuple(_canon(v) for v in r) for r in zip(*data)), key=repr)

    assert rows(got) == rows(want)


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_corpus_operators(scratch, pipeline):
    """Both folders of the corpus operators gone, with or without the pipeline's module."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    gone = {os.path.join(root, "abode", "llm"), os.path.join(root, "tests", "llm")} | ({os.path.join(root, "corpus_pipeline.py")} if not pipeline else set())
    skip = {".git", "__pycache__", ".pytest_cache"}
    copy = shutil.copytree(root, os.path.join(scratch, "copy"),
                           ignore=lambda folder, names: [n for n in names if n in skip or os.path.join(folder, n) in gone])
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *e.queries())"],
                          cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": copy})
    assert said.returncode == 0, said.stderr
    own = {n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert set(said.stdout.split()[2:]) == own and said.stdout.split()[:2] == [str(len(own))] * 2
