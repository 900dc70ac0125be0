"""Every query with SQL gives the rows of its SQL on the smallest tables; every query runs."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
SLOW = {"clean_app_records", "semantic_types"}


def rows(frame):
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
            return None
        v = v.item() if hasattr(v, "item") else v
        return float(f"{float(v):.9g}") if isinstance(v, float) or type(v).__name__ == "Decimal" else v

    return sorted((tuple(value(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def database():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, database, name):
    got, wanted = entry.queries()[name](spark, FOLDER).toPandas(), database.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns) and rows(got) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).columns


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
