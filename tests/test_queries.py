"""Every named query against its SQL counterpart in DuckDB, on the smallest test tables."""

import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from jobsieve import constants as C

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


def _duck(folder):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in folder.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.fixture(scope="module")
def duck():
    return _duck(SF_DIR)


def _counted(rows):
    return Counter(tuple("\0" if v is None or v != v else str(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_parity(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = _counted([row[i] for i in order] for row in found.fetchall())
    assert _counted(df.select(*[f"`{c}`" for c in columns]).collect()) == expected
    assert math.fsum(expected.values()) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, name):
    assert not QUERIES[name](spark, str(SF_DIR)).isEmpty()


def test_every_outcome_occurs():
    found = {r[0] for r in _duck(SF_DIR.parent / "sf0.01").execute(SQL["skip_counts"]).fetchall()}
    reasons = {v for k, v in vars(C).items() if k.startswith("GATE_") or k in (
        "ATTACHMENT_ONLY", "PROFILE_PAGE", "APPLY_FORM", "CLOSED_PAGE", "MODEL_REFUSED", "SAME_PAGE_NO_TITLE", "SAME_PAGE_NO_DESCRIPTION",
        "SAME_PAGE_BOARD", "SAME_PAGE_NO_URL",
    )}
    # A description that passed on its page passes the gate again, and an accepted row always has a URL.
    assert reasons - found <= {C.GATE_DESCRIPTION, C.GATE_NO_URL}
    assert "" in found


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "doc_id", "List", "company_domain", "company_name", "job_title", "job_url", "job_description_length",
    ]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
