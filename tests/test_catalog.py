"""Every query with SQL gives what DuckDB gives on the same tables."""

import os

import duckdb
import pytest

from lakeward import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


#: Queries whose rows come in an order that their SQL states in full.
ORDERED = [
    n for n in sorted(catalog.ORACLES) if n.startswith(("page_", "games_")) and "ORDER BY" in catalog.ORACLES[n].rpartition(")")[2] or n in ("dimension_sorted", "latest_runs", "run_history")
]


def plain(rows, ordered=False):
    out = [tuple(round(v, 8) + 0.0 if isinstance(v, float) else v for v in r) for r in rows]
    return out if ordered else sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    order = [want.columns.index(c) for c in columns]
    ordered = name in ORDERED
    assert plain(df.select(*columns).collect(), ordered) == plain([[r[i] for i in order] for r in want.fetchall()], ordered)


def test_pages_are_compared_in_order():
    assert len(ORDERED) > 10 and {n.partition("_")[0] for n in ORDERED} >= {"page", "games"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
