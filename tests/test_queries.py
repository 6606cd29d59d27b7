"""Every registered query against its SQL on the given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from syncflow.plans import changes, checks, ingest, streams, targets

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


NAMES = sorted(name for module in (ingest, changes, checks, streams, targets) for name in module.QUERIES)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry_points.queries())
    assert set(NAMES) <= set(entry_points.oracle_sql())


def test_entry_gives_rows(spark):
    assert not entry_points.entry(spark).isEmpty()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry_points.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in at) for r in result.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
