"""Every registered query that has an SQL twin against it."""

import duckdb
import pytest

from check_oracle import TABLES, canon
from tabwright import catalog


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    rel = con.execute(catalog.ORACLE[name])
    cols = [d[0] for d in rel.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, rel.fetchall())


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
