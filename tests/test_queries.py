"""Every registered query of the catalog against its SQL on the smallest tables."""

import duckdb
import pytest

from entitymart import queries as q

DIR = "/root/testdata/sf0.001"
SQL = q.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in "nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query(spark, con, name):
    df = q.queries()[name](spark, DIR)
    rows = df.collect()
    if name in SQL:
        cur = con.execute(SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert canonical(df.columns, rows) == canonical(names, cur.fetchall())
    else:
        assert rows


def test_registry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
