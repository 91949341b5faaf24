import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(n for n in entry_points.oracle_sql() if not n.startswith("op"))


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    return "NULL" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_oracle(spark, sf, db, name):
    got = entry_points.queries()[name](spark, sf)
    want = db.sql(entry_points.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(tuple(map(_norm, r)) for r in got.select(*columns).collect())
    assert rows == sorted(tuple(map(_norm, r)) for r in want.select(*(f'"{c}"' for c in columns)).fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
