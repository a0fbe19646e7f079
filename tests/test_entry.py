"""The registered queries against their SQL, over the smallest tables; the modules that may be absent are not touched."""

import os

import duckdb
import pytest

from lectern.plans.oracles import ORACLES
from lectern.plans.queries import QUERIES

SF = os.environ.get("LECTERN_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(plain(v) for v in value) if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    rows = sorted((plain(tuple(r)) for r in frame.select(columns).collect()), key=repr)
    found = db.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert rows == wanted


def test_entry():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
