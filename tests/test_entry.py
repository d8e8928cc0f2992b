import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    asked = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in asked.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    mine = sorted(repr(tuple(plain(r[c]) for c in order)) for r in got.collect())
    theirs = sorted(repr(tuple(plain(r[names.index(c)]) for c in order)) for r in asked.fetchall())
    assert mine == theirs
