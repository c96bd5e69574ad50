"""Every query of the subpackage that SQL can state, against its SQL on the smallest tables."""

import os

import pytest

from foliant.llm import registry

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    out = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in out.description]
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in sorted(names))) for r in out.fetchall())
    got = sorted(repr(tuple(plain(r[c]) for c in sorted(df.columns))) for r in df.collect())
    assert sorted(df.columns) == sorted(names) and got == want
