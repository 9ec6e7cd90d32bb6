"""Every query that SQL can express gives the rows of its DuckDB twin."""

import duckdb
import pytest

from tallyforge.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v if v is None or isinstance(v, int) else str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(name, spark, sf, duck):
    df = registry.queries()[name](spark, sf)
    got = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr) == want
