"""Every registered query against its DuckDB form on the smallest tables."""

import math

import duckdb
import pytest

from docloom.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name in ORACLE_SQL:
        cur = duck.execute(ORACLE_SQL[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == columns
        assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=str)
    else:
        assert len(df.columns) > 1
