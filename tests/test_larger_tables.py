"""Queries against their SQL twins over tables with keys that the given small ones don't reach."""

import os

import duckdb
import pytest

from lotline.registry import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def same(spark, tmp_path):
    """same(query, table=SQL over the small tables, ...): a query and its twin give the same rows, the named tables replaced."""

    def check(name: str, **made: str) -> int:
        con = duckdb.connect()
        for t in (f.removesuffix(".parquet") for f in os.listdir(SMALL)):
            con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
        for t in (f.removesuffix(".parquet") for f in os.listdir(SMALL)):
            con.execute(f"copy ({made.get(t, f'select * from {t}')}) to '{tmp_path}/{t}.parquet' (format parquet)")
        for t in made:
            con.execute(f"create or replace view {t} as select * from '{tmp_path}/{t}.parquet'")
        df = QUERIES[name](spark, str(tmp_path))
        cols = sorted(df.columns)
        got = sorted((tuple(None if r[c] is None else str(r[c]) for c in cols) for r in df.collect()), key=repr)
        want = sorted((tuple(None if v is None else str(v) for v in r) for r in con.execute(f"select {', '.join(cols)} from ({ORACLE_SQL[name].strip()})").fetchall()), key=repr)
        assert got == want
        return len(got)

    return check


def test_prices_of_parts_beyond_200_000(same):
    made = "select * replace (l_partkey + 199900 as l_partkey) from lineitem where l_orderkey < 900"
    assert same("portal_listings", lineitem=made) > 100


def test_companies_of_two_abns_beside_one_acn(same):
    made = "select s_suppkey + i * 10 as s_suppkey, s_name, s_nationkey, s_acctbal from (select * from supplier limit 10), range(100) r(i)"
    assert same("filled_companies", supplier=made) == 1000
