"""The driver's contract: every query is there, and gives what its SQL gives."""

import glob
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
#: Queries of each kind whose rows are compared here; the driver compares all of them.
SOME = ["change_detect", "doc_canonical_sha", "words_and_identity", "p5_found", "error_streaks", "entity_resolution_chain", "masked_urls", "tail_pointer_check"]


def test_contract():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 120
    assert {"p2_found", "p5_found"} <= set(q)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
@pytest.mark.parametrize("name", SOME)
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        src = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.execute(f"create view {os.path.basename(path).split('.')[0]} as select * from read_parquet('{src}')")
    got = entry.queries()[name](spark, DATA)
    want = c.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, want.fetchall()))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
