"""Every query of the engine against its SQL on DuckDB."""

import os

import duckdb
import pytest

from tidemark.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


def values(rows):
    plain = lambda v: repr(round(v, 6)) if isinstance(v, float) else repr(v)
    return sorted([tuple(map(plain, r)) for r in rows])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    want = duck.sql(catalogue.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert values(df.select(columns).collect()) == values(want.select(*(f'"{c}"' for c in columns)).fetchall())


def test_entry_imports_and_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_digest_diff_of_added_keys_divisible_by_997(spark, tmp_path):
    """887329 is divisible by 2003, and the key of its added row, -887330, by 997."""
    path = f"{tmp_path}/events.parquet"
    con = duckdb.connect()
    con.sql(f"copy (select * replace (event_id + 887000 as event_id) from '{FOLDER}/events.parquet' where event_id < 500) to '{path}' (format parquet)")
    con.sql(f"create view events as select * from '{path}'")
    got = catalogue.QUERIES["digest_diff"](spark, str(tmp_path)).select("difference", "event_id").collect()
    want = con.sql(f"select difference, event_id from ({catalogue.ORACLES['digest_diff']})").fetchall()
    assert ("source", -887330) in want and values(got) == values(want)
