import os

import duckdb

import __spark_entry__ as entry

TINY = "/root/testdata/sf0.001"


def test_all_chunks_are_made(spark):
    con = duckdb.connect()
    for f in os.listdir(TINY):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{TINY}/{f}'")
    got = entry.queries()["forest_chunks"](spark, TINY).collect()
    assert {r.chunk for r in got} == set(range(5))
    assert sorted((r.chunk, r.id, r.root, r.idx) for r in got) == sorted(con.sql("SELECT chunk, id, root, idx FROM (" + entry.oracle_sql()["forest_chunks"] + ")").fetchall())
