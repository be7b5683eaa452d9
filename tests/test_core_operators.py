import datetime as dt

from pyspark.sql import functions as F

from arbor.functions.tags import fragment_index, parent_tag, unique_id
from arbor.operators.prefix import exclusive_sum, falling_bin
from arbor.operators.records import keyed
from arbor.operators.references import orphan_references, orphans_by_period
from arbor.operators.skew import heavy_keys, salted_aggregate

DAY = [dt.datetime(2030, 1, d) for d in range(1, 9)]


def test_keyed_takes_latest_and_first_arrival(spark):
    df = spark.createDataFrame([(1, "a", DAY[0], 5), (1, "b", DAY[2], 6), (1, "b", DAY[2], 6), (2, None, None, 7), (None, "c", DAY[1], 8)], "k long, v string, loaded_at timestamp, arrival int")
    rows = {r.k: (r.v, r.arrival) for r in keyed(df.select("k", "v", "loaded_at"), ["k"], ["v"]).collect()}
    assert rows[1] == ("b", DAY[0]) and rows[2] == (None, None) and set(rows) == {1, 2}


def _refs(spark, children, parents, gone):
    c = spark.createDataFrame([("t", 0, r, a, "t", s, k) for k, r, a, s in children], "ref_table string, ref_scope int, ref_key long, arrival timestamp, origin_table string, snapnum int, key_id long")
    p = spark.createDataFrame([("t", 0, k, a) for k, a in parents], "ref_table string, ref_scope int, ref_key long, arrival timestamp")
    w = spark.createDataFrame([("t", 0, k) for k in gone], "ref_table string, ref_scope int, ref_key long")
    return orphan_references(c, p, w)


def test_orphan_references(spark):
    out = _refs(spark, [(1, 10, DAY[1], 1), (2, 11, DAY[1], 1), (3, 12, DAY[1], 2), (4, 12, DAY[5], 2), (5, 13, DAY[1], 2), (6, None, DAY[1], 2)], [(10, DAY[0]), (12, DAY[3]), (13, DAY[0])], [13, 13, 77])
    assert {(r.key_id, r.reason) for r in out.collect()} == {(2, "missing"), (3, "late"), (5, "withdrawn")}
    counts = {r.snapnum: (r.n_missing, r.n_withdrawn, r.n_late, r.n_orphans) for r in orphans_by_period(out).collect()}
    assert counts == {1: (1, 0, 0, 1), 2: (0, 1, 1, 2)}
    assert _refs(spark, [], [], []).count() == 0


def test_salted_aggregate_equals_plain(spark):
    rows = [(7, 1.0)] * 600 + [(i % 50, 2.0) for i in range(300)] + [(None, 3.0), (None, None), (3, None)]
    df = spark.createDataFrame(rows, "k long, salt double").repartition(5)
    heavy = heavy_keys(df, "k", 0.1)
    assert 7 in heavy
    got = {r.k: (r.n_rows, r.s) for r in salted_aggregate(df, "k", {"s": F.col("salt")}, heavy, salts=8).collect()}
    want = {}
    for k, v in rows:
        n, s = want.get(k, (0, 0.0))
        want[k] = (n + 1, s + (v or 0))
    assert got == want
    empty = df.limit(0)
    assert heavy_keys(empty, "k") == [] and salted_aggregate(empty, "k", {"s": F.col("salt")}, []).count() == 0


def test_exclusive_sum(spark):
    rows = [(i % 3, (i * 37) % 101 - 50, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, x int, i int")
    got = {r.i: r.s for r in exclusive_sum(df, ["g"], [falling_bin(F.col("x").cast("double"))], [F.col("x").desc(), F.col("i")], F.col("i"), "s").collect()}
    for g, x, i in rows:
        assert got[i] == sum(i2 for g2, x2, i2 in rows if g2 == g and (-x2, i2) < (-x, i))


def test_tags(spark):
    df = spark.createDataFrame([(-(2 << 48 | 124),), (55,), (None,)], "t long").select(parent_tag(F.col("t")).alias("a"), fragment_index(F.col("t")).alias("b"), unique_id(F.lit(3), F.col("t")).alias("c"))
    rows = df.collect()
    assert [(r.a, r.b) for r in rows] == [(124, 2), (55, 0), (None, None)]
    assert rows[1].c == (3 << 41) + 55
