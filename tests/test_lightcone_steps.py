import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from arbor import cli
from arbor.operators import lightcone

TINY = "/root/testdata/sf0.001"
CORES = "snapnum int, core_tag long, host_core long, central int, merged int, fof_halo_tag long, x double, y double, z double"
HALOS = "id long, replication int, x double, y double, z double, a double"


def _tables(spark):
    core = [(s, t, h, c, 0, 7, 10.0 * s + d, 1.0, 1.0) for s in (0, 1, 2) for t, h, c, d in ((1, 0, 1, 0.0), (2, 1, 0, s), (3, 2, 0, 2.0 * s))]
    halos = [(7, 0, 100.0, 0.0, 5.0, 0.3), (7, 0, 50.0, 0.0, 5.0, 0.6), (7, 1, -80.0, 2.0, 5.0, 0.5), (7, 2, 1.0, 1.0, 1.0, 1.0), (7, 3, 1.0, 1.0, 1.0, 0.1), (7, 4, 1.0, 1.0, 1.0, None), (7, 5, 1.0, 1.0, 1.0, float("nan"))]
    snapshots = [(0, 10, 0.25), (1, 20, 0.5), (2, 30, 1.0)]
    return spark.createDataFrame(core, CORES), spark.createDataFrame(halos, HALOS), spark.createDataFrame(snapshots, "snapnum short, step int, scale_factor double")


def test_every_step_takes_its_halos_and_the_cores_after_it(spark):
    rows = lightcone.pipeline_of_steps(*_tables(spark), 64.0, 16).collect()
    got = {(r.step, r.snapnum, r.core_tag, r.replication): r.px for r in rows}
    assert got == {(10, 1, 1, 0): 100, (10, 1, 2, 0): 101, (10, 1, 3, 0): 102, (20, 2, 1, 0): 50, (20, 2, 2, 0): 52, (20, 2, 3, 0): 54, (20, 2, 1, 1): -80, (20, 2, 2, 1): -78, (20, 2, 3, 1): -76}
    assert len(rows) == len(got)


def test_steps_are_those_of_single_snapshots(spark):
    core, halos, snapshots = _tables(spark)
    whole = lightcone.pipeline_of_steps(core, halos, snapshots, 64.0, 16)
    for snapnum, low, high in ((1, 0.25, 0.5), (2, 0.5, 1.0)):
        one = lightcone.pipeline(core, halos.where((F.col("a") >= low) & (F.col("a") < high)), snapnum, 64.0, 16)
        assert sorted(map(tuple, whole.where(F.col("snapnum") == snapnum).select(*one.columns).collect())) == sorted(map(tuple, one.collect()))


def test_steps_are_written_apart(spark, tmp_path):
    for name, df in zip(("c", "h", "s"), _tables(spark)):
        df.write.parquet(str(tmp_path / name))
    cli.intersect_steps(spark, *(str(tmp_path / n) for n in ("c", "h", "s", "out")), 64.0, 16)
    back = spark.read.parquet(str(tmp_path / "out" / "cores"))
    hosts = {(r.core_tag, r.replication): (r.top_host_idx, r.secondary_top_host_tag, r.secondary_top_host_idx) for r in back.where("step = 20").collect()}
    assert hosts[3, 0] == hosts[3, 1] == (1, 2, 2) and hosts[2, 0] == hosts[1, 0] == (1, -1, -1)
    assert {"scale_factor", "central", "x", "y", "z", "lc_fof_halo_tag", "lc_fof_halo_flag", "lc_halo_theta"} <= set(back.columns)
    assert {r.step: r["count"] for r in back.groupBy("step").count().collect()} == {10: 3, 20: 6}


@pytest.mark.parametrize("name", ["lc_steps_pipeline", "lc_steps_output"])
def test_steps_match_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(TINY):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{TINY}/{f}'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, TINY)
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda row: tuple(round(v, 3) if isinstance(v, float) else -9 if v is None else v for v in row)
    mine, theirs = sorted(plain(r) for r in got.select(*want.columns).collect()), sorted(plain(r) for r in want.fetchall())
    assert len(mine) == len(theirs) > 0
    assert all(a == pytest.approx(b, abs=2e-3) for a, b in zip(mine, theirs))
