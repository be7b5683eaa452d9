import json
import random

import pytest
from pyspark.sql import functions as F

from arbor import cli, viz
from arbor.functions import geometry
from arbor.functions.derived import DERIVED, derived_field, with_derived
from arbor.functions.simulation import SIMULATIONS, Simulation
from arbor.operators import cores, forest, lightcone
from arbor.operators.prefix import running_place
from arbor.sources import configs, sinks
from arbor.sources.tables import read_files, table_stamp


def _catalog(spark):
    rows = [(i, i // 2 if i > 1 else -1, 10 - i.bit_length(), float(1000 - i), float(i % 7)) for i in range(1, 64)]
    return spark.createDataFrame(rows, "tree_node_index long, desc_node_index long, snapnum int, tree_node_mass double, extra double")


def test_forest_round_trip(spark, tmp_path):
    c = _catalog(spark).select(F.col("tree_node_index").alias("id"), F.col("desc_node_index").alias("desc"), "snapnum", F.col("tree_node_mass").alias("mass"))
    built = forest.build(c)
    sinks.write_forest(built.nodes, str(tmp_path / "f"), 3)
    wanted = ["mass"]
    back = sinks.read_forest(spark, str(tmp_path / "f"), wanted)
    assert wanted == ["mass"] and back.count() == 63
    assert back.select("root", F.input_file_name().alias("f")).distinct().groupBy("root").count().where("count > 1").count() == 0
    svg = viz.tree_svg(spark, built, 1, 3, 0.0)
    assert svg.count("<rect") == 15 and svg.count("<path") == 14
    assert viz.tree_svg(spark, built, 999).endswith("</svg>")
    with pytest.raises(ValueError):
        sinks.write_forest(built.nodes, str(tmp_path / "g"), 0)


def test_convert_from_ini(spark, tmp_path):
    _catalog(spark).write.parquet(str(tmp_path / "cat"))
    (tmp_path / "sim.cfg").write_text("[cosmology]\nname=c\nOmega_m=.3\nOmega_b=.05\nOmega_L=.7\nh=.7\nns=.96\ns8=.8\n[simulation]\nname=s\nrl=64\nng=32\nnp=32\nnsteps=10\nzstart=9\nzfin=0\ncosmotools_steps=" + " ".join(map(str, range(10))) + "\n")
    (tmp_path / "a.cfg").write_text("[simulation]\nsimulation = sim.cfg\n[input]\ntreenodes_base_path = cat\n[output]\noutput_file = out\nn_files = 2\n[columns.forest]\ncopy_fields = " + json.dumps(["extra", ["extra", "twin"]]) + "\n")
    cli.convert(spark, str(tmp_path / "a.cfg"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 63 and {"extra", "idx"} <= set(rows.columns)
    sim = Simulation.from_ini(str(tmp_path / "sim.cfg"))
    assert sim.step2a(9) == pytest.approx(1.0) and sim.step2z(9) == pytest.approx(0.0)


def test_core_config_and_lightcone_sink(spark, tmp_path):
    (tmp_path / "c.toml").write_text('simulation = "AlphaQ"\n[paths]\ncoreproperties_base = "in"\noutput_base = "out"\n[data]\ninclude_fields = ["x"]\n')
    c = configs.core_config(str(tmp_path / "c.toml"))
    assert c.simulation is SIMULATIONS["AlphaQ"] and c.columns == ("x",) and len(c.simulation.steps) == 99
    core = spark.createDataFrame([(5, 1, 0, 1, 0, 7, 1.0, 1.0, 1.0), (5, 2, 1, 0, 0, 7, 2.0, 1.0, 63.0), (5, 3, 1, 0, 0, 7, 40.0, 1.0, 1.0)], "snapnum int, core_tag long, host_core long, central int, merged int, fof_halo_tag long, x double, y double, z double")
    halos = spark.createDataFrame([(7, 0, 100.0, 0.0, 5.0, 0.5), (7, 0, 100.25, 0.0, 5.0, 0.6), (7, 1, -80.0, 2.0, 5.0, 0.5), (8, 0, 1.0, 1.0, float("nan"), 0.1), (None, 0, 1.0, 1.0, 1.0, 0.1)], "id long, replication int, x double, y double, z double, a double")
    out = lightcone.pipeline(core, halos, 5, 64.0, 16)
    rows = {(r.core_tag, r.replication): (r.px, r.py, r.pz) for r in out.collect()}
    assert rows == {(1, 0): (100, 0, 5), (1, 1): (-80, 2, 5), (2, 0): (101, 0, 3), (2, 1): (-79, 2, 3)}
    sinks.write_lightcone(out, str(tmp_path / "lc"), 90)
    assert spark.read.parquet(str(tmp_path / "lc" / "cores")).count() == 4
    assert spark.read.parquet(str(tmp_path / "lc" / "extent")).agg(F.sum("n_cores")).first()[0] == 4
    sinks.write_cores(core, str(tmp_path / "cores"), 2)
    assert spark.read.parquet(str(tmp_path / "cores")).count() == 3
    assert lightcone.pipeline(core.limit(0), halos.limit(0), 5, 64.0, 16).count() == 0


def test_core_hosts_and_gaps(spark):
    rows = [(1, 1, 0, 1, 0), (1, 2, 1, 0, 0), (1, 3, 2, 0, 0), (1, 4, 9, 0, 0), (1, 5, 6, 0, 0), (1, 6, 5, 0, 1), (1, 7, 5, 0, 0), (0, 1, 0, 1, 0), (0, 4, 1, 0, 0), (3, 1, 0, 1, 0), (2, 1, None, None, None)]
    df = spark.createDataFrame(rows, "snapnum int, core_tag long, host_core long, central int, merged int")
    top = {(r.snapnum, r.core_tag): (r.top, r.second) for r in cores.top_hosts(df).collect()}
    assert top[(1, 3)] == (1, 2) and top[(1, 2)] == (1, None) and top[(1, 1)] == (1, None) and top[(1, 4)] == (4, None)
    assert top[(1, 5)] == top[(1, 6)] == top[(1, 7)] == (None, None) and len(top) == len(rows)
    assert {(r.core_tag, r.snapnum) for r in cores.core_forest(df, 3).collect()} == {(1, 3), (1, 2), (1, 1), (1, 0)}
    assert {r.core_tag for r in cores.orphan_cores(df, 3).collect()} == {2, 3, 4, 5, 6, 7}
    cells = {(r.core_tag, r.snapnum): r.state for r in cores.core_matrix(df, 3).collect()}
    assert cells[(6, 1)] == 2 and cells[(2, 1)] == 1 and cells[(1, 1)] == 0 and cells[(2, 0)] == -1


def test_geometry_and_derived(spark):
    df = spark.createDataFrame([(-1.0, 10.0), (65.0, -40.0)], "x double, d double")
    r = df.select(geometry.wrap(F.col("x"), 64).alias("w"), geometry.wrap_once(F.col("x"), 64).alias("o"), geometry.min_image(F.col("d"), 64).alias("m")).collect()
    assert [(a.w, a.o, a.m) for a in r] == [(63, 63, 10), (1, 1, 24)]
    tag = spark.createDataFrame([(3 * 256 + 5 * 16 + 7,)], "t long").select(*geometry.lagrangian(F.col("t"), 16)).first()
    assert tuple(tag) == (3 / 16, 5 / 16, 7 / 16)

    @derived_field("twice", "x")
    def twice(box):
        return F.col("x") * 2

    assert [a.twice for a in with_derived(df, ["twice"], 64).collect()] == [-2, 130]
    with pytest.raises(ValueError):
        with_derived(df, ["xoff_fof"], 64)
    assert {"xoff_fof", "xoff_sod", "xoff_com"} <= set(DERIVED)


def test_cosmology():
    c = SIMULATIONS["LastJourney"].cosmo
    assert c.hubble_parameter(1.0) == pytest.approx(100 * c.h) and c.omega_m(1.0) == pytest.approx(c.Omega_m)
    assert c.lookback_time([1.0])[0] == 0 and 13 < c.lookback_time([0.05])[0] < 14
    w = SIMULATIONS["DiscoveryW0WA"].cosmo
    assert abs(w.lookback_time([0.5])[0] - w.lookback_time([0.5], along=True)[0]) > 1e-3
    assert SIMULATIONS["LastJourney"].particle_mass() == pytest.approx(2.717e9, rel=1e-2)


def test_derived_values(spark):
    """Offsets in units of the radius, across the edge of the box, and the value that stands for no mass."""
    centers = ["fof_halo_mean", "fof_halo_center", "sod_halo_mean", "sod_halo_min_pot"]
    names = [f"{c}_{x}" for c in centers for x in "xyz"] + ["sod_halo_radius", "sod_halo_mass"]
    rows = [
        (1.0, 2.0, 2.0, 0.0, 0.0, 0.0, 1.0, 2.0, 0.0, 1.0, 2.0, 0.5, 0.5, 10.0),
        (63.0, 1.0, 1.0, 1.0, 1.0, 1.0, 63.0, 1.0, 33.5, 63.0, 1.0, 1.0, 2.0, 10.0),
        (1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 3.0, 3.0, 3.0, 4.0, 4.0, 4.0, 1.0, -1.0),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = [(r.xoff_fof, r.xoff_sod, r.xoff_com) for r in with_derived(df, ["xoff_fof", "xoff_sod", "xoff_com"], 64).collect()]
    # fof: mean to center; sod: mean to least potential; com: the two means
    assert got[0] == pytest.approx((6.0, 1.0, 4.0))
    assert got[1] == pytest.approx((1.0, 31.5 / 2, 31.5 / 2))
    assert got[2] == (-101.0, -101.0, -101.0)


def test_pipelines_take_records(spark, tmp_path):
    """Keys delivered again count once, by their latest row, in forests and core forests."""
    c = _catalog(spark).withColumn("loaded_at", F.to_timestamp(F.lit("2024-01-01")))
    older = c.where("tree_node_index % 3 = 0").withColumns({"tree_node_mass": F.lit(1e9), "loaded_at": F.to_timestamp(F.lit("2023-01-01"))})
    c.unionByName(older).unionByName(c).write.parquet(str(tmp_path / "cat"))
    (tmp_path / "a.cfg").write_text('[simulation]\nsimulation = AlphaQ\n[input]\ntreenodes_base_path = cat\n[output]\noutput_file = out\n[columns.forest]\ncopy_fields = ["extra"]\n')
    cli.convert(spark, str(tmp_path / "a.cfg"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 63 and max(r.mass for r in rows) < 1e9 and {r.idx for r in rows} == set(range(63))
    times = [(1, 98, 5.0, "2024-01-01"), (1, 98, 7.0, "2024-02-01"), (1, 97, 1.0, "2024-01-01"), (1, 97, 1.0, "2024-01-01"), (2, 98, 3.0, "2024-01-01")]
    spark.createDataFrame(times, "core_tag long, snapnum int, x double, loaded_at string").withColumn("loaded_at", F.to_timestamp("loaded_at")).write.parquet(str(tmp_path / "in"))
    (tmp_path / "c.toml").write_text('simulation = "AlphaQ"\ncoreproperties_base = "in"\noutput_base = "cores"\ninclude_fields = ["x"]\n')
    cli.reorganize(spark, str(tmp_path / "c.toml"), 2)
    assert sorted((r.core_tag, r.snapnum, r.place, r.x) for r in spark.read.parquet(str(tmp_path / "cores")).collect()) == [(1, 97, 1, 1.0), (1, 98, 0, 7.0), (2, 98, 0, 3.0)]


def test_several_files(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "a long, b long").coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([(3,), (4,)], "a long").coalesce(1).write.parquet(str(tmp_path / "two"))
    rows = read_files(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert sorted((r.a, r.b or 0, r.file) for r in rows.collect()) == [(1, 2, 0), (3, 0, 1), (4, 0, 1)]
    assert rows.select("file", "file_name").distinct().count() == 2
    before = table_stamp(spark, str(tmp_path), "t") if (tmp_path / "t.parquet").exists() else None
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    first = table_stamp(spark, str(tmp_path), "t")
    spark.range(9).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert before != first != table_stamp(spark, str(tmp_path), "t")
    with pytest.raises(ValueError):
        read_files(spark, [])


def test_group_order_and_matrix_rows(spark):
    rows = [(1, 1, 0, 1, 0), (1, 2, 1, 0, 0), (1, 3, 2, 0, 0), (1, 4, 1, 0, 0), (1, 5, 2, 0, 0), (1, 9, 8, 0, 0), (1, 8, 9, 0, 0), (0, 1, 0, 1, 0), (1, 7, 70, 0, 1)]
    df = spark.createDataFrame(rows, "snapnum int, core_tag long, host_core long, central int, merged int")
    placed = {(r.snapnum, r.core_tag): (r.top, r.place) for r in cores.group_order(cores.top_hosts(df)).collect()}
    assert placed == {(1, 1): (1, 0), (1, 2): (1, 1), (1, 3): (1, 2), (1, 5): (1, 3), (1, 4): (1, 4), (0, 1): (1, 0), (1, 7): (7, 0)}
    cells = {(r.core_tag, r.snapnum): r for r in cores.core_matrix_rows(df, 1, 2, ["host_core", "merged"]).collect()}
    assert len(cells) == 16 and {r.chunk for r in cells.values()} == {0, 1}
    assert cells[3, 1].host_row == cells[2, 1].row == 1 and cells[1, 1].host_core == 1 and cells[1, 1].host_row == 0
    assert cells[5, 1].chunk == 1 and cells[5, 1].host_row is None and cells[5, 0].state == -1 and cells[5, 0].merged is None
    assert cores.group_order(cores.top_hosts(df.limit(0))).count() == 0 and cores.core_matrix_rows(df.limit(0), 1).count() == 0


def test_running_place_of_sparse_keys(spark):
    rng = random.Random(3)
    keys = sorted({rng.choice([rng.randrange(50), rng.randrange(2**30), rng.randrange(2**62)]) for _ in range(500)})
    got = {r.k: r.p for r in running_place(spark.createDataFrame([(k,) for k in keys], "k long").repartition(5), "k", "p").collect()}
    assert got == {k: i for i, k in enumerate(keys)}
