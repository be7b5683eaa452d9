"""The published layout of a closed tree of 16 halos, and random forests against a plain depth-first walk."""

import random

import pytest

from arbor.functions.simulation import SIMULATIONS
from arbor.operators import forest as fo
from arbor.operators.fragments import fix_fragments
from arbor.operators.matrix import branch_hosts, branch_matrix, wide
from arbor.operators.submass import fsub_stats, sub_hosts, submass
from arbor.sources import sinks

SNAP = dict(zip(range(3, 19), (6, 5, 4, 3, 2, 1, 0, 2, 1, 0, 4, 3, 2, 1, 3, 2)))
DESC = {3: None, 4: 3, 5: 4, 6: 5, 7: 6, 8: 7, 9: 8, 10: 6, 11: 10, 12: 11, 13: 4, 14: 13, 15: 14, 16: 15, 17: 13, 18: 17}
SIZE = dict(zip(range(3, 19), (16, 15, 8, 7, 3, 2, 1, 3, 2, 1, 6, 3, 2, 1, 2, 1)))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, desc long, snapnum int, mass double")


@pytest.fixture(scope="module")
def golden(spark):
    f = fo.build(frame(spark, [(i, DESC[i] if DESC[i] is not None else -1, SNAP[i], 100.0 - i) for i in SNAP]))
    f.nodes.cache()
    return f


def test_layout(golden):
    rows = {r.id: r for r in golden.nodes.collect()}
    assert {i: r.size for i, r in rows.items()} == SIZE
    assert {i: r.idx for i, r in rows.items()} == {i: i - 3 for i in SNAP}
    assert {r.branch for r in rows.values()} == {3, 10, 13, 17}
    assert {r.branch: r.length for r in golden.branches.collect()} == {3: 7, 10: 3, 13: 4, 17: 2}


def test_navigation(spark, golden):
    target = spark.createDataFrame([(3,)], "id long")
    assert sorted(r.id for r in fo.main_branch(golden.nodes, target).collect()) == list(range(3, 10))
    assert {r.desc: r.id for r in fo.nth_progenitor(golden.nodes, 2).collect()} == {4: 13, 6: 10, 13: 17}
    assert [r.n for r in fo.infall_histogram(golden, target, 80, 100, 4, log=False).orderBy("bin").collect()] == [0, 1, 1, 0]
    want = {3: 11, 4: 10, 5: 8, 6: 7, 7: 3, 8: 2, 9: 1, 10: 3, 11: 2, 12: 1, 13: 1}
    assert {r.id: r.size for r in fo.pruned(golden, 86).collect()} == want
    assert {(r.i, r.j) for r in fo.adjacency(golden.nodes, spark.createDataFrame([(13,)], "id long")).collect()} == {(1, 0), (2, 1), (3, 2), (4, 0), (5, 4)}
    with pytest.raises(ValueError):
        fo.nth_progenitor(golden.nodes, 0)


def test_subhalos(spark, golden):
    rows = {(r.branch, r.snapnum, r.host, r.direct_branch, r.direct_host) for r in sub_hosts(golden, 6).collect()}
    want = {(10, 6, 3), (10, 5, 4), (10, 4, 5), (10, 3, 6), (13, 6, 3), (13, 5, 4), (17, 6, 3), (17, 5, 4), (17, 4, 13)}
    assert {r[:3] for r in rows} == want
    assert {r[1:] for r in rows if r[0] == 17} == {(6, 3, 13, None), (5, 4, 13, None), (4, 13, 13, 13)}
    assert {(r.branch, r.snapnum, r.host) for r in branch_hosts(golden).collect()} == want


@pytest.mark.parametrize("zeta", [0.1, 0.0])
def test_submass_against_recurrence(spark, golden, zeta):
    import numpy as np

    sim = SIMULATIONS["LastJourney"]
    a = sim.step2a(np.array(sim.steps[:7], dtype=float))
    t = sim.cosmo.lookback_time(a) * sim.cosmo.h
    tau = 1.628 * (sim.cosmo.virial_overdensity(a) / sim.cosmo.virial_overdensity(1.0)) ** -0.5 * sim.cosmo.hubble_parameter(1.0) / sim.cosmo.hubble_parameter(a) / 1.1
    mass, got = {i: 100.0 - i for i in SNAP}, {}
    for branch, parent in ((10, list(range(3, 10))), (13, list(range(3, 10))), (17, [13, 14, 15, 16])):
        at, m, s0 = None, mass[branch], SNAP[branch]
        at = (t[s0] + t[s0 + 1]) / 2
        for s in range(s0 + 1, 7):
            real = {SNAP[i]: mass[i] for i in parent}
            host = got[(parent[0], s)] if s > max(real) else real[s if s == s0 + 1 else s - 1]
            past = (at - t[s]) / tau[s]
            m = m * (1 + zeta * (m / host) ** zeta * past) ** (-1 / zeta) if zeta else m * np.exp(-past)
            at, got[(branch, s)] = t[s], m
    rows = submass(golden, sim, 6, zeta=zeta)
    found = {(r.branch, r.snapnum): r.mass for r in rows.collect()}
    assert found.keys() == got.keys()
    assert all(abs(found[k] / got[k] - 1) < 1e-9 for k in got)
    stats = {r.id: r for r in fsub_stats(rows, sub_hosts(golden, 6), golden.nodes).collect()}
    assert abs(stats[3].fsubtot - sum(got[(b, 6)] for b in (10, 13, 17)) / mass[3]) < 1e-9 and stats[18].fsubmax == 0


def test_matrix(golden):
    cells = branch_matrix(golden, 85, 6)
    assert cells.count() == 3 * 7 and {r.branch for r in cells.collect()} == {3, 10, 13}
    row = {r.branch: r for r in wide(cells, "id", 6).collect()}[10]
    assert [row[f"s{i}"] for i in range(7)] == [12, 11, 10, 0, 0, 0, 0]


def naive(rows):
    there = {i: (d, s, m) for i, d, s, m in rows}
    desc = {i: d if d in there and there[d][1] == s + 1 else None for i, (d, s, m) in there.items()}
    kids = {}
    for i, d in desc.items():
        kids.setdefault(d, []).append(i)
    out = {}

    def walk(root):
        order = []

        def branch(head):
            stem = [head]
            while stem[-1] in kids:
                stem.append(min(kids[stem[-1]], key=lambda i: (-there[i][2], i)))
            order.extend(stem)
            merging = [k for i in stem for k in kids.get(i, []) if k not in stem]
            for k in sorted(merging, key=lambda i: (there[i][1], -there[i][2], i)):
                branch(k)

        branch(root)
        return order

    size = lambda i: 1 + sum(size(k) for k in kids.get(i, []))
    for r in kids.get(None, []):
        for n, i in enumerate(walk(r)):
            out[i] = (r, n, size(i))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forest(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(-20, 400), rng.randrange(8), float(rng.randrange(1, 6))) for i in range(400)]
    last = {s: [i for i, _, t, _ in rows if t == s] for s in range(8)}
    rows = [(i, rng.choice(last[s + 1]) if s < 7 and rng.random() < 0.8 else d, s, m) for i, d, s, m in rows]
    got = {r.id: (r.root, r.idx, r.size) for r in fo.build(frame(spark, rows)).nodes.collect()}
    assert got == naive(rows)


def test_reading_options(spark, tmp_path):
    """Chunks hold every tree once; above a mass the same halos and sizes as `pruned` has, in their order."""
    rng = random.Random(6)
    last = {s: [s * 1000 + i for i in range(40)] for s in range(8)}
    rows = [(i, rng.choice(last[s + 1]) if s < 7 and rng.random() < 0.95 else -1, s, rng.uniform(1, 6)) for s in last for i in last[s]]
    f = fo.build(frame(spark, rows))
    sinks.write_forest(f.nodes, str(tmp_path / "f"), 3)
    read = lambda **k: sinks.read_forest(spark, str(tmp_path / "f"), ["mass"], **k).collect()
    parts = [{r.id for r in read(chunk=k, n_chunks=3, last=7)} for k in range(3)]
    late = {r.id for r in read(last=7)}
    assert set.union(*parts) == late and sum(map(len, parts)) == len(late) < len(rows)
    want = {r.id: r.size for r in fo.pruned(f, 2.0).collect()}
    got = read(threshold=2.0)
    assert {r.id: r.size for r in got} == want and 0 < len(want) < len(rows)
    old = {r.id: (r.root, r.idx) for r in read()}
    for root in {r.root for r in got}:
        mine = sorted((r for r in got if r.root == root), key=lambda r: r.idx)
        assert [r.idx for r in mine] == list(range(len(mine))) and [old[r.id][1] for r in mine] == sorted(old[r.id][1] for r in mine)
    with pytest.raises(ValueError):
        read(chunk=3, n_chunks=3)


def test_empty_forest(spark):
    f = fo.build(frame(spark, []))
    assert f.nodes.count() == 0 and f.branches.count() == 0
    assert submass(f, SIMULATIONS["LastJourney"], 100).count() == 0


def test_fragments(spark):
    rows = [(1, 9 - k, f, float(v)) for k, (f, v) in enumerate(zip((0, 1, 1, 0, 1), (10, 9, 9, 4, 7)))]
    df = spark.createDataFrame(rows, "branch long, snapnum int, fragment long, v double")
    fixed = lambda d, *a: [r.v_fragfix for r in fix_fragments(d, ["v"], *a).orderBy("snapnum", ascending=False).collect()]
    assert fixed(df) == [10, 10, 10, 4, 4]
    assert fixed(df, "linear") == [10, 8, 6, 4, 7]
    masked = spark.createDataFrame([r[:3] + (-1.0 if r[3] == 4 else r[3],) for r in rows], df.schema)
    assert fixed(masked, "linear", True) == [10, -1, -1, -1, 7]
    with pytest.raises(ValueError):
        fix_fragments(df, ["v"], "cubic")
