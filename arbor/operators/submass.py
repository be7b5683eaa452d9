"""Subhalos: halos after their infall, their hosts, and the mass they keep."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.simulation import Simulation
from ..plans.cut import split_levels, stored
from .forest import Forest
from .skew import hot_keys, join_hot


#: Fixed value: the dynamical time of a halo today, in the units of the lookback times.
DYNAMICAL = 1.628


def sub_hosts(forest: Forest, last: int) -> DataFrame:
    """branch, snapnum, host, direct_branch, direct_host: one row per merged branch and snapshot after its infall, in
    trees whose root is at `last`. host is the halo that holds it; direct_branch is the branch it merged into, and
    direct_host that branch's halo then, null if that branch has merged by then itself."""
    b = forest.branches
    late = b.where((F.col("branch") == F.col("root")) & (F.col("head_snap") == last)).select("root")
    merged = b.where("pbranch is not null").join(late, "root", "left_semi")
    rows = merged.select("branch", "pbranch", F.posexplode("prefix").alias("up", "host")).withColumn("snapnum", F.lit(last) - F.col("up"))
    parent = b.select(F.col("branch").alias("pbranch"), F.col("head_snap").alias("phead"))
    return rows.join(parent, "pbranch").select("branch", "snapnum", "host", F.col("pbranch").alias("direct_branch"), F.when(F.col("snapnum") <= F.col("phead"), F.col("host")).alias("direct_host"))


def submass(forest: Forest, sim: Simulation, last: int, zeta: float = 0.1, A: float = 1.1) -> DataFrame:
    """branch, snapnum, mass of each subhalo after infall, in trees whose root is at `last`.

    A branch loses mass by dm/dt = -m / tau (m / M)^zeta, solved exactly between snapshots with the host's mass M and the
    dynamical time tau of the later one; it begins halfway between its last snapshot and the next. M is the mass of the
    halo its branch merged into: at the first step that at the snapshot, later that of the snapshot before; once that
    branch has merged too, its modelled mass at the snapshot. zeta = 0 is exponential decay.

    One round per level of nesting, which reads that level's branches only: parents' masses, one array of at most one value per
    snapshot, join their merged branches, salted where many merge into one, and a fold over the snapshots gives these
    theirs; so no task needs more than its rows.
    """
    steps = [int(s) for s in sim.steps[: last + 1]]
    a = sim.step2a(np.array(steps, dtype=float))
    cosmo = sim.cosmo
    tau = DYNAMICAL * (cosmo.virial_overdensity(a) / cosmo.virial_overdensity(1.0)) ** -0.5 * (cosmo.hubble_parameter(a) / cosmo.hubble_parameter(1.0)) ** -1 / A
    back = cosmo.lookback_time(a) * sim.cosmo.h
    t, taus = (F.array(*(F.lit(float(v)) for v in x)) for x in (back, tau))
    masses = forest.nodes.groupBy("branch").agg(F.map_from_entries(F.collect_list(F.struct("snapnum", "mass"))).alias("real"))
    kids = forest.branches.where("pbranch is not null").groupBy("pbranch").agg(F.count("*").alias("n"))
    hot = hot_keys(kids, "pbranch", "n", kids.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    levels = split_levels(forest.branches.join(masses, "branch").select("branch", "root", "pbranch", "head_snap", "head_mass", "nest", "real"), "sub", "nest")
    none = F.create_map().cast("map<int,double>").alias("sub")
    if not levels:
        return forest.branches.select("branch", F.explode(none).alias("snapnum", "mass")).limit(0)
    level = levels[0].read().where(F.col("head_snap") == last).select("branch", "head_snap", "real", none)
    out = None
    for part in levels[1:]:
        up = level.select(F.col("branch").alias("pbranch"), F.col("head_snap").alias("phead"), F.col("real").alias("preal"), F.col("sub").alias("psub"))
        rows = join_hot(part.read(), up, ["pbranch"], "pbranch", hot, F.col("branch")).withColumns({"t": t, "tau": taus})
        after = F.sequence(F.col("head_snap") + 1, F.lit(last))
        host = lambda s: F.when(s > F.col("phead"), F.element_at("psub", s)).when(s == F.col("head_snap") + 1, F.element_at("preal", s)).otherwise(F.element_at("preal", s - 1))
        start = (F.get("t", F.col("head_snap")) + F.get("t", F.col("head_snap") + 1)) / 2

        def step(acc, s):
            past = (acc["at"] - F.get("t", s)) / F.get("tau", s)
            ratio = acc["m"] / host(s)
            m = acc["m"] * F.exp(-past) if zeta == 0 else acc["m"] * F.pow(1 + zeta * F.pow(ratio, F.lit(zeta)) * past, F.lit(-1 / zeta))
            return F.struct(m.alias("m"), F.get("t", s).alias("at"), F.array_append(acc["all"], m).alias("all"))

        begin = F.struct(F.col("head_mass").alias("m"), start.alias("at"), F.array().cast("array<double>").alias("all"))
        done = rows.select("branch", "head_snap", "real", F.map_from_arrays(after, F.aggregate(after, begin, step, lambda acc: acc["all"])).alias("sub"))
        made = stored(done, "submass")
        level, out = made.read(), made if out is None else out + made
    if out is None:
        return level.select("branch", F.explode("sub").alias("snapnum", "mass"))
    return out.read().select("branch", F.explode("sub").alias("snapnum", "mass"))


def fsub_stats(subs: DataFrame, hosts: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, fsubtot, fsubmax of every halo: the sum and the maximum of its subhalos' masses over its own, 0 without any.
    subs: branch, snapnum, mass. hosts: branch, snapnum, host. Sums are combined before the shuffle."""
    per = subs.join(hosts.select("branch", "snapnum", "host"), ["branch", "snapnum"]).groupBy(F.col("host").alias("id")).agg(F.sum("mass").alias("all"), F.max("mass").alias("most"))
    return nodes.select("id", F.col("mass").alias("own")).join(per, "id", "left").select("id", F.coalesce(F.col("all") / F.col("own"), F.lit(0.0)).alias("fsubtot"), F.coalesce(F.col("most") / F.col("own"), F.lit(0.0)).alias("fsubmax"))
