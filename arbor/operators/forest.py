"""Catalogs of halos to forests with explicit keys, and navigation in them.

A forest is two tables. `nodes`: id, desc (null for a root), snapnum, mass, branch (id of the branch's latest halo), d
(steps from it), root, depth, size (halos in its subtree, itself included), idx (its place in the tree's depth-first
order, from 0), pbranch and at (the branch that its branch merges into, and the step there). `branches`: branch, root,
pbranch, at, head_snap, head_mass, length, total, nest (branches above it), and prefix, the ids from the root to the
halo it merges into.
A branch goes on in the most massive progenitor (then the least id); in the order of a tree a branch is followed by
those that merge into it, earliest first, then by mass descending and id, each with its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.cut import cut, drop
from .hierarchy import chain_steps, hand_down, resolve
from .prefix import exclusive_sum, falling_bin, running_max, running_place


@dataclass
class Forest:
    nodes: DataFrame
    branches: DataFrame


def linked(catalog: DataFrame) -> DataFrame:
    """catalog (id, desc, snapnum, mass) with `found`: whether desc is a halo of the next snapshot."""
    goal = catalog.select(F.col("id").alias("desc"), (F.col("snapnum") - 1).alias("snapnum"), F.lit(True).alias("found"))
    return catalog.join(goal, ["desc", "snapnum"], "left").select("id", "desc", "snapnum", "mass", F.coalesce("found", F.lit(False)).alias("found"))


def orphans(catalog: DataFrame) -> DataFrame:
    """Halos that name a descendant which the next snapshot lacks."""
    goal = catalog.select(F.col("id").alias("desc"), (F.col("snapnum") - 1).alias("snapnum"))
    return catalog.where("desc >= 0").join(goal, ["desc", "snapnum"], "left_anti")


def orphans_to_roots(catalog: DataFrame) -> DataFrame:
    """catalog with desc null for roots, and for halos whose descendant the next snapshot lacks."""
    return linked(catalog).select("id", F.when(F.col("found"), F.col("desc")).alias("desc"), "snapnum", "mass")


def build(catalog: DataFrame) -> Forest:
    """The forest of catalog (id, desc, snapnum, mass), one row per id, masses finite; orphans become roots. An empty
    catalog gives an empty forest. Links lead to the next snapshot, so there are no loops."""
    halos = cut(orphans_to_roots(catalog), "halos")
    peeled = resolve(halos.select(F.lit(-1).alias("scope"), "id", F.col("desc").alias("parent"), F.col("mass").alias("weight"), F.struct("snapnum", "mass").alias("note")))
    drop(halos)
    chains = peeled.chains.select("scope", "chain", "parent", "pchain", "at", "length", "total", "round").join(chain_steps(peeled), ["scope", "chain"])
    head = F.col("steps")[0]["note"]
    table = cut(chains.select("*", head["snapnum"].alias("head_snap"), head["mass"].alias("head_mass")), "branches")
    merging = table.where("pchain is not null").select("chain", "pchain", "head_snap", "head_mass", "total")
    placed = exclusive_sum(merging, ["pchain"], [F.col("head_snap"), falling_bin(F.col("head_mass"))], [F.col("head_mass").desc(), F.col("chain")], F.col("total"), "gap")
    known = hand_down(peeled, table.join(placed.select("chain", "gap"), "chain", "left"), gap=True).read()
    drop(table)
    branches = known.select(F.col("chain").alias("branch"), "root", F.col("pchain").alias("pbranch"), "at", "head_snap", "head_mass", "length", "total", "nest", "prefix")
    below = F.when(F.col("k") == 0, F.col("parent")).otherwise(F.col("s.desc"))
    steps = F.transform("steps", lambda s, i: F.struct(s["id"].alias("id"), s["note"].alias("note"), s["n_descendants"].alias("n"), F.when(i > 0, F.get("steps", i - 1)["id"]).alias("desc")))
    rows, d = known.select("chain", "root", "parent", "pchain", "at", "base", "pos", F.posexplode(steps).alias("k", "s")), F.col("k").cast("long")
    nodes = rows.select(
        "s.id", below.alias("desc"), "s.note.snapnum", "s.note.mass", F.col("chain").alias("branch"), d.alias("d"), "root", (F.col("base") + d).alias("depth"), (F.col("s.n") + 1).alias("size"),
        (F.col("pos") + d).alias("idx"), F.col("pchain").alias("pbranch"), "at",
    )
    return Forest(cut(nodes, "forest"), branches)


def roots(nodes: DataFrame) -> DataFrame:
    return nodes.where("desc is null")


def progenitor_count(nodes: DataFrame) -> DataFrame:
    """id, progenitor_count of every halo."""
    n = nodes.where("desc is not null").groupBy(F.col("desc").alias("id")).agg(F.count("*").alias("n"))
    return nodes.join(n, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("progenitor_count"))


def progenitors(nodes: DataFrame) -> DataFrame:
    """id, place (from 0), progenitor: the progenitors of each halo as places in its tree, in their order. Long form, as a
    halo may have any number of them."""
    rows = nodes.where("desc is not null").select(F.col("desc").alias("id"), F.col("idx").alias("progenitor"))
    return exclusive_sum(rows, ["id"], [F.shiftright("progenitor", 12)], [F.col("progenitor")], F.lit(1), "place").select("id", "place", "progenitor")


def csr_offsets(nodes: DataFrame) -> DataFrame:
    """root, idx, id, progenitor_count, progenitor_offset: the exclusive running count in the tree's order."""
    rows = nodes.select("root", "idx", "id").join(progenitor_count(nodes), "id")
    return exclusive_sum(rows, ["root"], [F.shiftright("idx", 12)], [F.col("idx")], F.col("progenitor_count"), "progenitor_offset").select("root", "idx", "id", "progenitor_count", "progenitor_offset")


def main_branch(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """target, id, snapnum, mass of the halos on the main branch of each of `targets` (id), itself included."""
    of = nodes.join(targets.select("id"), "id", "left_semi").select(F.col("id").alias("target"), "branch", F.col("d").alias("from"))
    return nodes.join(of, "branch").where("d >= from").select("target", "id", "snapnum", "mass")


def nth_progenitor(nodes: DataFrame, n: int) -> DataFrame:
    """desc, id, mass: the n-th progenitor (n from 1, by mass descending, then id) of each halo that has as many.
    Spark keeps n rows per halo and task before the shuffle, so hot halos cost little."""
    if n < 1:
        raise ValueError("n counts from 1")
    best = Window.partitionBy("desc").orderBy(F.col("mass").desc(), "id")
    return nodes.where("desc is not null").select("desc", "id", "mass", F.row_number().over(best).alias("k")).where(F.col("k") <= n).where(F.col("k") == n).drop("k")


def subtrees(nodes: DataFrame, targets: DataFrame, width: int = 6) -> DataFrame:
    """target, place (in its subtree), and the nodes there: those of its tree from idx on, size of them.

    A range join in blocks of 2^width places: each target is repeated for the blocks it reaches, so halos meet the targets
    above them and few others, however many targets a tree has."""
    of = nodes.join(targets.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("target"), "root", F.col("idx").alias("lo"), (F.col("idx") + F.col("size")).alias("hi"))
    of = of.withColumn("block", F.explode(F.sequence(F.shiftright("lo", width), F.shiftright(F.col("hi") - 1, width))))
    near = nodes.withColumn("block", F.shiftright("idx", width)).join(of, ["root", "block"])
    return near.where("idx >= lo and idx < hi").drop("hi", "block").withColumn("place", F.col("idx") - F.col("lo")).drop("lo")


def pruned(forest: Forest, threshold: float) -> DataFrame:
    """Nodes above `threshold` whose descendants all are too, with their subtree's new size: a halo below it is cut
    with its whole subtree. Cut halos are found along each branch first, then along the branches it merges into."""
    nodes = forest.nodes
    low = nodes.where(~(F.col("mass") > threshold)).groupBy("branch").agg(F.min("d").alias("cut"))
    with_low = nodes.join(low, "branch", "left").where("cut is null or d < cut")
    hurt = forest.branches.select("branch", F.explode("prefix").alias("id")).join(nodes.where(~(F.col("mass") > threshold)).select("id"), "id", "left_semi").select("branch").distinct()
    kept = with_low.join(hurt, "branch", "left_anti").drop("cut")
    kept = cut(kept, "kept")
    up = kept.join(forest.branches.select("branch", "prefix"), "branch")
    # a kept halo counts for itself, for those before it in its branch, and for those its branch hangs on
    own = exclusive_sum(kept, ["branch"], [F.lit(0)], [F.col("d").desc()], F.lit(1), "under").select("id", F.col("under").alias("own"))
    hung = up.where("d = 0").join(kept.groupBy("branch").agg(F.count("*").alias("n")), "branch").select(F.explode("prefix").alias("id"), "n").groupBy("id").agg(F.sum("n").alias("hung"))
    return kept.join(own, "id").join(hung, "id", "left").select("id", "desc", "snapnum", "mass", "root", (F.col("own") + 1 + F.coalesce("hung", F.lit(0))).alias("size"))


def above_mass(nodes: DataFrame, threshold: float) -> DataFrame:
    """What `pruned` keeps, of nodes alone as forest files hold them, with all their columns: `size` is that of what is kept,
    and `idx` their place among it.

    A halo is cut if it lies in the subtree of one below the threshold, that is, if one at or before its place has a
    subtree that reaches beyond it; new sizes are differences of running counts of kept halos."""
    low, bins = F.when(~(F.col("mass") > threshold), F.col("idx") + F.col("size")), [F.shiftright("idx", 12)]
    reach = running_max(nodes, ["root"], bins[0], F.col("idx"), low, "__reach")
    marked = reach.withColumn("__kept", (~F.coalesce(F.col("__reach") > F.col("idx"), F.lit(False))).cast("long"))
    counted = cut(exclusive_sum(marked, ["root"], bins, [F.col("idx")], F.col("__kept"), "__before"), "above")
    ends = counted.select("root", F.col("idx").alias("__end"), F.col("__before").alias("__upto"))
    whole = counted.groupBy("root").agg(F.sum("__kept").alias("__all"))
    kept = counted.where("__kept = 1").withColumn("__end", F.col("idx") + F.col("size")).join(ends, ["root", "__end"], "left").join(whole, "root")
    return kept.withColumns({"size": F.coalesce("__upto", "__all") - F.col("__before"), "idx": F.col("__before")}).select(*nodes.columns)


def infall_histogram(forest: Forest, targets: DataFrame, low: float, high: float, bins: int, log: bool = True) -> DataFrame:
    """bin (from 0), n: masses of the halos that merge onto the main branches of `targets` (id), in equal bins of the
    mass or its logarithm from low to high, the upper edge excluded; bins without halos have n = 0."""
    of = forest.nodes.join(targets.select("id"), "id", "left_semi").select(F.col("branch").alias("pbranch"), F.col("d").alias("from"))
    x = F.log10("head_mass") if log else F.col("head_mass")
    lo, hi = (math.log10(v) for v in (low, high)) if log else (float(low), float(high))
    merged = forest.branches.where("pbranch is not null").join(of, "pbranch").where("at >= from")
    at = merged.select(F.floor((x - lo) / ((hi - lo) / bins)).cast("int").alias("bin")).where(F.col("bin").between(0, bins - 1))
    spine = forest.nodes.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(at.groupBy("bin").agg(F.count("*").alias("n")), "bin", "left").fillna(0, ["n"])


def adjacency(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """target, i, j, mass: halo at place i of the target's subtree descends to the one at place j; none for the target
    itself."""
    sub = subtrees(nodes, targets).select("target", "id", "desc", "place", "mass")
    goal = sub.select("target", F.col("id").alias("desc"), F.col("place").alias("j"))
    return sub.join(goal, ["target", "desc"]).select("target", F.col("place").alias("i"), "j", "mass")


def extracted(forest: Forest, targets: DataFrame, threshold: float, max_steps: int) -> DataFrame:
    """target, id, step, mass: subtree halos at most max_steps below the target, all above the threshold on the way."""
    sub = subtrees(forest.nodes, targets)
    top = forest.nodes.select(F.col("id").alias("target"), F.col("depth").alias("top"))
    near = sub.join(top, "target").withColumn("step", F.col("depth") - F.col("top")).where(F.col("step") <= max_steps)
    keep = pruned(forest, threshold).select("id")
    return near.join(keep, "id", "left_semi").select("target", "id", F.col("step").cast("int").alias("step"), "mass")


def chunk_of_roots(tops: DataFrame, order: str, n_chunks: int, place: str | None = None) -> DataFrame:
    """tops with `chunk`: equal numbers of roots in the order of their whole-number key, the rest in the last chunk; and
    with `place`, if named, their place in that order."""
    if n_chunks < 1:
        raise ValueError("at least one chunk")
    size = max(1, tops.count() // n_chunks)
    at = running_place(tops, order, "__place")
    at = at.withColumn("chunk", F.least(F.expr(f"__place div {size}"), F.lit(n_chunks - 1)).cast("int"))
    return at.drop("__place") if place is None else at.withColumnRenamed("__place", place)
