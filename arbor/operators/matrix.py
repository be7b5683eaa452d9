"""Branches by snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import Forest


def branch_matrix(forest: Forest, threshold: float, last: int) -> DataFrame:
    """branch, snapnum, id, mass: one row per snapshot from 0 to `last` of each branch whose head's mass exceeds
    `threshold`; 0 where the branch has no halo."""
    heads = forest.branches.where(F.col("head_mass") > threshold).select("branch", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("snapnum"))
    cells = forest.nodes.select("branch", "snapnum", "id", "mass")
    return heads.join(cells, ["branch", "snapnum"], "left").fillna(0, ["id", "mass"])


def wide(matrix: DataFrame, value: str, last: int) -> DataFrame:
    """branch and one column per snapshot, s0 to s`last`; the columns are given, so there is no pass to find them."""
    cells = matrix.groupBy("branch").pivot("snapnum", list(range(last + 1))).agg(F.first(value))
    return cells.select("branch", *(F.col(str(s)).alias(f"s{s}") for s in range(last + 1)))


def branch_hosts(forest: Forest) -> DataFrame:
    """branch, snapnum, host, host_branch: for each snapshot after a branch has merged, the halo that holds it then, and
    that halo's branch."""
    rows = forest.branches.where("pbranch is not null").select("branch", "head_snap", F.size("prefix").alias("n"), F.posexplode("prefix").alias("up", "host"))
    of = forest.nodes.select(F.col("id").alias("host"), F.col("branch").alias("host_branch"))
    return rows.select("branch", (F.col("head_snap") + F.col("n") - F.col("up")).alias("snapnum"), "host").join(of, "host").select("branch", "snapnum", "host", "host_branch")
