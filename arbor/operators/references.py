"""References to records that do not exist, are withdrawn, or arrive after the record that names them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GOAL = ["ref_table", "ref_scope", "ref_key"]


def orphan_references(children: DataFrame, parents: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """The rows of `children` whose goal is bad, with `reason` 'missing', 'withdrawn' or 'late'.

    children: ref_table, ref_scope, ref_key (the goal), arrival, and what identifies the referring record.
    parents: ref_table, ref_scope, ref_key, arrival, one row per key. withdrawn: ref_table, ref_scope, ref_key,
    repeated rows allowed. Null-safe scopes are the caller's: ref_scope is never null. Rows with a null ref_key are
    no references. With several reasons the first of missing, withdrawn, late is given. Empty tables give no rows.

    Parent and child keys are united in long form and grouped by table and key; the aggregate is combined before the
    shuffle, so a goal named by a third of all rows costs one row per task. Only groups that lack a good parent are
    kept and joined back to the rows that name them; adaptive execution broadcasts them if their measured size allows
    and splits skewed partitions otherwise.
    """
    children = children.where("ref_key is not null")
    null = F.lit(None)
    when = children.schema["arrival"].dataType
    long = (
        parents.select(*GOAL, F.lit(1).alias("there"), F.lit(0).alias("gone"), F.col("arrival").alias("came"), null.cast(when).alias("named"))
        .unionByName(withdrawn.select(*GOAL, F.lit(0).alias("there"), F.lit(1).alias("gone"), null.cast(when).alias("came"), null.cast(when).alias("named")))
        .unionByName(children.select(*GOAL, F.lit(0).alias("there"), F.lit(0).alias("gone"), null.cast(when).alias("came"), F.col("arrival").alias("named")))
    )
    groups = long.groupBy(*GOAL).agg(F.max("there").alias("there"), F.max("gone").alias("gone"), F.min("came").alias("came"), F.min("named").alias("named"))
    bad = groups.where("named is not null and (there = 0 or gone = 1 or came > named)").drop("named")
    late = F.col("came") > F.col("arrival")
    reason = F.when(F.col("there") == 0, "missing").when(F.col("gone") == 1, "withdrawn").when(late, "late")
    return children.join(bad, GOAL).withColumn("reason", reason).where("reason is not null").drop("there", "gone", "came")


def orphans_by_period(orphans: DataFrame) -> DataFrame:
    """Counts of orphan references per table and period (origin_table, snapnum), by reason."""
    count = lambda r: F.sum((F.col("reason") == r).cast("long")).alias(f"n_{r}")
    return orphans.groupBy("origin_table", "snapnum").agg(count("missing"), count("withdrawn"), count("late"), F.count("*").alias("n_orphans"))
