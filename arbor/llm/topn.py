"""The N highest-scoring items of every group, by safe per-group thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def score_bin(score: Column, per_octave: int = 8) -> Column:
    """A whole number that never falls as the score rises: `per_octave` bins for each factor of two, either sign.
    There are at most 4,400 * per_octave of them for doubles, which bounds a group's histogram."""
    middle = 1100 * per_octave
    octave = F.floor(F.log2(F.abs(score)) * per_octave).cast("int") + middle
    return F.when(score > 0, octave).when(score < 0, -octave).otherwise(F.lit(0))


def top_n(df: DataFrame, group: str, score: str, tie: str, n: int = 3, min_items: int = 1) -> DataFrame:
    """group, rnk (1 to n), tie, score: for each group of at least `min_items` items its `n` best, by score
    descending, then tie ascending.

    Items whose group or tie is null, or whose score is null, NaN or infinite, don't count. Repeated rows are items of
    their own. Groups with fewer than n items give all they have; an empty table gives none. Other columns are ignored.

    Score histograms per group, combined before the shuffle, give each group a threshold bin above which at least n
    items lie; rows below it are dropped, and what is left is ranked exactly. Spark limits groups before the shuffle of
    the ranking (WindowGroupLimit), so that millions of equal scores in one bin cost a task n rows.
    """
    s = F.col(score).cast("double")
    items = df.select(F.col(group).alias("g"), F.col(tie).alias("t"), s.alias("s"))
    items = items.where("g is not null and t is not null and s is not null and not isnan(s) and abs(s) < double('infinity')")
    items = items.withColumn("bin", score_bin(F.col("s")))
    bins = items.groupBy("g", "bin").agg(F.count("*").alias("c"))
    down = Window.partitionBy("g").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counted = bins.withColumn("above", F.sum("c").over(down))
    limits = counted.groupBy("g").agg(F.sum("c").alias("items"), F.max(F.when(F.col("above") >= n, F.col("bin"))).alias("enough"), F.min("bin").alias("lowest"))
    limits = limits.where(F.col("items") >= min_items).select("g", F.coalesce("enough", "lowest").alias("least"))
    kept = items.join(limits, "g").where("bin >= least")
    best = Window.partitionBy("g").orderBy(F.col("s").desc(), F.col("t"))
    ranked = kept.withColumn("rnk", F.row_number().over(best)).where(F.col("rnk") <= n)
    return ranked.select(F.col("g").alias(group), "rnk", F.col("t").alias(tie), F.col("s").alias(score))
