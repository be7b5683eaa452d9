"""Running sums without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def exclusive_sum(df: DataFrame, by: list[str], bins: list[Column], order: list[Column], value: Column, name: str, nested: bool = False) -> DataFrame:
    """`df` with `name`: the sum of `value` over the rows of the same `by` that come before, in the order of `bins`,
    then `order`, which must tell any two rows apart.

    Two levels: sums per bin, with partial aggregation, are added up first, then each bin adds up its own rows. So a
    task holds the bins of a group, or the rows of a bin, but never the rows of a group. With `nested` the bins are
    added up in the same way, those of one coarser bin in one task, where a group has too many.
    """
    names = [f"__bin{i}" for i in range(len(bins))]
    rows = df.select("*", *(b.alias(n) for b, n in zip(bins, names)), value.alias("__value"))
    sums = rows.groupBy(*by, *names).agg(F.sum("__value").alias("__all"))
    if nested and len(names) > 1:
        coarse = ["__up" + n.removeprefix("__bin") + "_" + str(len(names)) for n in names]
        starts = exclusive_sum(sums.select(*by, *(F.col(n).alias(c) for n, c in zip(names, coarse)), "__all"), by, [F.col(c) for c in coarse[:-1]], [F.col(coarse[-1])], F.col("__all"), "__start", True)
        starts = starts.select(*by, *(F.col(c).alias(n) for n, c in zip(names, coarse)), "__start")
    else:
        before = Window.partitionBy(*by).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
        starts = sums.select(*by, *names, F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*by, *names).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__within", F.coalesce(F.sum("__value").over(within), F.lit(0))).join(starts, [*by, *names])
    return placed.select(*df.columns, (F.col("__start") + F.col("__within")).alias(name))


def running_max(df: DataFrame, by: list[str], bins: Column, order: Column, value: Column, name: str) -> DataFrame:
    """`df` with `name`: the greatest `value` of the rows of the same `by` up to and with this one, in the order of `bins`,
    then `order`; null if all are null. In the two levels of `exclusive_sum`."""
    rows = df.select("*", bins.alias("__bin"), value.alias("__value"))
    tops = rows.groupBy(*by, "__bin").agg(F.max("__value").alias("__most"))
    before = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = tops.select(*by, "__bin", F.max("__most").over(before).alias("__start"))
    within = Window.partitionBy(*by, "__bin").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("__within", F.max("__value").over(within)).join(starts, [*by, "__bin"])
    return placed.select(*df.columns, F.greatest("__start", "__within").alias(name))


def running_place(df: DataFrame, key: str, name: str) -> DataFrame:
    """`df` with `name`: the place of each row, from 0, in the order of the whole-number `key`, which tells rows apart, however
    sparse it is: bins of 2^12 keys, 2^16 of these in a coarser bin, and so again."""
    return exclusive_sum(df, [], [F.shiftright(key, n) for n in (44, 28, 12)], [F.col(key)], F.lit(1), name, nested=True)


def falling_bin(x: Column, per_octave: int = 8) -> Column:
    """A whole number that never rises as x rises, with `per_octave` bins for each factor of two."""
    octave = F.floor(F.log2(F.abs(x)) * per_octave).cast("int") + 1100 * per_octave
    return F.when(x > 0, -octave).when(x < 0, octave).otherwise(F.lit(0))
