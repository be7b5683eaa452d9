"""Aggregates per key where a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Candidates for keys that hold more than `share` of the rows: all such keys and possibly some others.

    The frequent-items summary is one pass, keeps 2 / share counters per task, and never misses a key above `share`;
    so at most 2 / share values reach the driver, whatever the input's size. Null is never among them; an empty
    table has none.
    """
    items = df.select(F.col(key).alias("k")).where("k is not null").freqItems(["k"], share / 2).first()[0]
    return [x for x in items or [] if x is not None]


#: A key is hot with more than this share of all rows, and more than so many; at most 1 / HOT keys are.
HOT, LEAST_HOT = 0.001, 10_000


def hot_keys(counts: DataFrame, key: str, count: str, n: int) -> list:
    """The few values of `key` whose `count` is a large part of n, which is at least the sum of all counts."""
    return [r[0] for r in counts.where(F.col(count) > max(LEAST_HOT, n * HOT)).select(key).distinct().collect()]


def salted_aggregate(df: DataFrame, key: str, sums: dict[str, Column], heavy: list, salts: int = 32, seed: int = 7) -> DataFrame:
    """Per value of `key` (null is a value of its own): `n_rows` and the sum of each column of `sums`; a sum over no
    value is 0. Rows of `heavy` keys get a random salt, partial results are made per key and salt and then merged by
    key, so no task holds more of a heavy key than its share. The salt is drawn from the row's place in the input with
    a fixed seed, so a repeated task draws the same."""
    rows = df.select(F.col(key).alias("key"), *(c.alias(f"s_{k}") for k, c in sums.items()))
    salt = F.when(F.col("key").isin(heavy), F.floor(F.rand(seed) * salts).cast("int")).otherwise(F.lit(0)) if heavy else F.lit(0)
    partial = rows.withColumn("salt", salt).groupBy("key", "salt").agg(F.count("*").alias("n_rows"), *(F.sum(f"s_{k}").alias(k) for k in sums))
    merged = partial.groupBy("key").agg(F.sum("n_rows").alias("n_rows"), *(F.coalesce(F.sum(k), F.lit(0.0)).alias(k) for k in sums))
    return merged.withColumnRenamed("key", key)


def join_hot(left: DataFrame, right: DataFrame, on: list[str], hot_column: str, hot: list, scatter: Column, how: str = "inner", salts: int = 64) -> DataFrame:
    """`left` joined ("inner" or "left") with `right`, which has one row per `on`, where a few values of `hot_column`, one
    of `on`, may hold most rows of `left`. Rows of the values in `hot` get a salt from `scatter`, a whole-number column
    that tells rows apart, and their few partners are repeated for each salt; rows with a null there match nothing and are scattered
    over all tasks."""
    spread = lambda n: F.pmod(F.xxhash64(scatter), F.lit(n)).cast("int")
    key, ones, every = F.col(hot_column), F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(salts - 1))
    is_hot = key.isin(hot) if hot else F.lit(False)
    salted = left.withColumn("__salt", F.when(key.isNull(), spread(1009)).when(is_hot, spread(salts)).otherwise(F.lit(0)))
    repeated = right.withColumn("__salt", F.explode(F.when(is_hot, every).otherwise(ones)) if hot else F.lit(0))
    return salted.join(repeated, [*on, "__salt"], how).drop("__salt")
