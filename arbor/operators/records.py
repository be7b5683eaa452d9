"""One row per key from tables in which keys are delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a missing load time, so that a row with one always wins.
NO_TIME = "0001-01-01 00:00:00"


def keyed(df: DataFrame, keys: list[str], values: list[str], at: str = "loaded_at") -> DataFrame:
    """One row per key: `values` of the record (the row with the latest `at`) and `arrival`, the earliest `at`.

    Rows with a null in a key are dropped. Rows equal in `at` are taken to be identical; if they are not, one of
    them is taken whole. A null `at` counts as before any other; a key with no other has a null arrival. Every aggregate holds fixed-width values, so Spark
    hashes and combines before the shuffle, and a key that holds a third of all rows costs one row per task.
    """
    when = F.coalesce(F.col(at), F.lit(NO_TIME).cast("timestamp_ntz" if dict(df.dtypes)[at] == "timestamp_ntz" else "timestamp"))
    there = df.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    picked = there.select(*keys, *values, when.alias("__at"), F.col(at).alias("__came"))
    return picked.groupBy(*keys).agg(*(F.max_by(v, "__at").alias(v) for v in values), F.min("__came").alias("arrival"))
