"""Properties of halos while they are minor fragments, repaired from the rest of their branch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fix_fragments(df: DataFrame, values: list[str], mode: str = "constant_reverse", mask_negative: bool = False, suffix: str = "_fragfix") -> DataFrame:
    """df (branch, snapnum, fragment and `values`) with a repaired column for each value. Rows with fragment 0 keep theirs.

    constant_reverse: a minor fragment takes the value of the next later row of its branch that is none; the branch's
    latest row counts as such. linear: it takes the value interpolated in snapnum between the next later and the next
    earlier such rows; with mask_negative, the lesser of the two if that is negative; a run that ends a branch
    keeps its own. Windows run along branches, which are as long as there are snapshots.
    """
    if mode not in ("constant_reverse", "linear"):
        raise ValueError(f"unknown mode {mode}")
    late_first = Window.partitionBy("branch").orderBy(F.col("snapnum").desc())
    upto, onward = late_first.rowsBetween(Window.unboundedPreceding, 0), late_first.rowsBetween(0, Window.unboundedFollowing)
    good = (F.col("fragment") == 0) | (F.row_number().over(late_first) == 1)
    out = df.withColumn("__good", good)
    for v in values:
        point = F.when(F.col("__good"), F.struct(F.col("snapnum").alias("s"), F.col(v).alias("v")))
        later = F.last(point, ignorenulls=True).over(upto)
        if mode == "constant_reverse":
            out = out.withColumn(v + suffix, later["v"])
        else:
            out = out.withColumns({"__later": later, "__earlier": F.first(point, ignorenulls=True).over(onward)})
            a, b = F.col("__later.v"), F.col("__earlier.v")
            between = a + (b - a) * (F.col("__later.s") - F.col("snapnum")) / (F.col("__later.s") - F.col("__earlier.s"))
            if mask_negative:
                between = F.when(F.least(a, b) < 0, F.least(a, b)).otherwise(between)
            out = out.withColumn(v + suffix, F.when(F.col("__good") | F.col("__earlier").isNull(), F.col(v)).otherwise(between)).drop("__later", "__earlier")
    return out.drop("__good")
