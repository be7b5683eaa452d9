"""Halos as they arrive: the incremental form of the catalog's quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def arrivals(stream: DataFrame, late: str = "7 days", every: str = "1 day") -> DataFrame:
    """window, snapnum, n_rows, n_keys (about), bad_mass, mass_sum per window of loaded_at, of a stream of forest rows.

    Rows are counted up to `late` behind the latest one seen; later ones are dropped, as the watermark says. Deliveries
    of a key are told apart by a sketch, so the state is one row per window and snapshot, whatever the number of halos.
    Null, NaN and infinite masses are counted as bad and add nothing. Works on a batch as well.
    """
    mass = F.col("tree_node_mass").cast("double")
    fine = ~F.isnan(mass) & (F.abs(mass) != float("inf"))
    rows = stream.select(F.col("loaded_at").cast("timestamp").alias("loaded_at"), "snapnum", "tree_node_index", F.when(fine, mass).alias("m"))
    grouped = rows.withWatermark("loaded_at", late).groupBy(F.window("loaded_at", every), "snapnum")
    return grouped.agg(F.count("*").alias("n_rows"), F.approx_count_distinct("tree_node_index").alias("n_keys"), F.sum(F.col("m").isNull().cast("long")).alias("bad_mass"), F.coalesce(F.sum("m"), F.lit(0.0)).alias("mass_sum"))
