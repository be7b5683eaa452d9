"""Items of varying length into containers of fixed capacity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Containers of one block, which one task packs: with k containers to fill, about 1 / k of the space stays free.
PER_BLOCK = 256


def lowest_cost(sizes: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float | None = None) -> np.ndarray:
    """The container of each item. `sizes` descend and none exceeds the capacity. An item of size s costs
    linear * s + quadratic * s^2 (quadratic: 1 / capacity, if None) and goes to the container of lowest cost so far
    that has room, a new one if none has; at first there are as many as the sum of the sizes needs at least."""
    quadratic = 1.0 / capacity if quadratic is None else quadratic
    n = max(1, -(-int(sizes.sum()) // capacity))
    room, cost = np.full(n, capacity, dtype=np.int64), np.zeros(n)
    out = np.empty(len(sizes), dtype=np.int64)
    for i, s in enumerate(sizes.tolist()):
        k = int(np.where(room >= s, cost, np.inf).argmin())
        if room[k] < s:
            k = len(room)
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
        room[k] -= s
        cost[k] += linear * s + quadratic * s * s
        out[i] = k
    return out


def pack(items: DataFrame, item: str, size: str, layouts: DataFrame, layout: str, capacity: str, linear: float = 1.0, quadratic: float | None = None) -> DataFrame:
    """layout, item, piece, n_pieces, size, container: where each piece of each item lies, in each layout.

    An item is whole (one piece) unless it exceeds the capacity; then it gives full pieces, each with a container of
    its own, and the rest, if any, is packed like an item. Items with a null id and items whose size is null or not
    positive have no place and no row; repeated rows are items of their own, scattered like others; empty tables give no
    rows. `layouts` is a small table (at most 1,000 rows, checked); rows with a null or non-positive capacity are left out.

    Items are scattered by hash over blocks of about PER_BLOCK containers, so a task holds at most that many containers'
    worth of items, whatever the input; within a block they are assigned by descending size to the container of lowest
    linear plus quadratic cost that has room.
    """
    shapes = [(r[0], r[1]) for r in layouts.select(layout, F.col(capacity).cast("long")).where(F.col(capacity) > 0).dropna().distinct().take(1001)]
    if len(shapes) > 1000:
        raise ValueError("more than 1000 layouts")
    there = items.select(F.col(item).alias("item"), F.col(size).cast("long").alias("size")).where("item is not null and size > 0")
    # only what doesn't fill containers of its own goes into blocks
    rests = there.agg(*(F.coalesce(F.sum(F.expr(f"size % {c}L")), F.lit(0)) for _, c in shapes)).first() if shapes else []
    kinds = F.array(*(F.struct(F.lit(a).alias("layout"), F.lit(c).cast("long").alias("capacity"), F.lit(max(1, round(n / (c * PER_BLOCK)))).cast("long").alias("blocks")) for (a, c), n in zip(shapes, rests))) if shapes else F.expr("array()").cast("array<struct<layout:string,capacity:bigint,blocks:bigint>>")
    copies = there.groupBy("item", "size").agg(F.count("*").alias("copies")).select("item", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    each = copies.withColumn("kind", F.explode(kinds)).select("item", "size", "copy", "kind.*").withColumns({"full": F.expr("size div capacity"), "rest": F.expr("size % capacity")})
    pieces = F.col("full") + (F.col("rest") > 0).cast("long")
    full = each.where("full > 0").select("layout", "item", "copy", F.col("size").alias("whole"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("full"))).alias("piece"), pieces.alias("n_pieces"), F.col("capacity").alias("size"))
    full = full.withColumn("container", F.concat_ws("-", F.lit("t"), "item", "whole", "copy", "piece"))
    rest = each.where("rest > 0").select("layout", "item", pieces.alias("piece"), pieces.alias("n_pieces"), F.col("rest").alias("size"), "capacity", F.pmod(F.xxhash64("layout", "item", "size", "copy"), F.col("blocks")).alias("block"))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        k = lowest_cost(rows["size"].to_numpy(), int(rows["capacity"].iloc[0]), linear, quadratic)
        rows["container"] = "b" + rows["block"].astype(str) + "-" + pd.Series(k).astype(str)
        return rows[["layout", "item", "piece", "n_pieces", "size", "container"]]

    kind = dict(there.dtypes)["item"]
    placed = rest.groupBy("layout", "block").applyInPandas(packed, f"layout string, item {kind}, piece long, n_pieces long, size long, container string")
    return full.select("layout", "item", "piece", "n_pieces", "size", "container").unionByName(placed)


def fills(placed: DataFrame, layouts: DataFrame, layout: str, capacity: str) -> DataFrame:
    """layout, container, n_pieces, size, fill (share of the capacity) of each container."""
    used = placed.groupBy("layout", "container").agg(F.count("*").alias("n_pieces"), F.sum("size").alias("size"))
    room = layouts.select(F.col(layout).alias("layout"), F.col(capacity).cast("long").alias("capacity")).where("capacity > 0").distinct()
    return used.join(room, "layout").select("layout", "container", "n_pieces", "size", (F.col("size") / F.col("capacity")).alias("fill"))
