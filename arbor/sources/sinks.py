"""Forests, core forests and lightcones as Parquet files in which no tree is split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.forest import above_mass, chunk_of_roots

#: Rows of a forest file where the number of files isn't given.
ROWS_A_FILE = 2_000_000


def files_for(nodes: DataFrame) -> int:
    """The number of files for `nodes`, so that each has about ROWS_A_FILE rows."""
    return max(1, -(-nodes.count() // ROWS_A_FILE))


def write_forest(nodes: DataFrame, path: str, n_files: int) -> None:
    """`n_files` closed files: every tree lies whole in one of them, in depth-first order, trees by root. One file
    (n_files = 1) is for small forests; a large one wants some hundred MB a file."""
    if n_files < 1:
        raise ValueError("at least one file")
    nodes.repartition(n_files, "root").sortWithinPartitions("root", "idx").write.mode("errorifexists").parquet(path)


def read_forest(spark: SparkSession, path: str, columns: list[str] | None = None, chunk: int | None = None, n_chunks: int = 1, threshold: float | None = None, last: int | None = None) -> DataFrame:
    """The forest at `path`: the keys and `columns`, or all. The caller's list is left as it is. With `last` only trees whose
    root is at that snapshot; with `chunk` (from 0) only the trees of that one of `n_chunks` chunks of as many roots, by
    id, the last with the rest; with a mass `threshold` without halos that don't exceed it and without all below those,
    places and sizes being those of what is left."""
    df = spark.read.parquet(path)
    if chunk is not None and not 0 <= chunk < n_chunks:
        raise ValueError(f"no chunk {chunk} of {n_chunks}")
    if chunk is not None or last is not None:
        tops = df.where("desc is null" + ("" if last is None else f" and snapnum = {int(last)}")).select("root")
        tops = tops if chunk is None else chunk_of_roots(tops, "root", n_chunks).where(F.col("chunk") == chunk).select("root")
        df = df.join(tops, "root", "left_semi")
    if threshold is not None:
        df = above_mass(df, threshold)
    return df if columns is None else df.select(*dict.fromkeys(["id", "desc", "snapnum", "root", "idx", "size", *columns]))


def write_cores(rows: DataFrame, path: str, n_files: int) -> None:
    """Core forests: all snapshots of a core in one file, latest first."""
    rows.repartition(n_files, "core_tag").sortWithinPartitions("core_tag", F.col("snapnum").desc()).write.mode("errorifexists").parquet(path)


def write_lightcone(rows: DataFrame, path: str, step: int | None = None, cells: int = 64) -> None:
    """Cores on the lightcone by step and cell of the sky, a halo's cores in the cell of the halo; the extent of each cell
    in theta and phi is beside them, as `extent`. Without a step given, rows have theirs in `step`."""
    name = "lc_halo" if "lc_halo_phi" in rows.columns else "host"
    cell = (F.floor(F.col(f"{name}_phi") * cells / 6.283185307179586) * cells + F.floor(F.col(f"{name}_theta") * cells / 3.141592653589794)).cast("int")
    placed = rows.withColumns({"step": F.col("step") if step is None else F.lit(step), "cell": cell})
    placed.repartition("step", "cell").write.partitionBy("step", "cell").mode("append").parquet(f"{path}/cores")
    extent = placed.groupBy("step", "cell").agg(*(f(c).alias(f"{n}_{c}") for c in (f"{name}_theta", f"{name}_phi") for n, f in (("min", F.min), ("max", F.max))), F.count("*").alias("n_cores"))
    extent.coalesce(1).write.mode("append").parquet(f"{path}/extent")
