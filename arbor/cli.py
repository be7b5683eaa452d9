"""Command line: catalogs to a forest, core properties to a core forest, cores onto a lightcone."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.derived import with_derived
from .operators import cores, forest, lightcone
from .operators.records import keyed
from .sources import configs, sinks


def convert(spark: SparkSession, path: str) -> None:
    """Catalogs (Parquet with a snapnum column) to closed forest files, as the INI file at `path` says."""
    c = configs.forest_config(path)
    name = lambda role: c.columns.get(role, role)
    rows = _records(spark.read.parquet(c.catalogs), [name("tree_node_index")])
    mass = F.col(name("tree_node_mass")).cast("double")
    catalog = rows.select(F.col(name("tree_node_index")).alias("id"), F.col(name("desc_node_index")).alias("desc"), F.col("snapnum").cast("int").alias("snapnum"), mass.alias("mass")).where("mass is not null and not isnan(mass) and abs(mass) < double('infinity')")
    if c.fail_on_missing and forest.orphans(catalog).limit(1).count():
        raise ValueError("there are halos whose descendant is missing")
    built = forest.build(catalog)
    extra = with_derived(rows, list(c.derived), c.simulation.rl).select(F.col(name("tree_node_index")).alias("id"), *(F.col(a).alias(b) for a, b in c.copy if b not in built.nodes.columns), *c.derived)
    sinks.write_forest(built.nodes.join(extra, "id"), c.output, sinks.files_for(built.nodes) if c.n_files is None else c.n_files)


def reorganize(spark: SparkSession, path: str, n_files: int = 16) -> None:
    """Core properties to core forest files, as the TOML file at `path` says."""
    c = configs.core_config(path)
    rows = _records(spark.read.parquet(c.cores).withColumn("snapnum", F.col("snapnum").cast("int")), cores.KEY)
    kept = cores.core_forest(rows, len(c.simulation.steps) - 1)
    sinks.write_cores(kept.join(rows.select(*dict.fromkeys(["core_tag", "snapnum", *c.columns])), cores.KEY), c.output, n_files)


def intersect(spark: SparkSession, core_path: str, halo_path: str, output: str, snapnum: int, step: int, box: float, grid: int) -> None:
    """Cores of one snapshot onto the halos of a lightcone step."""
    rows = _cores(spark, core_path)
    placed = lightcone.pipeline(rows, spark.read.parquet(halo_path), snapnum, box, grid, _infall(rows))
    sinks.write_lightcone(lightcone.output(placed, rows.where(F.col("snapnum") == snapnum), keep=_infall(rows)), output, step)


def intersect_steps(spark: SparkSession, core_path: str, halo_path: str, snapshot_path: str, output: str, box: float, grid: int) -> None:
    """Cores of all snapshots onto the halos of a whole lightcone, step by step as the table of snapshots has them."""
    rows = _cores(spark, core_path)
    placed = lightcone.pipeline_of_steps(rows, spark.read.parquet(halo_path), spark.read.parquet(snapshot_path), box, grid, _infall(rows))
    sinks.write_lightcone(lightcone.output(placed, rows, lightcone.SHELL, _infall(rows)), output)


def _records(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, its record, where rows have the time of their loading; else they are taken as they are."""
    if "loaded_at" not in rows.columns:
        return rows
    return keyed(rows, keys, [c for c in rows.columns if c not in keys and c != "loaded_at"]).drop("arrival")


def _infall(rows: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in rows.columns if c.startswith("infall_fof_halo_center_"))


def _cores(spark: SparkSession, path: str) -> DataFrame:
    return _records(spark.read.parquet(path).withColumn("snapnum", F.col("snapnum").cast("int")), cores.KEY)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="arbor", description=__doc__)
    sub = parser.add_subparsers(dest="what", required=True)
    sub.add_parser("convert").add_argument("config")
    sub.add_parser("reorganize").add_argument("config")
    cone = sub.add_parser("intersect")
    for name, kind in (("cores", str), ("halos", str), ("output", str), ("snapnum", int), ("step", int), ("box", float), ("grid", int)):
        cone.add_argument(name, type=kind)
    cone = sub.add_parser("intersect-steps")
    for name, kind in (("cores", str), ("halos", str), ("snapshots", str), ("output", str), ("box", float), ("grid", int)):
        cone.add_argument(name, type=kind)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("arbor").getOrCreate()
    if args.what == "intersect":
        intersect(spark, args.cores, args.halos, args.output, args.snapnum, args.step, args.box, args.grid)
    elif args.what == "intersect-steps":
        intersect_steps(spark, args.cores, args.halos, args.snapshots, args.output, args.box, args.grid)
    else:
        {"convert": convert, "reorganize": reorganize}[args.what](spark, args.config)


if __name__ == "__main__":
    main()
