"""Halo cores: hosts, core forests and core matrices. A core is (snapnum, core_tag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.cut import cut, drop
from .forest import chunk_of_roots
from .hierarchy import hierarchy, loop_nodes, resolve
from .prefix import exclusive_sum
from .skew import hot_keys, join_hot

KEY = ["snapnum", "core_tag"]


def host_links(cores: DataFrame) -> DataFrame:
    """cores with `host`: its own tag for a central, the tag that host_core names if that core is there in the same
    snapshot, else null."""
    named = F.when(F.coalesce("central", F.lit(0)) == 1, F.col("core_tag")).when(F.col("host_core") > 0, F.col("host_core"))
    there = cores.select("snapnum", F.col("core_tag").alias("host"), F.lit(True).alias("there"))
    linked = cores.withColumn("host", named).join(there, ["snapnum", "host"], "left")
    return linked.withColumn("host", F.when(F.col("there"), F.col("host"))).drop("there")


def top_hosts(cores: DataFrame) -> DataFrame:
    """snapnum, core_tag, top, second, depth, path, n_descendants: the host of hosts of each core, reached by following hosts until one has
    none but itself, and the last core before it (null for such a core and for those right below). Cores on a loop of
    hosts, and those that lead into one, have null top. Chains of hosts are labelled and peeled as in `hierarchy`."""
    links = cut(host_links(cores).select(F.col("snapnum").alias("scope"), F.col("core_tag").alias("id"), F.when(F.col("host") != F.col("core_tag"), F.col("host")).alias("parent")), "hosts")
    peeled = resolve(links)
    drop(links)
    tree = hierarchy(peeled).select(F.col("scope").alias("snapnum"), F.col("id").alias("core_tag"), F.col("root").alias("top"), F.when(F.col("depth") >= 2, F.element_at("path", 2)).alias("second"), "depth", "path", "n_descendants")
    return tree.unionByName(loop_nodes(peeled).select(F.col("scope").alias("snapnum"), F.col("id").alias("core_tag")), allowMissingColumns=True)


def group_order(tops: DataFrame) -> DataFrame:
    """tops (as `top_hosts` gives them) with `place`, from 0, in the depth-first order of the cores under one top: a core
    comes before those that it hosts, and these are in the order of their tags. Cores without a top are left out.

    A core comes after its host, and after the cores that this hosts with lesser tags with all below them; these sums
    are made per host, in two levels, and added up along the path. So no task gets a group whole."""
    rows = tops.where("top is not null")
    hosted = rows.where("depth > 0").select("snapnum", F.element_at("path", -2).alias("host"), "core_tag", (F.col("n_descendants") + 1).alias("n"))
    before = exclusive_sum(hosted, ["snapnum", "host"], [F.shiftright("core_tag", 12)], [F.col("core_tag")], F.col("n"), "before").select("snapnum", F.col("core_tag").alias("at"), "before")
    steps = rows.where("depth > 0").select("snapnum", "core_tag", F.explode(F.slice("path", F.lit(2), F.col("depth").cast("int"))).alias("at"))
    # those right below a top with very many cores are on many paths
    paths = steps.groupBy("snapnum", "at").agg(F.count("*").alias("n"))
    hot = hot_keys(paths, "at", "n", steps.count())
    placed = join_hot(steps, before, ["snapnum", "at"], "at", hot, F.col("core_tag")).groupBy("snapnum", "core_tag").agg(F.sum(F.col("before") + 1).alias("place"))
    return rows.join(placed, KEY, "left").withColumn("place", F.coalesce("place", F.lit(0).cast("long")))


def state(merged, central, tag):
    """-1 absent, 1 satellite, 0 central, 2 merged, the latter before the former."""
    return F.when(merged == 1, 2).when(central == 1, 0).when(tag > 0, 1).otherwise(-1)


def core_matrix(cores: DataFrame, last: int) -> DataFrame:
    """core_tag, snapnum, present, state for each snapshot from 0 to `last` of each core; -1 where it is absent."""
    spine = cores.select("core_tag").distinct().select("core_tag", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("snapnum"))
    cells = cores.select(*KEY, state(F.col("merged"), F.col("central"), F.col("core_tag")).alias("state"), F.lit(1).alias("present"))
    return spine.join(cells, KEY, "left").fillna(0, ["present"]).fillna(-1, ["state"])


def core_matrix_rows(cores: DataFrame, last: int, n_chunks: int = 1, fields: list[str] | None = None) -> DataFrame:
    """chunk, row, core_tag, snapnum, `fields` (all, if None), state and host_row: a matrix of the cores that the last snapshot has
    by snapshots from 0 to `last`, in `n_chunks` chunks of as many cores, the rest in the last one. row counts the cores by tag
    through all chunks, host_row is that of the core's host if it is in the same chunk, a central hosts itself, and
    cells where a core is absent have null fields and state -1. Chunks are kept apart by a filter on `chunk`."""
    fields = [c for c in cores.columns if c not in KEY] if fields is None else fields
    roots = cut(chunk_of_roots(cores.where(F.col("snapnum") == last).select("core_tag"), "core_tag", n_chunks, "row"), "roots")
    linked = host_links(cores).withColumn("state", state(F.col("merged"), F.col("central"), F.col("core_tag")))
    if "host_core" in fields:
        linked = linked.withColumn("host_core", F.coalesce("host", "host_core"))
    spine = roots.select("chunk", "row", "core_tag", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("snapnum"))
    cells = spine.join(linked.select(*KEY, *fields, "state", "host"), KEY, "left").withColumn("state", F.coalesce("state", F.lit(-1)))
    of = roots.select("chunk", F.col("core_tag").alias("host"), F.col("row").alias("host_row"))
    hosts = linked.where("host is not null").groupBy("host").agg(F.count("*").alias("n"))
    hot = hot_keys(hosts, "host", "n", hosts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return join_hot(cells, of, ["chunk", "host"], "host", hot, F.col("core_tag"), "left").drop("host")


def orphan_cores(cores: DataFrame, last: int) -> DataFrame:
    """Cores that the last snapshot lacks, with their rows."""
    final = cores.where(F.col("snapnum") == last).select("core_tag")
    gone = cores.join(final, "core_tag", "left_anti")
    return gone.groupBy("core_tag").agg(F.count("*").alias("n_rows"), F.max("snapnum").alias("last_seen"))


def core_forest(cores: DataFrame, last: int) -> DataFrame:
    """core_tag, snapnum, place: the gap-free run of snapshots that ends at the last one, for each core that is there;
    place counts back from it."""
    final = cores.where(F.col("snapnum") == last).select("core_tag")
    back = Window.partitionBy("core_tag").orderBy(F.col("snapnum").desc())
    rows = cores.join(final, "core_tag", "left_semi").select("core_tag", "snapnum", (F.row_number().over(back) - 1).alias("place"))
    return rows.where(F.col("snapnum") == last - F.col("place"))


def satellites_of_centrals(cores: DataFrame) -> DataFrame:
    """snapnum, core_tag, central_tag: satellites with the central of their FoF tag, the least tag if there are several.
    Skewed tags are split by adaptive execution; the centrals' side has one row per tag."""
    least = cores.where("central = 1 and fof_halo_tag is not null").groupBy("snapnum", "fof_halo_tag").agg(F.min("core_tag").alias("central_tag"))
    return cores.where("coalesce(central, 0) <> 1").join(least, ["snapnum", "fof_halo_tag"]).select(*KEY, "central_tag")
