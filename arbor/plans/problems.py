"""The queries of the general problems 1, 4 and 5 over the given tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import parent_tag
from ..operators.hierarchy import Peeled, descendant_lists, hierarchy, loop_nodes, resolve
from ..operators.records import keyed
from ..operators.references import orphan_references, orphans_by_period
from ..operators.skew import heavy_keys, salted_aggregate
from ..sources.tables import read_table
from .cut import cut, drop

FOREST, CORES = "forest", "coreproperties"
#: Scope of the forest, which is one; the scope of cores is their snapshot.
ONE = -1


def _keys(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    halos = keyed(read_table(spark, folder, FOREST), ["tree_node_index"], ["desc_node_index", "snapnum", "branch_size"])
    cores = keyed(read_table(spark, folder, CORES), ["core_tag", "snapnum"], ["host_core", "central"])
    return halos, cores


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    halos, cores = _keys(spark, folder)
    halos = halos.select(F.lit(FOREST).alias("origin_table"), F.lit(ONE).alias("ref_scope"), F.col("snapnum").cast("int").alias("snapnum"), F.col("tree_node_index").alias("key_id"), F.when(F.col("desc_node_index") >= 0, F.col("desc_node_index")).alias("ref_key"), "arrival")
    own = (F.col("host_core") > 0) & (F.col("host_core") != F.col("core_tag"))
    cores = cores.select(F.lit(CORES).alias("origin_table"), F.col("snapnum").cast("int").alias("ref_scope"), F.col("snapnum").cast("int").alias("snapnum"), F.col("core_tag").alias("key_id"), F.when(own, F.col("host_core")).alias("ref_key"), "arrival")
    keys = cut(halos.unionByName(cores), "keys")
    goal = F.col("origin_table").alias("ref_table")
    gone = read_table(spark, folder, "withdrawn_keys").where("reinstated_at is null and key_id is not null")
    gone = gone.select(goal, F.when(F.col("origin_table") == FOREST, F.lit(ONE)).otherwise(F.col("snapnum").cast("int")).alias("ref_scope"), F.col("key_id").alias("ref_key")).where("ref_scope is not null")
    return orphan_references(keys.withColumn("ref_table", F.col("origin_table")), keys.select(goal, "ref_scope", F.col("key_id").alias("ref_key"), "arrival"), gone)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each reference to an absent, withdrawn or later goal."""
    return orphans(spark, folder).select("origin_table", "snapnum", "key_id", "ref_key")


def p1_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references per table and snapshot, by reason."""
    return orphans_by_period(orphans(spark, folder))


def _finite(c: str) -> Column:
    """The value as a double, null if it is null, NaN or infinite."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def p4_tags(spark: SparkSession, folder: str, share: float = 0.01) -> DataFrame:
    """Rows and summed finite mass per parent tag, every delivered row counted; null is a tag of its own."""
    rows = read_table(spark, folder, FOREST).select(parent_tag(F.col("fof_halo_tag")).alias("fof_tag"), "tree_node_mass")
    return salted_aggregate(rows, "fof_tag", {"mass_sum": _finite("tree_node_mass")}, heavy_keys(rows, "fof_tag", share))


def p4_sizes(spark: SparkSession, folder: str, share: float = 0.01) -> DataFrame:
    """Rows and summed finite mass per branch_size, every delivered row counted; null is a size of its own."""
    rows = read_table(spark, folder, FOREST).select(F.col("branch_size").cast("long").alias("branch_size"), "tree_node_mass")
    return salted_aggregate(rows, "branch_size", {"mass_sum": _finite("tree_node_mass")}, heavy_keys(rows, "branch_size", share))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Parent tags of more than 1 % of all rows of forest."""
    tags = cut(p4_tags(spark, folder), "tags")
    n = tags.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    return tags.where(F.col("fof_tag").isNotNull() & (F.col("n_rows") * 100 > n)).select("fof_tag")


def links(spark: SparkSession, folder: str) -> DataFrame:
    """The links of problem 5: scope, id, parent of every key; the parent is null where the record names none. The
    stored branch_size, however wrong, only steers which child continues a chain."""
    halos, cores = _keys(spark, folder)
    halos = halos.select(F.lit(ONE).alias("scope"), F.col("tree_node_index").alias("id"), F.when(F.col("desc_node_index") >= 0, F.col("desc_node_index")).alias("parent"), F.col("branch_size").cast("double").alias("weight"), F.col("snapnum").cast("int").alias("note"))
    own = (F.coalesce("central", F.lit(0)) == 1) & (F.col("host_core") == F.col("core_tag"))
    cores = cores.select(F.col("snapnum").cast("int").alias("scope"), F.col("core_tag").alias("id"), F.when((F.col("host_core") > 0) & ~own, F.col("host_core")).alias("parent"), F.lit(0.0).alias("weight"), F.col("snapnum").cast("int").alias("note"))
    return cut(halos.unionByName(cores), "links")


def _resolved(spark: SparkSession, folder: str) -> Peeled:
    rows = links(spark, folder)
    peeled = resolve(rows)
    drop(rows)
    return peeled


def _named(df: DataFrame, *rest: str) -> DataFrame:
    """scope, id and note as origin_table, snapnum and key_id; a halo's snapshot is that of its record."""
    return df.select(F.when(F.col("scope") == ONE, FOREST).otherwise(CORES).alias("origin_table"), F.col("note").alias("snapnum"), F.col("id").alias("key_id"), *rest)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each key that lies on a loop."""
    return _named(loop_nodes(_resolved(spark, folder)))


def p5_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Root, depth, path and number of descendants of each key that isn't on a loop."""
    return _named(hierarchy(_resolved(spark, folder), with_note=True), "root", "depth", "path", "n_descendants")


def p5_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """All descendants of each node: scope (-1: forest, else the cores' snapshot), id, descendant, distance."""
    return descendant_lists(_resolved(spark, folder))


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p4_found, p4_tags, p4_sizes, p5_found, p5_tree, p5_descendants)}

_LATEST = """halos AS (SELECT tree_node_index AS id, max(struct_pack(t := loaded_at, d := desc_node_index, s := snapnum)) AS r, min(loaded_at) AS arrival
  FROM forest WHERE tree_node_index IS NOT NULL GROUP BY 1),
cores AS (SELECT core_tag AS id, snapnum, max(struct_pack(t := loaded_at, h := host_core, c := central)) AS r, min(loaded_at) AS arrival
  FROM coreproperties WHERE core_tag IS NOT NULL AND snapnum IS NOT NULL GROUP BY 1, 2)"""
_ORPHANS = f"""WITH {_LATEST},
goals AS (SELECT 'forest' AS o, -1 AS scope, id, arrival FROM halos UNION ALL SELECT 'coreproperties', snapnum, id, arrival FROM cores),
refs AS (SELECT 'forest' AS o, -1 AS scope, r.s AS snapnum, id, r.d AS ref, arrival FROM halos WHERE r.d >= 0
  UNION ALL SELECT 'coreproperties', snapnum, snapnum, id, r.h, arrival FROM cores WHERE r.h > 0 AND r.h <> id),
gone AS (SELECT DISTINCT origin_table AS o, CASE WHEN origin_table = 'forest' THEN -1 ELSE snapnum END AS scope, key_id AS id FROM withdrawn_keys WHERE reinstated_at IS NULL),
bad AS (SELECT r.o, r.snapnum, r.id, r.ref, CASE WHEN g.id IS NULL THEN 'missing' WHEN w.id IS NOT NULL THEN 'withdrawn' WHEN g.arrival > r.arrival THEN 'late' END AS reason
  FROM refs r LEFT JOIN goals g ON g.o = r.o AND g.scope = r.scope AND g.id = r.ref LEFT JOIN gone w ON w.o = r.o AND w.scope = r.scope AND w.id = r.ref)"""
_TAGS = "CASE WHEN fof_halo_tag > 0 THEN fof_halo_tag ELSE (-fof_halo_tag) & 281474976710655 END"
_MASS = "coalesce(sum(CASE WHEN isfinite(tree_node_mass) THEN CAST(tree_node_mass AS DOUBLE) END), 0)"
_LINKS = f"""WITH RECURSIVE {_LATEST},
links AS (SELECT -1 AS scope, id, CASE WHEN r.d >= 0 THEN r.d END AS parent, CAST(r.s AS INT) AS snapnum FROM halos
  UNION ALL SELECT snapnum, id, CASE WHEN r.h > 0 AND NOT (coalesce(r.c, 0) = 1 AND r.h = id) THEN r.h END, CAST(snapnum AS INT) FROM cores)"""
_TREE = f"""{_LINKS},
tree AS (SELECT l.scope, l.id, l.snapnum, l.id AS root, CAST(0 AS BIGINT) AS depth, [l.id] AS path FROM links l LEFT JOIN links p ON p.scope = l.scope AND p.id = l.parent WHERE p.id IS NULL
  UNION ALL SELECT l.scope, l.id, l.snapnum, t.root, t.depth + 1, list_append(t.path, l.id) FROM links l JOIN tree t ON l.scope = t.scope AND l.parent = t.id)"""
# nodes that a walk of many steps from somewhere still reaches lie on a loop: strip nodes without children again and again by counting walks
_ON_LOOP = f"""{_LINKS},
rooted AS (SELECT l.scope, l.id FROM links l LEFT JOIN links p ON p.scope = l.scope AND p.id = l.parent WHERE p.id IS NULL
  UNION ALL SELECT l.scope, l.id FROM links l JOIN rooted r ON l.scope = r.scope AND l.parent = r.id),
rest AS (SELECT * FROM links l WHERE NOT EXISTS (SELECT 1 FROM rooted r WHERE r.scope = l.scope AND r.id = l.id)),
walk AS (SELECT scope, id AS start, parent AS at FROM rest UNION SELECT w.scope, w.start, r.parent FROM walk w JOIN rest r ON r.scope = w.scope AND r.id = w.at),
looped AS (SELECT r.scope, r.id, r.snapnum FROM rest r JOIN walk w ON w.scope = r.scope AND w.start = r.id AND w.at = r.id)"""
_NAME = "CASE WHEN scope = -1 THEN 'forest' ELSE 'coreproperties' END AS origin_table"

ORACLES = {
    "p1_found": f"{_ORPHANS} SELECT o AS origin_table, CAST(snapnum AS INT) AS snapnum, id AS key_id, ref AS ref_key FROM bad WHERE reason IS NOT NULL",
    "p1_counts": f"{_ORPHANS} SELECT o AS origin_table, CAST(snapnum AS INT) AS snapnum, count(*) FILTER (reason = 'missing') AS n_missing, count(*) FILTER (reason = 'withdrawn') AS n_withdrawn, count(*) FILTER (reason = 'late') AS n_late, count(*) AS n_orphans FROM bad WHERE reason IS NOT NULL GROUP BY 1, 2",
    "p4_found": f"SELECT {_TAGS} AS fof_tag FROM forest GROUP BY 1 HAVING fof_tag IS NOT NULL AND count(*) * 100 > (SELECT count(*) FROM forest)",
    "p4_tags": f"SELECT {_TAGS} AS fof_tag, count(*) AS n_rows, {_MASS} AS mass_sum FROM forest GROUP BY 1",
    "p4_sizes": f"SELECT CAST(branch_size AS BIGINT) AS branch_size, count(*) AS n_rows, {_MASS} AS mass_sum FROM forest GROUP BY 1",
    "p5_found": f"{_ON_LOOP} SELECT {_NAME}, snapnum, id AS key_id FROM looped",
    "p5_tree": f"""{_ON_LOOP.replace("rooted AS", "tree0 AS").replace("rooted r", "tree0 r")}, {_TREE.removeprefix(_LINKS).lstrip(",").strip()},
alln AS (SELECT scope, id, snapnum, root, depth, path FROM tree UNION ALL SELECT r.scope, r.id, r.snapnum, NULL, NULL, NULL FROM rest r WHERE NOT EXISTS (SELECT 1 FROM looped x WHERE x.scope = r.scope AND x.id = r.id)),
pairs AS (SELECT scope, id AS up FROM (SELECT scope, id, unnest(path[1:-2]) AS id2 FROM tree) WHERE false),
under AS (SELECT scope, id2 AS id, count(*) AS n FROM (SELECT scope, unnest(path[1:-2]) AS id2 FROM tree) GROUP BY 1, 2
  UNION ALL SELECT w.scope, w.at, count(DISTINCT w.start) FROM walk w JOIN alln a ON a.scope = w.scope AND a.id = w.at AND a.root IS NULL GROUP BY 1, 2)
SELECT {_NAME}, snapnum, id AS key_id, root, depth, path, coalesce(n, 0) AS n_descendants FROM alln LEFT JOIN under USING (scope, id)""",
    "p5_descendants": f"{_TREE} SELECT scope, unnest(path[1:-2]) AS id, id AS descendant, unnest(range(depth, 0, -1)) AS distance FROM tree",
}
