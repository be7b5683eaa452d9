"""Queries of the reference's operators over forest, and SQL that gives the same rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.simulation import SIMULATIONS
from ..functions.tags import fragment_index, parent_tag
from ..operators import forest as fo
from ..operators.fragments import fix_fragments
from ..operators.matrix import branch_hosts, branch_matrix
from ..operators.records import keyed
from ..operators.submass import fsub_stats, sub_hosts, submass
from ..sources.sinks import files_for, read_forest, write_forest
from ..sources.tables import read_table, table_stamp
from .cut import fresh

SIM, BOX, LAST = SIMULATIONS["LastJourney"], 512.0, 100
LOW, HIGH = 1e12, 1e13
FIELDS = ["fof_halo_tag", "sod_halo_mass", "sod_halo_radius", "sod_halo_cdelta", "fof_halo_center_x", "fof_halo_center_y", "fof_halo_center_z"]
_built: dict[tuple, fo.Forest] = {}


def records(spark: SparkSession, folder: str) -> DataFrame:
    """id and the other columns of each halo's record, reals as doubles."""
    rows = keyed(read_table(spark, folder, "forest"), ["tree_node_index"], ["desc_node_index", "snapnum", "tree_node_mass", *FIELDS])
    reals = [c for c, t in rows.dtypes if t == "float"]
    return rows.withColumns({c: F.col(c).cast("double") for c in reals}).withColumn("snapnum", F.col("snapnum").cast("int")).withColumnRenamed("tree_node_index", "id")


def _fine(*columns: str) -> str:
    return " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in columns)


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    rows = keyed(read_table(spark, folder, "forest"), ["tree_node_index"], ["desc_node_index", "snapnum", "tree_node_mass"])
    rows = rows.select(F.col("tree_node_index").alias("id"), F.col("desc_node_index").alias("desc"), F.col("snapnum").cast("int").alias("snapnum"), F.col("tree_node_mass").cast("double").alias("mass"))
    return rows.where(_fine("mass") + " and snapnum is not null")


def built(spark: SparkSession, folder: str) -> fo.Forest:
    """The forest of `folder`, built once per application and state of its files, and kept as tables in the shared folder."""
    key = (spark.sparkContext.applicationId, folder, table_stamp(spark, folder, "forest"))
    if key not in _built:
        _built[key] = fo.build(catalog(spark, folder))
    return _built[key]


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    return built(spark, folder).nodes


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, folder).where((F.col("snapnum") == LAST) & (F.col("mass") > LOW) & (F.col("mass") < HIGH)).select("id")


def forest_scan(spark, folder):
    a = SIM.step2a(F.element_at(F.array(*(F.lit(s) for s in SIM.steps)), F.col("snapnum") + 1))
    return _nodes(spark, folder).join(fo.progenitor_count(_nodes(spark, folder)), "id").select("id", F.coalesce("desc", F.lit(-1)).alias("desc"), "snapnum", "mass", "root", "idx", "size", "progenitor_count", F.round(a, 9).alias("scale_factor"))


def forest_files(spark, folder):
    """The forest written as closed files, in which no tree is split, and read again."""
    path, nodes = fresh(spark, "files"), _nodes(spark, folder)
    write_forest(nodes, path, max(2, files_for(nodes)))
    return read_forest(spark, path, ["depth"]).select("id", F.coalesce("desc", F.lit(-1)).alias("desc"), "snapnum", "root", "idx", "size", "depth")


def forest_projection(spark, folder):
    return _nodes(spark, folder).select("id", F.coalesce("desc", F.lit(-1)).alias("desc"), "snapnum", "size")


def forest_z0_roots(spark, folder):
    tops = fo.roots(_nodes(spark, folder)).where(F.col("snapnum") == LAST).select("root")
    return _nodes(spark, folder).join(tops, "root", "left_semi").select("id", "root", "idx")


def forest_chunk(spark, folder, chunk: int = 1, n_chunks: int = 5):
    tops = fo.roots(_nodes(spark, folder)).where(F.col("snapnum") == LAST).select("root")
    mine = fo.chunk_of_roots(tops, "root", n_chunks).where(F.col("chunk") == chunk).select("root")
    return _nodes(spark, folder).join(mine, "root", "left_semi").select("id", "root", "idx")


def forest_chunks(spark, folder, n_chunks: int = 5):
    """The trees of all chunks, each with its chunk; the last one holds the remainder."""
    tops = fo.roots(_nodes(spark, folder)).where(F.col("snapnum") == LAST).select("root")
    return _nodes(spark, folder).join(fo.chunk_of_roots(tops, "root", n_chunks).select("root", "chunk"), "root").select("chunk", "id", "root", "idx")


def subtree_targets(spark, folder):
    return fo.subtrees(_nodes(spark, folder), _targets(spark, folder)).select("target", "id", "place")


def subtree_slice(spark, folder):
    at = _nodes(spark, folder).where((F.col("snapnum") == 50) & (F.col("mass") > LOW)).select("id")
    return fo.subtrees(_nodes(spark, folder), at).groupBy("target").agg(F.count("*").alias("n"), F.min("snapnum").alias("first_snap"))


def catalog_clean(spark, folder):
    rows = records(spark, folder).where(_fine("tree_node_mass", *(f"fof_halo_center_{c}" for c in "xyz"), "sod_halo_radius"))
    return rows.select("id", "snapnum", *(F.round(geometry.wrap(F.col(f"fof_halo_center_{c}"), BOX), 6).alias(c) for c in "xyz"))


def quality_metrics(spark, folder):
    bad = lambda c: F.sum((~F.coalesce(F.expr(_fine(c)), F.lit(False))).cast("long"))
    rows = read_table(spark, folder, "forest")
    return rows.groupBy(F.col("snapnum").cast("int").alias("snapnum")).agg(F.count("*").alias("n_rows"), bad("tree_node_mass").alias("bad_mass"), bad("sod_halo_radius").alias("bad_radius"), F.max("loaded_at").alias("last_load"))


def _steps(spark, folder) -> DataFrame:
    """id, snapnum, step and a, the scale factor, of each halo."""
    rows = read_table(spark, folder, "sim_snapshots").select(F.col("snapnum").cast("int").alias("snapnum"), "step", SIM.step2a(F.col("step")).alias("a"))
    return catalog(spark, folder).select("id", "snapnum").join(rows, "snapnum")


def scale_factor(spark, folder):
    return _steps(spark, folder).select("id", "snapnum", "step", F.round("a", 9).alias("scale_factor"))


def redshift(spark, folder):
    return _steps(spark, folder).select("id", F.round(1 / F.col("a") - 1, 9).alias("redshift"))


def hubble(spark, folder):
    return _steps(spark, folder).select("id", F.round(SIM.cosmo.hubble_parameter(F.col("a")), 6).alias("hubble"))


def virial_overdensity(spark, folder):
    return _steps(spark, folder).select("id", F.round(SIM.cosmo.virial_overdensity(F.col("a")), 6).alias("overdensity"))


def _lookbacks(spark, folder) -> DataFrame:
    """snapnum, step, lookback of each snapshot."""
    rows = read_table(spark, folder, "sim_snapshots").select(F.col("snapnum").cast("int").alias("snapnum"), "step")
    first = rows.agg(F.min("step")).first()[0]
    return rows.withColumn("lookback", SIM.cosmo.lookback_column(SIM.step2a(F.col("step")), SIM.step2a(0 if first is None else first)))


def lookback(spark, folder):
    """Lookback time in Gyr of each halo."""
    return catalog(spark, folder).select("id", "snapnum").join(_lookbacks(spark, folder), "snapnum").select("id", "snapnum", "step", F.round("lookback", 9).alias("lookback"))


def hubble_fraction(spark, folder):
    """Lookback time of each halo in Hubble times, and the time from its snapshot to the one after it in Gyr."""
    rows = _lookbacks(spark, folder)
    after = rows.select((F.col("snapnum") - 1).alias("snapnum"), F.col("lookback").alias("after"))
    times = rows.join(after, "snapnum", "left").select("snapnum", F.round(F.col("lookback") / SIM.cosmo.hubble_time(), 9).alias("fraction"), F.round(F.col("lookback") - F.col("after"), 9).alias("until_next"))
    return catalog(spark, folder).select("id", "snapnum").join(times, "snapnum").select("id", "fraction", "until_next")


def particle_count(spark, folder):
    """Particles of each halo: its mass over that of a particle."""
    return catalog(spark, folder).select("id", F.round(F.col("mass") / SIM.particle_mass(), 6).alias("n_particles"))


def fragment_split(spark, folder):
    t = F.col("fof_halo_tag")
    return records(spark, folder).where("fof_halo_tag is not null").select("id", parent_tag(t).alias("tag"), fragment_index(t).alias("fragment"))


def _deltas(spark, folder) -> tuple[DataFrame, list[Column]]:
    """Halos with a radius and a center, joined with their descendant's center, and the differences per axis."""
    rows = records(spark, folder).where(_fine("fof_halo_center_x", "fof_halo_center_y", "fof_halo_center_z", "sod_halo_radius", "sod_halo_mass") + " and sod_halo_radius > 0")
    goal = rows.select(F.col("id").alias("desc_node_index"), *(F.col(f"fof_halo_center_{c}").alias(f"d{c}") for c in "xyz"))
    return rows.join(goal, "desc_node_index"), [F.col(f"d{c}") - F.col(f"fof_halo_center_{c}") for c in "xyz"]


def xoff(spark, folder):
    """Distances of each halo's center from its descendant's, over its radius; -101 without a spherical mass."""
    rows, d = _deltas(spark, folder)
    return rows.select("id", F.round(geometry.offset(*d, F.col("sod_halo_radius"), F.col("sod_halo_mass"), BOX), 3).alias("xoff"), F.round(geometry.min_image(d[0], BOX), 5).alias("dx"))


def min_image(spark, folder):
    """From each halo's center to its descendant's, the shorter way round the box."""
    rows, d = _deltas(spark, folder)
    return rows.select("id", *(F.round(geometry.min_image(x, BOX), 5).alias(f"d{c}") for c, x in zip("xyz", d)))


def copy_rename(spark, folder):
    return records(spark, folder).select("id", F.col("fof_halo_tag").alias("tag"), F.col("fof_halo_tag").alias("tag_copy"), F.col("snapnum").alias("snapshot"))


def mass_bin_targets(spark, folder):
    return _targets(spark, folder)


def descendant_join(spark, folder):
    rows = catalog(spark, folder)
    return fo.linked(rows).select("id", F.when(F.col("found"), F.col("desc")).otherwise(F.lit(-1)).alias("desc"))


def orphans_anti(spark, folder):
    return fo.orphans(catalog(spark, folder)).select("id", "desc", "snapnum")


def orphans_to_roots(spark, folder):
    return fo.orphans_to_roots(catalog(spark, folder)).groupBy("snapnum").agg(F.count("*").alias("n"), F.sum(F.col("desc").isNull().cast("long")).alias("n_roots"))


def descendant_idx(spark, folder):
    n = _nodes(spark, folder)
    goal = n.select(F.col("id").alias("desc"), F.col("idx").alias("descendant_idx"))
    return n.select("id", "desc", "root", "idx").join(goal, "desc", "left").select("id", "root", "idx", F.coalesce("descendant_idx", F.lit(-1)).alias("descendant_idx"))


def progenitor_csr(spark, folder):
    return fo.progenitors(_nodes(spark, folder))


def csr_offsets(spark, folder):
    return fo.csr_offsets(_nodes(spark, folder)).select("id", "progenitor_count", "progenitor_offset")


def progenitor_count(spark, folder):
    return fo.progenitor_count(_nodes(spark, folder))


def branch_size(spark, folder):
    return _nodes(spark, folder).select("id", F.col("size").alias("branch_size"))


def dfs_order(spark, folder):
    return _nodes(spark, folder).select("id", "root", "idx")


def root_label(spark, folder):
    return _nodes(spark, folder).select("id", "root", "depth")


def branch_ids(spark, folder):
    return _nodes(spark, folder).select("id", "branch", "d")


def mainbranch(spark, folder):
    return fo.main_branch(_nodes(spark, folder), _targets(spark, folder)).select("target", "snapnum", "id")


def mainbranch_mass(spark, folder):
    return fo.main_branch(_nodes(spark, folder), _targets(spark, folder)).select("target", "snapnum", "mass")


def mean_mass_growth(spark, folder):
    main = fo.main_branch(_nodes(spark, folder), _targets(spark, folder))
    final = _nodes(spark, folder).select(F.col("id").alias("target"), F.col("mass").alias("final"))
    per = main.join(final, "target").groupBy("snapnum").agg(F.sum(F.col("mass") / F.col("final")).alias("s"))
    n = _targets(spark, folder).count()
    return per.select("snapnum", F.round(F.col("s") / n, 9).alias("mean_growth"))


def nth_progenitor(spark, folder):
    second, third = (fo.nth_progenitor(_nodes(spark, folder), k).select(F.col("desc").alias("id"), F.col("id").alias(f"p{k}")) for k in (2, 3))
    return second.join(third, "id", "left").select("id", "p2", F.coalesce("p3", F.lit(-1)).alias("p3"))


def _mergers(spark, folder) -> DataFrame:
    """target, snapnum of the merger's result, ratio of the second to the first progenitor, on main branches."""
    n = _nodes(spark, folder)
    main = fo.main_branch(n, _targets(spark, folder))
    one, two = (fo.nth_progenitor(n, k).select(F.col("desc").alias("id"), F.col("mass").alias(f"m{k}")) for k in (1, 2))
    return main.join(one, "id").join(two, "id", "left").select("target", "snapnum", F.coalesce(F.col("m2") / F.col("m1"), F.lit(0.0)).alias("ratio"))


def merger_probability(spark, folder, thresholds=(0.1, 0.3)):
    per = _mergers(spark, folder).groupBy("snapnum").agg(F.count("*").alias("n"), *(F.sum((F.col("ratio") > t).cast("long")).alias(f"k{i}") for i, t in enumerate(thresholds)))
    return per.select("snapnum", "n", *(F.round(F.col(f"k{i}") / F.col("n"), 9).alias(f"p{i}") for i in range(len(thresholds))))


def merger_rate(spark, folder, threshold: float = 0.1):
    per = _mergers(spark, folder).groupBy("snapnum").agg((F.sum((F.col("ratio") > threshold).cast("long")) / F.count("*")).alias("p"))
    back = _lookbacks(spark, folder).select("snapnum", "lookback")
    before = back.select((F.col("snapnum") + 1).alias("snapnum"), F.col("lookback").alias("before"))
    return per.join(back, "snapnum").join(before, "snapnum").select("snapnum", F.round(F.col("p") / (F.col("before") - F.col("lookback")), 9).alias("rate"))


def last_major_merger(spark, folder, ratio: float = 0.3):
    last = _mergers(spark, folder).groupBy("target").agg(F.max(F.when(F.col("ratio") > ratio, F.col("snapnum"))).alias("snapnum"))
    return _targets(spark, folder).withColumnRenamed("id", "target").join(last, "target", "left").select("target", F.coalesce("snapnum", F.lit(-1)).alias("snapnum"))


def most_massive(spark, folder):
    return _nodes(spark, folder).groupBy("snapnum").agg(F.max(F.struct("mass", F.bitwise_not("id").alias("n"))).alias("t")).select("snapnum", F.bitwise_not("t.n").alias("id"), F.col("t.mass").alias("mass"))


def infall_hist(spark, folder):
    return fo.infall_histogram(built(spark, folder), _targets(spark, folder), 1e10, 1e13, 20)


def mass_prune(spark, folder):
    return fo.pruned(built(spark, folder), 1e11).select("id", "root")


def mass_prune_size(spark, folder):
    return fo.pruned(built(spark, folder), 1e11).select("id", "size")


def forest_above_mass(spark, folder):
    """Halos above a mass whose descendants all are, with their new places and sizes, as reading forest files by mass gives them."""
    return fo.above_mass(_nodes(spark, folder), 1e11).select("id", "root", "idx", "size")


def adjacency_coo(spark, folder):
    return fo.adjacency(_nodes(spark, folder), _targets(spark, folder))


def tree_extract(spark, folder):
    return fo.extracted(built(spark, folder), _targets(spark, folder), 1e11, 20)


def root_order(spark, folder):
    tops = fo.roots(_nodes(spark, folder)).where(F.col("snapnum") == LAST).select("id")
    return fo.running_place(tops, "id", "place")


def sibling_order(spark, folder):
    n = _nodes(spark, folder).where("desc is not null")
    return fo.exclusive_sum(n.select("id", "desc", "mass"), ["desc"], [fo.falling_bin(F.col("mass"))], [F.col("mass").desc(), F.col("id")], F.lit(1), "place").select("id", "desc", "place")


def _fragments(spark, folder) -> DataFrame:
    extra = records(spark, folder).select("id", fragment_index(F.col("fof_halo_tag")).alias("fragment"), "sod_halo_cdelta").where("fragment is not null and " + _fine("sod_halo_cdelta"))
    return _nodes(spark, folder).select("id", "branch", "snapnum", "mass").join(extra, "id")


def fragfix_const(spark, folder):
    return fix_fragments(_fragments(spark, folder), ["mass", "sod_halo_cdelta"]).select("id", "mass_fragfix", "sod_halo_cdelta_fragfix")


def fragfix_linear(spark, folder):
    out = fix_fragments(_fragments(spark, folder), ["sod_halo_cdelta"], "linear", True)
    return out.select("id", F.round("sod_halo_cdelta_fragfix", 6).alias("sod_halo_cdelta_fragfix"))


def branch_matrix_rows(spark, folder):
    return branch_matrix(built(spark, folder), 3e11, LAST)


def branch_host_rows(spark, folder):
    return branch_hosts(built(spark, folder))


def sub_rows(spark, folder):
    return sub_hosts(built(spark, folder), LAST).groupBy("branch").agg(F.count("*").alias("n_rows"))


def sub_host_rows(spark, folder):
    return sub_hosts(built(spark, folder), LAST)


def sub_offsets(spark, folder):
    return sub_hosts(built(spark, folder), LAST).groupBy("host").agg(F.count("*").alias("n_subs"))


def sub_index(spark, folder):
    """For each halo how many subhalo rows it holds and, in its tree's order, how many the halos before it hold."""
    n = _nodes(spark, folder).select("root", "idx", "id")
    held = sub_hosts(built(spark, folder), LAST).groupBy(F.col("host").alias("id")).agg(F.count("*").alias("n"))
    rows = n.join(held, "id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return fo.exclusive_sum(rows, ["root"], [F.shiftright("idx", 12)], [F.col("idx")], F.col("n"), "sub_offset").select("id", "root", "sub_offset", F.col("n").alias("sub_size"))


def sub_order(spark, folder):
    """The place of each subhalo row among those of its host, by branch."""
    rows = sub_hosts(built(spark, folder), LAST).select("branch", "snapnum", "host")
    return fo.exclusive_sum(rows, ["host"], [F.shiftright("branch", 12)], [F.col("branch")], F.lit(1), "place")


def submass_rows(spark, folder):
    return submass(built(spark, folder), SIM, LAST).select("branch", "snapnum", F.round("mass", -3).alias("mass"))


def fsub_stats_rows(spark, folder):
    f = built(spark, folder)
    return fsub_stats(submass(f, SIM, LAST), sub_hosts(f, LAST), f.nodes).select("id", F.round("fsubtot", 6).alias("fsubtot"), F.round("fsubmax", 6).alias("fsubmax"))


QUERIES = {
    **{f.__name__: f for f in (forest_scan, forest_files, forest_projection, forest_z0_roots, forest_chunk, forest_chunks, subtree_targets, subtree_slice, catalog_clean, quality_metrics, scale_factor, redshift, hubble, virial_overdensity, lookback, hubble_fraction, particle_count, fragment_split, xoff, min_image, copy_rename, mass_bin_targets, descendant_join, orphans_anti, orphans_to_roots, descendant_idx, progenitor_csr, csr_offsets, progenitor_count, branch_size, dfs_order, root_label, branch_ids, mainbranch, mainbranch_mass, mean_mass_growth, nth_progenitor, merger_probability, merger_rate, last_major_merger, most_massive, infall_hist, mass_prune, mass_prune_size, forest_above_mass, adjacency_coo, tree_extract, root_order, sibling_order, fragfix_const, fragfix_linear, sub_rows, sub_offsets, sub_index, sub_order)},
    "branch_matrix": branch_matrix_rows, "branch_hosts": branch_host_rows, "sub_hosts": sub_host_rows, "submass": submass_rows, "fsub_stats": fsub_stats_rows,
}

_RECS = "recs AS (SELECT tree_node_index AS id, max(struct_pack(t := loaded_at, d := desc_node_index, s := CAST(snapnum AS INT), m := CAST(tree_node_mass AS DOUBLE), g := fof_halo_tag, sm := CAST(sod_halo_mass AS DOUBLE), sr := CAST(sod_halo_radius AS DOUBLE), sc := CAST(sod_halo_cdelta AS DOUBLE), x := CAST(fof_halo_center_x AS DOUBLE), y := CAST(fof_halo_center_y AS DOUBLE), z := CAST(fof_halo_center_z AS DOUBLE))) AS r FROM forest WHERE tree_node_index IS NOT NULL GROUP BY 1)"
_CAT = f"""WITH RECURSIVE {_RECS},
cat AS MATERIALIZED (SELECT id, r.d AS dsc, r.s AS snapnum, r.m AS mass, r.g AS tag FROM recs WHERE isfinite(r.m) AND r.s IS NOT NULL),
hal AS MATERIALIZED (SELECT c.id, CASE WHEN p.id IS NOT NULL THEN c.dsc END AS dsc, c.snapnum, c.mass, c.tag FROM cat c LEFT JOIN cat p ON p.id = c.dsc AND p.snapnum = c.snapnum + 1)"""
_TREE = f"""{_CAT},
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY dsc ORDER BY mass DESC, id) AS k FROM hal),
tree AS (SELECT id, dsc, snapnum, mass, id AS branch, id AS root, CAST(0 AS BIGINT) AS depth, [id] AS anc, CAST([] AS DOUBLE[]) AS path FROM ranked WHERE dsc IS NULL
  UNION ALL SELECT r.id, r.dsc, r.snapnum, r.mass, CASE WHEN r.k = 1 THEN t.branch ELSE r.id END, t.root, t.depth + 1, list_append(t.anc, r.id),
    CASE WHEN r.k = 1 THEN t.path ELSE list_concat(t.path, [CAST(r.snapnum AS DOUBLE), -r.mass, CAST(r.id AS DOUBLE)]) END FROM ranked r JOIN tree t ON r.dsc = t.id),
nodes AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY root ORDER BY path, snapnum DESC) - 1 AS idx FROM tree),
sizes AS MATERIALIZED (SELECT a AS id, count(*) AS size FROM (SELECT unnest(anc) AS a FROM tree) GROUP BY 1),
cnt AS (SELECT n.id, count(c.id) AS progenitor_count FROM nodes n LEFT JOIN nodes c ON c.dsc = n.id GROUP BY 1),
targets AS MATERIALIZED (SELECT id FROM nodes WHERE snapnum = {LAST} AND mass > {LOW} AND mass < {HIGH}),
main AS MATERIALIZED (SELECT t.id AS target, n.id, n.snapnum, n.mass FROM targets t JOIN nodes h ON h.id = t.id JOIN nodes n ON n.branch = h.branch AND n.snapnum <= h.snapnum)"""
_A = "(1.0::DOUBLE / 201 + (1 - 1.0::DOUBLE / 201) / 500 * ({} + 1))"
_STEP = "list_extract([" + ", ".join(map(str, SIM.steps)) + "], snapnum + 1)"
_STEPS = f"{_CAT}, st AS (SELECT c.id, c.snapnum, s.step, {_A.format('s.step')} AS a FROM cat c JOIN sim_snapshots s ON s.snapnum = c.snapnum)"
_OM, _OL, _H = SIM.cosmo.Omega_m, SIM.cosmo.Omega_L, SIM.cosmo.h
#: Lookback time of each snapshot by the trapezoid rule, as many steps for all as the earliest needs.
_BACK = f"""sa AS (SELECT CAST(snapnum AS INT) AS snapnum, step, {_A.format('step')} AS a, greatest(2, CAST(floor((1 - min({_A.format('step')}) OVER ()) / 1e-3) AS INT)) AS n FROM sim_snapshots),
sx AS (SELECT snapnum, step, a, n, i, a + (1 - a) * (i / (n - 1)) AS x FROM (SELECT *, unnest(range(n)) AS i FROM sa)),
back AS MATERIALIZED (SELECT snapnum, step, {SIM.cosmo.hubble_time()!r}::DOUBLE * sum(pow({_OM} / x + {_OL} * x * x, -0.5) * CASE WHEN i = 0 OR i = n - 1 THEN 0.5 ELSE 1 END) * (1 - a) / (n - 1) AS lookback FROM sx GROUP BY snapnum, step, a, n)"""
#: The recurrence of subhalo masses, as a wave: at round k the branches of nesting level l are at snapshot k - l, so a branch's own
#: last mass and its parent's present one are both of the round before.
_TIMES = SIM.step2a(np.array(SIM.steps[: LAST + 1], dtype=float))
_TAU = 1.628 * (SIM.cosmo.virial_overdensity(_TIMES) / SIM.cosmo.virial_overdensity(1.0)) ** -0.5 * (SIM.cosmo.hubble_parameter(_TIMES) / SIM.cosmo.hubble_parameter(1.0)) ** -1 / 1.1
_NUMBERS = lambda x: "[" + ", ".join(repr(float(v)) + "::DOUBLE" for v in x) + "]"
_PRUNED = f"""{_TREE}, low AS (SELECT id FROM nodes WHERE NOT mass > 1e11),
gone AS (SELECT DISTINCT n.id FROM (SELECT id, unnest(anc) AS a FROM nodes) n JOIN low ON low.id = n.a),
kept AS MATERIALIZED (SELECT * FROM nodes WHERE id NOT IN (SELECT id FROM gone))"""
_SUB = f"""{_TREE}, late AS (SELECT id FROM nodes WHERE dsc IS NULL AND snapnum = {LAST}),
heads AS (SELECT n.id, n.snapnum AS s0, n.dsc, p.branch AS pbranch, n.anc FROM nodes n JOIN nodes p ON p.id = n.dsc WHERE n.branch = n.id AND n.root IN (SELECT id FROM late)),
host AS (SELECT h.id AS branch, h.pbranch, a.snapnum, a.id AS host, b.snapnum AS phead FROM (SELECT id, pbranch, unnest(anc[1:-2]) AS aid FROM heads) h JOIN nodes a ON a.id = h.aid JOIN nodes b ON b.id = h.pbranch)"""
_SUBMASS = f"""{_SUB}, lev AS (SELECT id AS branch, 0 AS lev FROM late UNION ALL SELECT h.id, l.lev + 1 FROM heads h JOIN lev l ON h.pbranch = l.branch),
tt AS (SELECT {_NUMBERS(SIM.cosmo.lookback_time(_TIMES) * SIM.cosmo.h)} AS t, {_NUMBERS(_TAU)} AS tau),
sb AS MATERIALIZED (SELECT h.id AS b, h.pbranch AS p, h.s0, n.mass AS m0, p.snapnum AS phead, l.lev FROM heads h JOIN lev l ON l.branch = h.id JOIN nodes n ON n.id = h.id JOIN nodes p ON p.id = h.pbranch),
todo AS MATERIALIZED (SELECT sb.*, s, s + lev AS k, n.mass AS real, CASE WHEN s = s0 + 1 THEN (t[s0 + 1] + t[s0 + 2]) / 2 ELSE t[s] END - t[s + 1] AS past, tau[s + 1] AS tau
  FROM (SELECT *, unnest(range(s0 + 1, {LAST + 1})) AS s FROM sb) sb CROSS JOIN tt LEFT JOIN nodes n ON n.branch = sb.p AND n.snapnum = CASE WHEN s > phead THEN NULL WHEN s = s0 + 1 THEN s ELSE s - 1 END),
wave AS (SELECT 0 AS k, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS s, CAST(0 AS DOUBLE) AS m
  UNION ALL SELECT c.k + 1, x.b, x.s, x.m FROM (SELECT k FROM wave WHERE b = -1) c, LATERAL (SELECT CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS s, CAST(0 AS DOUBLE) AS m WHERE c.k < 2 * {LAST + 1}
    UNION ALL SELECT d.b, d.s, {{0}} * pow(1 + 0.1 * pow({{0}} / coalesce(d.real, w2.m), 0.1) * d.past / d.tau, -10.0) FROM todo d LEFT JOIN wave w1 ON w1.b = d.b LEFT JOIN wave w2 ON w2.b = d.p WHERE d.k = c.k + 1) x),
subs AS MATERIALIZED (SELECT b AS branch, CAST(s AS INT) AS snapnum, m AS mass FROM wave WHERE b <> -1)""".replace("{0}", "CASE WHEN d.s = d.s0 + 1 THEN d.m0 ELSE w1.m END")
_MERGE = f"""{_TREE}, sib AS (SELECT dsc, mass, row_number() OVER (PARTITION BY dsc ORDER BY mass DESC, id) AS k FROM nodes WHERE dsc IS NOT NULL),
mrg AS (SELECT m.target, m.snapnum, coalesce(b.mass / a.mass, 0) AS ratio FROM main m JOIN sib a ON a.dsc = m.id AND a.k = 1 LEFT JOIN sib b ON b.dsc = m.id AND b.k = 2)"""
_FRAG = f"""{_TREE}, fr AS (SELECT n.id, n.branch, n.snapnum, n.mass, CASE WHEN r.g < 0 THEN (-r.g) >> 48 ELSE 0 END AS fragment, r.sc FROM nodes n JOIN recs USING (id) WHERE r.g IS NOT NULL AND isfinite(r.sc)),
f2 AS (SELECT *, fragment = 0 OR row_number() OVER (PARTITION BY branch ORDER BY snapnum DESC) = 1 AS good FROM fr)"""
_WRAP = f"round((({{0}} % {BOX}) + {BOX}) % {BOX}, 6)"
_MI = f"({{0}} + CASE WHEN {{0}} < -{BOX / 2} THEN {BOX} WHEN {{0}} > {BOX / 2} THEN -{BOX} ELSE 0 END)"
_DELTAS = f"""WITH {_RECS}, ok AS (SELECT id, r.* FROM recs WHERE isfinite(r.x) AND isfinite(r.y) AND isfinite(r.z) AND isfinite(r.sr) AND isfinite(r.sm) AND r.sr > 0),
p AS (SELECT a.id, a.sr, a.sm, {_MI.format('(b.x - a.x)')} AS dx, {_MI.format('(b.y - a.y)')} AS dy, {_MI.format('(b.z - a.z)')} AS dz FROM ok a JOIN ok b ON b.id = a.d)"""

ORACLES = {
    "forest_scan": f"{_TREE} SELECT id, coalesce(dsc, -1) AS desc, snapnum, mass, root, idx, size, progenitor_count, round({_A.format(_STEP)}, 9) AS scale_factor FROM nodes JOIN sizes USING (id) JOIN cnt USING (id)",
    "forest_files": f"{_TREE} SELECT id, coalesce(dsc, -1) AS desc, snapnum, root, idx, size, depth FROM nodes JOIN sizes USING (id)",
    "forest_projection": f"{_TREE} SELECT id, coalesce(dsc, -1) AS desc, snapnum, size FROM nodes JOIN sizes USING (id)",
    "forest_z0_roots": f"{_TREE} SELECT id, root, idx FROM nodes WHERE root IN (SELECT id FROM nodes WHERE dsc IS NULL AND snapnum = {LAST})",
    "forest_chunks": f"{_TREE}, o AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k, count(*) OVER () AS n FROM nodes WHERE dsc IS NULL AND snapnum = {LAST}) SELECT least(k // greatest(1, n // 5), 4) AS chunk, nodes.id, root, idx FROM nodes JOIN o ON o.id = root",
    "forest_chunk": f"{_TREE}, o AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k, count(*) OVER () AS n FROM nodes WHERE dsc IS NULL AND snapnum = {LAST}) SELECT id, root, idx FROM nodes WHERE root IN (SELECT id FROM o WHERE least(k // greatest(1, n // 5), 4) = 1)",
    "subtree_targets": f"{_TREE}, a AS (SELECT id, idx, unnest(anc) AS target FROM nodes) SELECT a.target, a.id, a.idx - t.idx AS place FROM a JOIN nodes t ON t.id = a.target WHERE a.target IN (SELECT id FROM targets)",
    "subtree_slice": f"{_TREE}, a AS (SELECT snapnum, unnest(anc) AS target FROM nodes) SELECT target, count(*) AS n, min(snapnum) AS first_snap FROM a WHERE target IN (SELECT id FROM nodes WHERE snapnum = 50 AND mass > {LOW}) GROUP BY 1",
    "catalog_clean": f"WITH {_RECS} SELECT id, r.s AS snapnum, {_WRAP.format('r.x')} AS x, {_WRAP.format('r.y')} AS y, {_WRAP.format('r.z')} AS z FROM recs WHERE isfinite(r.m) AND isfinite(r.x) AND isfinite(r.y) AND isfinite(r.z) AND isfinite(r.sr)",
    "quality_metrics": "SELECT CAST(snapnum AS INT) AS snapnum, count(*) AS n_rows, count(*) FILTER (NOT coalesce(isfinite(tree_node_mass), false)) AS bad_mass, count(*) FILTER (NOT coalesce(isfinite(sod_halo_radius), false)) AS bad_radius, max(loaded_at) AS last_load FROM forest GROUP BY 1",
    "scale_factor": f"{_STEPS} SELECT id, snapnum, step, round(a, 9) AS scale_factor FROM st",
    "redshift": f"{_STEPS} SELECT id, round(1 / a - 1, 9) AS redshift FROM st",
    "hubble": f"{_STEPS} SELECT id, round(100 * {_H} * sqrt({_OM} / (a * a * a) + {_OL}), 6) AS hubble FROM st",
    "virial_overdensity": f"{_STEPS} SELECT id, round(18 * pi() * pi() + 82 * x - 39 * x * x, 6) AS overdensity FROM (SELECT id, {_OM} / (a * a * a) / ({_OM} / (a * a * a) + {_OL}) - 1 AS x FROM st)",
    "lookback": f"{_CAT}, {_BACK} SELECT id, snapnum, step, round(lookback, 9) AS lookback FROM cat JOIN back USING (snapnum)",
    "hubble_fraction": f"{_CAT}, {_BACK} SELECT c.id, round(b.lookback / {SIM.cosmo.hubble_time()!r}::DOUBLE, 9) AS fraction, round(b.lookback - n.lookback, 9) AS until_next FROM cat c JOIN back b USING (snapnum) LEFT JOIN back n ON n.snapnum = c.snapnum + 1",
    "particle_count": f"{_CAT} SELECT id, round(mass / {SIM.particle_mass()!r}::DOUBLE, 6) AS n_particles FROM cat",
    "merger_rate": f"{_MERGE}, {_BACK} SELECT g.snapnum, round(g.p / (q.lookback - b.lookback), 9) AS rate FROM (SELECT snapnum, count(*) FILTER (ratio > 0.1) / count(*) AS p FROM mrg GROUP BY 1) g JOIN back b USING (snapnum) JOIN back q ON q.snapnum = g.snapnum - 1",
    "submass": f"{_SUBMASS} SELECT branch, snapnum, round(mass, -3) AS mass FROM subs",
    "fsub_stats": f"{_SUBMASS} SELECT n.id, round(coalesce(x.t / n.mass, 0), 6) AS fsubtot, round(coalesce(x.m / n.mass, 0), 6) AS fsubmax FROM nodes n LEFT JOIN (SELECT h.host AS id, sum(s.mass) AS t, max(s.mass) AS m FROM subs s JOIN host h USING (branch, snapnum) GROUP BY 1) x USING (id)",
    "sub_index": f"{_SUB}, c AS (SELECT host AS id, count(*) AS n FROM host GROUP BY 1) SELECT id, root, CAST(coalesce(sum(coalesce(n, 0)) OVER (PARTITION BY root ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS sub_offset, coalesce(n, 0) AS sub_size FROM nodes LEFT JOIN c USING (id)",
    "sub_order": f"{_SUB} SELECT branch, snapnum, host, row_number() OVER (PARTITION BY host ORDER BY branch) - 1 AS place FROM host",
    "fragment_split": f"WITH {_RECS} SELECT id, CASE WHEN r.g < 0 THEN (-r.g) & 281474976710655 ELSE r.g END AS tag, CASE WHEN r.g < 0 THEN (-r.g) >> 48 ELSE 0 END AS fragment FROM recs WHERE r.g IS NOT NULL",
    "xoff": f"{_DELTAS} SELECT id, round(CASE WHEN sm > 0 THEN sqrt(dx * dx + dy * dy + dz * dz) / sr ELSE -101 END, 3) AS xoff, round(dx, 5) AS dx FROM p",
    "min_image": f"{_DELTAS} SELECT id, round(dx, 5) AS dx, round(dy, 5) AS dy, round(dz, 5) AS dz FROM p",
    "copy_rename": f"WITH {_RECS} SELECT id, r.g AS tag, r.g AS tag_copy, r.s AS snapshot FROM recs",
    "mass_bin_targets": f"{_TREE} SELECT id FROM targets",
    "descendant_join": f"{_CAT} SELECT id, coalesce(dsc, -1) AS desc FROM hal",
    "orphans_anti": f"{_CAT} SELECT c.id, c.dsc AS desc, c.snapnum FROM cat c JOIN hal h USING (id) WHERE c.dsc >= 0 AND h.dsc IS NULL",
    "orphans_to_roots": f"{_CAT} SELECT snapnum, count(*) AS n, count(*) FILTER (dsc IS NULL) AS n_roots FROM hal GROUP BY 1",
    "descendant_idx": f"{_TREE} SELECT n.id, n.root, n.idx, coalesce(p.idx, -1) AS descendant_idx FROM nodes n LEFT JOIN nodes p ON p.id = n.dsc",
    "progenitor_csr": f"{_TREE} SELECT dsc AS id, row_number() OVER (PARTITION BY dsc ORDER BY idx) - 1 AS place, idx AS progenitor FROM nodes WHERE dsc IS NOT NULL",
    "csr_offsets": f"{_TREE} SELECT id, progenitor_count, CAST(coalesce(sum(progenitor_count) OVER (PARTITION BY root ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS progenitor_offset FROM nodes JOIN cnt USING (id)",
    "progenitor_count": f"{_TREE} SELECT id, progenitor_count FROM cnt",
    "branch_size": f"{_TREE} SELECT id, size AS branch_size FROM sizes",
    "dfs_order": f"{_TREE} SELECT id, root, idx FROM nodes",
    "root_label": f"{_TREE} SELECT id, root, depth FROM nodes",
    "branch_ids": f"{_TREE} SELECT n.id, n.branch, CAST(h.snapnum - n.snapnum AS BIGINT) AS d FROM nodes n JOIN nodes h ON h.id = n.branch",
    "mainbranch": f"{_TREE} SELECT target, snapnum, id FROM main",
    "mainbranch_mass": f"{_TREE} SELECT target, snapnum, mass FROM main",
    "mean_mass_growth": f"{_TREE} SELECT m.snapnum, round(sum(m.mass / t.mass) / (SELECT count(*) FROM targets), 9) AS mean_growth FROM main m JOIN nodes t ON t.id = m.target GROUP BY 1",
    "nth_progenitor": f"{_MERGE}, s2 AS (SELECT dsc, id, row_number() OVER (PARTITION BY dsc ORDER BY mass DESC, id) AS k FROM nodes WHERE dsc IS NOT NULL) SELECT a.dsc AS id, a.id AS p2, coalesce(b.id, -1) AS p3 FROM s2 a LEFT JOIN s2 b ON b.dsc = a.dsc AND b.k = 3 WHERE a.k = 2",
    "merger_probability": f"{_MERGE} SELECT snapnum, count(*) AS n, round(count(*) FILTER (ratio > 0.1) / count(*), 9) AS p0, round(count(*) FILTER (ratio > 0.3) / count(*), 9) AS p1 FROM mrg GROUP BY 1",
    "last_major_merger": f"{_MERGE} SELECT t.id AS target, coalesce(max(m.snapnum) FILTER (ratio > 0.3), -1) AS snapnum FROM targets t LEFT JOIN mrg m ON m.target = t.id GROUP BY 1",
    "most_massive": f"{_TREE} SELECT snapnum, id, mass FROM (SELECT *, row_number() OVER (PARTITION BY snapnum ORDER BY mass DESC, id) AS k FROM nodes) WHERE k = 1",
    "infall_hist": f"""{_TREE}, inf AS (SELECT n.mass FROM nodes n JOIN nodes p ON p.id = n.dsc JOIN targets t ON t.id = p.branch WHERE n.branch = n.id),
b AS (SELECT floor((log10(mass) - 10) / (3 / 20.0::DOUBLE)) AS bin FROM inf) SELECT CAST(s.k AS INT) AS bin, count(b.bin) AS n FROM (SELECT unnest(range(20)) AS k) s LEFT JOIN b ON b.bin = s.k GROUP BY 1""",
    "mass_prune": f"{_PRUNED} SELECT id, root FROM kept",
    "mass_prune_size": f"{_PRUNED} SELECT a AS id, count(*) AS size FROM (SELECT unnest(anc) AS a FROM kept) GROUP BY 1",
    "forest_above_mass": f"{_PRUNED}, z AS (SELECT a AS id, count(*) AS size FROM (SELECT unnest(anc) AS a FROM kept) GROUP BY 1) SELECT id, root, row_number() OVER (PARTITION BY root ORDER BY idx) - 1 AS idx, size FROM kept JOIN z USING (id)",
    "adjacency_coo": f"{_TREE}, a AS (SELECT id, dsc, idx, mass, unnest(anc) AS target FROM nodes), b AS (SELECT a.*, a.idx - t.idx AS place FROM a JOIN nodes t ON t.id = a.target WHERE a.target IN (SELECT id FROM targets)) SELECT x.target, x.place AS i, y.place AS j, x.mass FROM b x JOIN b y ON y.target = x.target AND y.id = x.dsc",
    "tree_extract": f"{_PRUNED}, a AS (SELECT id, mass, depth, unnest(anc) AS target FROM kept) SELECT a.target, a.id, CAST(a.depth - t.depth AS INT) AS step, a.mass FROM a JOIN nodes t ON t.id = a.target WHERE a.target IN (SELECT id FROM targets) AND a.depth - t.depth <= 20",
    "root_order": f"{_TREE} SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM nodes WHERE dsc IS NULL AND snapnum = {LAST}",
    "sibling_order": f"{_TREE} SELECT id, dsc AS desc, row_number() OVER (PARTITION BY dsc ORDER BY mass DESC, id) - 1 AS place FROM nodes WHERE dsc IS NOT NULL",
    "fragfix_const": f"{_FRAG} SELECT id, last_value(CASE WHEN good THEN mass END IGNORE NULLS) OVER w AS mass_fragfix, last_value(CASE WHEN good THEN sc END IGNORE NULLS) OVER w AS sod_halo_cdelta_fragfix FROM f2 WINDOW w AS (PARTITION BY branch ORDER BY snapnum DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "fragfix_linear": f"""{_FRAG}, f3 AS (SELECT *, last_value(CASE WHEN good THEN sc END IGNORE NULLS) OVER w AS a, last_value(CASE WHEN good THEN snapnum END IGNORE NULLS) OVER w AS sa,
  first_value(CASE WHEN good THEN sc END IGNORE NULLS) OVER v AS b, first_value(CASE WHEN good THEN snapnum END IGNORE NULLS) OVER v AS sb FROM f2
  WINDOW w AS (PARTITION BY branch ORDER BY snapnum DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), v AS (PARTITION BY branch ORDER BY snapnum DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT id, round(CASE WHEN good OR sb IS NULL THEN sc WHEN least(a, b) < 0 THEN least(a, b) ELSE a + (b - a) * (sa - snapnum) / (sa - sb) END, 6) AS sod_halo_cdelta_fragfix FROM f3""",
    "branch_matrix": f"{_TREE}, h AS (SELECT id AS branch, unnest(range({LAST + 1})) AS s FROM nodes WHERE branch = id AND mass > 3e11) SELECT h.branch, CAST(h.s AS INT) AS snapnum, coalesce(n.id, 0) AS id, coalesce(n.mass, 0) AS mass FROM h LEFT JOIN nodes n ON n.branch = h.branch AND n.snapnum = h.s",
    "branch_hosts": f"{_TREE}, h AS (SELECT id AS branch, unnest(anc[1:-2]) AS host FROM nodes WHERE branch = id AND dsc IS NOT NULL) SELECT h.branch, n.snapnum, h.host, n.branch AS host_branch FROM h JOIN nodes n ON n.id = h.host",
    "sub_rows": f"{_SUB} SELECT branch, count(*) AS n_rows FROM host GROUP BY 1",
    "sub_hosts": f"{_SUB} SELECT branch, snapnum, host, pbranch AS direct_branch, CASE WHEN snapnum <= phead THEN host END AS direct_host FROM host",
    "sub_offsets": f"{_SUB} SELECT host, count(*) AS n_subs FROM host GROUP BY 1",
}
