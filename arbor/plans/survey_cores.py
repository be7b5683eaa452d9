"""Queries of the reference's operators over coreproperties and lightcone_halos, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import wrap_once
from ..functions.tags import unique_id
from ..operators import cores as co
from ..operators import lightcone as lc
from ..operators.prefix import exclusive_sum
from ..operators.records import keyed
from ..sources.sinks import write_cores, write_lightcone
from ..sources.tables import read_files, read_table, table_stamp
from .cut import cut, fresh

BOX, LAST, AT, GRID = 512.0, 100, 90, 10752


#: Columns of cores that are written with them on the lightcone and not used otherwise.
INFALL = tuple(f"infall_fof_halo_center_{c}" for c in "xyz")


def cores(spark, folder, more: tuple[str, ...] = ()) -> DataFrame:
    rows = keyed(read_table(spark, folder, "coreproperties"), ["core_tag", "snapnum"], ["host_core", "central", "merged", "fof_halo_tag", "x", "y", "z", *more])
    return rows.select("core_tag", F.col("snapnum").cast("int").alias("snapnum"), "host_core", "central", "merged", "fof_halo_tag", *(F.col(c).cast("double").alias(c) for c in ("x", "y", "z", *more)))


def _fine(rows: DataFrame) -> DataFrame:
    return rows.where(" and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in "xyz"))


def core_scan(spark, folder):
    return _fine(cores(spark, folder)).select("core_tag", "snapnum", *(F.round(wrap_once(F.col(c), BOX), 6).alias(c) for c in "xyz"))


def core_host(spark, folder):
    return co.host_links(cores(spark, folder)).select("core_tag", "snapnum", F.coalesce("host", F.lit(-1)).alias("host"))


_tops_of: dict[tuple, DataFrame] = {}


def _tops(spark, folder) -> DataFrame:
    """The hosts of all cores, found once per application and state of the files, and kept in the shared folder."""
    key = (spark.sparkContext.applicationId, folder, table_stamp(spark, folder, "coreproperties"))
    if key not in _tops_of:
        _tops_of[key] = cut(co.top_hosts(cores(spark, folder)), "tops")
    return _tops_of[key]


def core_top_host(spark, folder):
    return _tops(spark, folder).select("core_tag", "snapnum", F.coalesce("top", F.lit(-1)).alias("top"))


def core_secondary_host(spark, folder):
    return _tops(spark, folder).select("core_tag", "snapnum", F.coalesce("second", F.lit(-1)).alias("second"))


def core_group_count(spark, folder):
    return _tops(spark, folder).where("top is not null").select("core_tag", "snapnum", F.col("n_descendants").alias("n_below"))


def core_group_order(spark, folder):
    """The place of each core in its group: depth first, a core before those that it hosts, these by tag."""
    return co.group_order(_tops(spark, folder)).select("core_tag", "snapnum", "top", "place")


def core_host_tags(spark, folder):
    t = _tops(spark, folder)
    of = cores(spark, folder).select("snapnum", F.col("core_tag").alias("top"), F.col("fof_halo_tag").alias("top_fof"))
    return t.join(of, ["snapnum", "top"], "left").select("core_tag", "snapnum", F.coalesce("top_fof", F.lit(-1)).alias("top_fof"))


def core_state(spark, folder):
    return cores(spark, folder).select("core_tag", "snapnum", co.state(F.col("merged"), F.col("central"), F.col("core_tag")).alias("state"))


def core_matrix(spark, folder):
    final = cores(spark, folder).where(F.col("snapnum") == LAST).select("core_tag")
    return co.core_matrix(cores(spark, folder).join(final, "core_tag", "left_semi"), LAST)


def core_matrix_chunks(spark, folder, n_chunks: int = 4):
    """The matrix of all fields with rows of hosts, in chunks of the cores that the last snapshot has."""
    rows = co.core_matrix_rows(cores(spark, folder), LAST, n_chunks, ["host_core", "central", "merged", "fof_halo_tag"])
    return rows.select("chunk", "row", "core_tag", "snapnum", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("host_core", "central", "merged", "fof_halo_tag")), "state", F.coalesce("host_row", F.lit(-1)).alias("host_row"))


def core_rows(spark, folder):
    return cores(spark, folder).groupBy("core_tag").agg(F.count("*").alias("n_rows"), F.min("snapnum").alias("first_snap"), F.max("snapnum").alias("last_snap"))


def core_lengths(spark, folder):
    return co.core_forest(cores(spark, folder), LAST).groupBy("core_tag").agg(F.count("*").alias("length"))


def core_positions(spark, folder):
    return co.core_forest(cores(spark, folder), LAST)


def core_forest(spark, folder):
    rows = co.core_forest(cores(spark, folder), LAST).join(co.host_links(cores(spark, folder)), co.KEY)
    return rows.select("core_tag", "snapnum", "place", F.coalesce("host", F.lit(-1)).alias("host"), F.coalesce("central", F.lit(0)).alias("central"))


def core_files(spark, folder):
    """The core forest written to files, all snapshots of a core in one, and read again."""
    path, rows = fresh(spark, "files"), co.core_forest(cores(spark, folder), LAST)
    write_cores(rows, path, 4)
    return spark.read.parquet(path).select("core_tag", "snapnum", "place")


def core_orphans(spark, folder):
    return co.orphan_cores(cores(spark, folder), LAST)


def core_root_order(spark, folder):
    """Centrals first, then by tag, within each FoF group of the last snapshot."""
    rows = cores(spark, folder).where((F.col("snapnum") == LAST) & F.col("fof_halo_tag").isNotNull())
    rows = rows.select("fof_halo_tag", "core_tag", (F.coalesce("central", F.lit(0)) != 1).alias("satellite"))
    return exclusive_sum(rows, ["fof_halo_tag"], [F.col("satellite"), F.shiftright("core_tag", 12)], [F.col("core_tag")], F.lit(1), "place").drop("satellite")


def satellite_to_central(spark, folder):
    return co.satellites_of_centrals(cores(spark, folder))


def core_union(spark, folder):
    """Satellites and centrals of all files of cores, per snapshot."""
    rows = keyed(read_files(spark, [f"{folder.rstrip('/')}/coreproperties.parquet"]), ["core_tag", "snapnum"], ["central"])
    parts = rows.select(F.col("snapnum").cast("int").alias("snapnum"), F.when(F.col("central") == 1, "central").otherwise("satellite").alias("part"))
    return parts.groupBy("snapnum", "part").agg(F.count("*").alias("n"))


def _halos(spark, folder) -> DataFrame:
    return lc.deduped(lc.clean_halos(read_table(spark, folder, "lightcone_halos")))


def _good(spark, folder) -> DataFrame:
    return lc.consistent(_halos(spark, folder))


def lc_halos(spark, folder):
    return lc.clean_halos(read_table(spark, folder, "lightcone_halos")).groupBy("tag", "fragment").agg(F.count("*").alias("n"))


def unique_ids(spark, folder):
    return _halos(spark, folder).select("replication", "tag", unique_id(F.col("replication"), F.col("tag")).alias("unique_id"))


def lc_dedupe(spark, folder):
    return _halos(spark, folder).select("replication", "tag", "fragment", *(F.col(c).cast("double").alias(c) for c in ("a", "x", "y", "z")))


def lc_fragment_consistency(spark, folder):
    return _good(spark, folder).select("replication", "tag", "fragment")


def lc_replications(spark, folder):
    return lc.replications(_good(spark, folder))


def lc_step_map(spark, folder):
    """The snapshot whose cores a lightcone step takes, and how many these are: the next one; the last step has none."""
    rows = read_table(spark, folder, "sim_snapshots").select(F.col("snapnum").cast("int").alias("snapnum"), "step")
    more = rows.select((F.col("snapnum") - 1).alias("snapnum")).join(rows, "snapnum").select("step", (F.col("snapnum") + 1).alias("target_snap"))
    n = cores(spark, folder).groupBy(F.col("snapnum").alias("target_snap")).agg(F.count("*").alias("n_cores"))
    return more.join(n, "target_snap", "left").select("step", "target_snap", F.coalesce("n_cores", F.lit(0)).alias("n_cores"))


def _at(spark, folder) -> DataFrame:
    return _fine(lc.cores_at(cores(spark, folder), AT, GRID))


def lc_cores_at_step(spark, folder):
    return _at(spark, folder).select("core_tag", "tag")


def lagrangian(spark, folder):
    return _at(spark, folder).select("core_tag", *(F.round(c, 9).alias(c) for c in ("qx", "qy", "qz")))


def lc_semi(spark, folder):
    return _at(spark, folder).join(_good(spark, folder), "tag", "left_semi").select("core_tag")


def lc_match(spark, folder):
    return lc.matched(_at(spark, folder), _good(spark, folder)).select("core_tag", "halo_signed")


def _hosted(spark, folder) -> DataFrame:
    return lc.with_host_core(lc.matched(_at(spark, folder), _good(spark, folder)))


def lc_host_core(spark, folder):
    return _hosted(spark, folder).select("core_tag", "halo_core")


def min_image(spark, folder):
    return lc.offsets(_hosted(spark, folder), BOX).select("core_tag", *(F.round(f"d{c}", 5).alias(f"d{c}") for c in "xyz"))


def _replicated(spark, folder) -> DataFrame:
    return lc.replicated(lc.offsets(_hosted(spark, folder), BOX), _good(spark, folder))


def lc_replicate(spark, folder):
    return _replicated(spark, folder).select("core_tag", "replication", "own_fragment", *(F.round(f"p{c}", 4).alias(f"p{c}") for c in "xyz"))


def lc_angles(spark, folder):
    return lc.angles(_replicated(spark, folder)).select("core_tag", "replication", *(F.round(c, 6).alias(c) for c in ("theta", "phi", "host_theta", "host_phi")))


def lc_output(spark, folder):
    """Cores on the lightcone under the names that they are written with."""
    rows = lc.angles(_replicated(spark, folder))
    halo = {"hx": "lc_halo_x", "hy": "lc_halo_y", "hz": "lc_halo_z", "host_theta": "lc_halo_theta", "host_phi": "lc_halo_phi"}
    return rows.select("core_tag", "replication", F.lit(AT).alias("snapnum"), F.col("tag").alias("lc_halo_foftag"), *(F.round(c, 6).alias(n) for c, n in halo.items()), *(F.round(c, 6).alias(c) for c in ("theta", "phi")))


def lc_host_idx(spark, folder):
    tops = co.top_hosts(cores(spark, folder).where(F.col("snapnum") == AT))
    return lc.host_rows(_replicated(spark, folder), tops, levels=("top",)).select("core_tag", "replication", F.when(F.col("top_there"), F.col("top")).otherwise(F.lit(-1)).alias("top"))


def lc_pipeline(spark, folder):
    out = lc.pipeline(_fine(cores(spark, folder)), read_table(spark, folder, "lightcone_halos"), AT, BOX, GRID)
    return out.groupBy("replication").agg(F.count("*").alias("n_cores"), F.countDistinct("tag").alias("n_halos"), F.sum(F.col("own_fragment").cast("long")).alias("n_own"))


def _of_steps(spark, folder, more: tuple[str, ...] = ()) -> DataFrame:
    return lc.pipeline_of_steps(_fine(cores(spark, folder, more)), read_table(spark, folder, "lightcone_halos"), read_table(spark, folder, "sim_snapshots"), BOX, GRID, more)


def lc_steps_pipeline(spark, folder):
    """Cores on the lightcone at all its steps, each step's halos with the cores of the snapshot after it."""
    rows = _of_steps(spark, folder)
    return rows.select("step", "snapnum", "core_tag", "replication", "tag", "halo_core", "own_fragment", *(F.round(f"p{c}", 4).alias(f"p{c}") for c in "xyz"), *(F.round(c, 6).alias(c) for c in ("theta", "phi", "host_theta", "host_phi")))


def lc_extents(spark, folder):
    """The extent of each cell of the sky that a written lightcone of all steps has, step by step."""
    path = fresh(spark, "lightcone")
    write_lightcone(_of_steps(spark, folder), path)
    rows = spark.read.parquet(f"{path}/extent")
    angles = [f"{m}_host_{c}" for c in ("theta", "phi") for m in ("min", "max")]
    return rows.select("step", "cell", *(F.round(c, 6).alias(c) for c in angles), "n_cores")


def lc_steps_output(spark, folder):
    """The same with all fields that are written, both hosts among them."""
    rows = lc.output(_of_steps(spark, folder, INFALL), cores(spark, folder), lc.SHELL, INFALL)
    rounded = {c: 4 for c in "xyz"} | dict.fromkeys(("theta", "phi", "scale_factor", *(f"lc_halo_{c}" for c in ("x", "y", "z", "theta", "phi")), *INFALL), 6)
    return rows.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in rounded.items()})


QUERIES = {f.__name__: f for f in (core_scan, core_host, core_top_host, core_secondary_host, core_group_count, core_group_order, core_host_tags, core_state, core_matrix, core_matrix_chunks, core_rows, core_lengths, core_positions, core_forest, core_files, core_orphans, core_root_order, satellite_to_central, core_union, lc_halos, lc_dedupe, lc_fragment_consistency, lc_replications, lc_step_map, lc_cores_at_step, lagrangian, lc_semi, lc_match, lc_host_core, lc_replicate, lc_angles, lc_output, lc_host_idx, lc_pipeline, lc_steps_pipeline, lc_steps_output, lc_extents)} | {"unique_id": unique_ids, "lc_offsets": min_image}

_OK = "isfinite(x) AND isfinite(y) AND isfinite(z)"
_CORES = """WITH RECURSIVE raw AS (SELECT core_tag, CAST(snapnum AS INT) AS snapnum, max(struct_pack(t := loaded_at, h := host_core, c := central, m := merged, g := fof_halo_tag, x := CAST(x AS DOUBLE), y := CAST(y AS DOUBLE), z := CAST(z AS DOUBLE))) AS r
  FROM coreproperties WHERE core_tag IS NOT NULL AND snapnum IS NOT NULL GROUP BY 1, 2),
c AS MATERIALIZED (SELECT core_tag, snapnum, r.h AS host_core, r.c AS central, r.m AS merged, r.g AS fof_halo_tag, r.x AS x, r.y AS y, r.z AS z FROM raw)"""
_LINK = f"""{_CORES}, ln AS MATERIALIZED (SELECT a.core_tag, a.snapnum, a.central, a.fof_halo_tag, CASE WHEN b.core_tag IS NOT NULL THEN b.core_tag END AS host
  FROM c a LEFT JOIN c b ON b.snapnum = a.snapnum AND b.core_tag = CASE WHEN coalesce(a.central, 0) = 1 THEN a.core_tag WHEN a.host_core > 0 THEN a.host_core END)"""
_TOP = f"""{_LINK}, tr AS (SELECT core_tag, snapnum, [core_tag] AS path FROM ln WHERE host IS NULL OR host = core_tag
  UNION ALL SELECT l.core_tag, l.snapnum, list_append(t.path, l.core_tag) FROM ln l JOIN tr t ON t.snapnum = l.snapnum AND t.core_tag = l.host WHERE l.host <> l.core_tag)"""
_RUN = f"""{_CORES}, rn AS (SELECT core_tag, snapnum, row_number() OVER (PARTITION BY core_tag ORDER BY snapnum DESC) - 1 AS place FROM c WHERE core_tag IN (SELECT core_tag FROM c WHERE snapnum = {LAST})),
run AS (SELECT * FROM rn WHERE snapnum = {LAST} - place)"""
_HALOS = f"""hc AS (SELECT *, CASE WHEN id < 0 THEN (-id) & 281474976710655 ELSE id END AS tag, CASE WHEN id < 0 THEN (-id) >> 48 ELSE 0 END AS fragment FROM lightcone_halos WHERE id IS NOT NULL AND replication IS NOT NULL AND {_OK}),
hd AS MATERIALIZED (SELECT replication, tag, r.* FROM (SELECT replication, tag, min(struct_pack(a := a, x := x, y := y, z := z, fragment := fragment, id := id)) AS r FROM hc GROUP BY 1, 2)),
hf AS (SELECT tag, min(struct_pack(k := replication, fragment := fragment)).fragment AS fragment FROM hd GROUP BY 1),
hg AS MATERIALIZED (SELECT hd.* FROM hd JOIN hf USING (tag, fragment))"""
_LC = f"""{_CORES}, {_HALOS},
att AS MATERIALIZED (SELECT core_tag, CASE WHEN fof_halo_tag < 0 THEN (-fof_halo_tag) & 281474976710655 ELSE fof_halo_tag END AS tag, fof_halo_tag AS signed, central, x, y, z FROM c WHERE snapnum = {AT} AND core_tag > 0 AND fof_halo_tag IS NOT NULL AND {_OK}),
mt AS MATERIALIZED (SELECT att.*, f.h.id AS halo_signed FROM att JOIN (SELECT tag, min(struct_pack(k := replication, id := id)) AS h FROM hg GROUP BY 1) f USING (tag)),
hs AS (SELECT signed AS halo_signed, core_tag AS halo_core, x AS hx, y AS hy, z AS hz FROM (SELECT *, row_number() OVER (PARTITION BY signed ORDER BY coalesce(central, 0) = 1 DESC, core_tag) AS k FROM mt) WHERE k = 1),
ho AS MATERIALIZED (SELECT * FROM mt JOIN hs USING (halo_signed))"""
_MI = f"({{0}} + CASE WHEN {{0}} < -{BOX / 2} THEN {BOX} WHEN {{0}} > {BOX / 2} THEN -{BOX} ELSE 0 END)"
_OFF = f"""{_LC}, df AS (SELECT *, {_MI.format('(x - hx)')} AS dx, {_MI.format('(y - hy)')} AS dy, {_MI.format('(z - hz)')} AS dz FROM ho),
ok AS MATERIALIZED (SELECT * FROM df WHERE abs(dx) <= 20 AND abs(dy) <= 20 AND abs(dz) <= 20),
rep AS MATERIALIZED (SELECT o.core_tag, h.replication, o.tag, o.halo_core, CAST(h.x AS DOUBLE) + o.dx AS px, CAST(h.y AS DOUBLE) + o.dy AS py, CAST(h.z AS DOUBLE) + o.dz AS pz, CAST(h.x AS DOUBLE) AS hx, CAST(h.y AS DOUBLE) AS hy, CAST(h.z AS DOUBLE) AS hz, o.signed = h.id AS own_fragment FROM ok o JOIN hg h USING (tag))"""
_ANG = "round(acos({2} / sqrt({0} * {0} + {1} * {1} + {2} * {2})), 6) AS {3}theta, round((atan2({1}, {0}) + pi()) % (2 * pi()), 6) AS {3}phi"
#: The same for all steps at once, with the snapshot in every key.
_STEPS = f"""stp AS (SELECT s.step, CAST(s.snapnum + 1 AS INT) AS snapnum, s.scale_factor AS a_from, n.scale_factor AS a_to FROM sim_snapshots s JOIN sim_snapshots n ON n.snapnum = s.snapnum + 1),
hc AS (SELECT stp.snapnum, h.*, CASE WHEN id < 0 THEN (-id) & 281474976710655 ELSE id END AS tag, CASE WHEN id < 0 THEN (-id) >> 48 ELSE 0 END AS fragment
  FROM lightcone_halos h JOIN stp ON CAST(a AS DOUBLE) >= a_from AND CAST(a AS DOUBLE) < a_to WHERE id IS NOT NULL AND replication IS NOT NULL AND {_OK}),
hd AS MATERIALIZED (SELECT snapnum, replication, tag, r.* FROM (SELECT snapnum, replication, tag, min(struct_pack(a := a, x := x, y := y, z := z, fragment := fragment, id := id)) AS r FROM hc GROUP BY 1, 2, 3)),
hf AS (SELECT snapnum, tag, min(struct_pack(k := replication, fragment := fragment)).fragment AS fragment FROM hd GROUP BY 1, 2),
hg AS MATERIALIZED (SELECT hd.* FROM hd JOIN hf USING (snapnum, tag, fragment)),
mt AS MATERIALIZED (SELECT c.*, f.tag, c.fof_halo_tag AS signed, f.h.id AS halo_signed FROM c JOIN (SELECT snapnum, tag, min(struct_pack(k := replication, id := id)) AS h FROM hg GROUP BY 1, 2) f
  ON f.snapnum = c.snapnum AND f.tag = CASE WHEN fof_halo_tag < 0 THEN (-fof_halo_tag) & 281474976710655 ELSE fof_halo_tag END WHERE core_tag > 0 AND {_OK}),
hs AS (SELECT snapnum, signed AS halo_signed, core_tag AS halo_core, x AS hx, y AS hy, z AS hz FROM (SELECT *, row_number() OVER (PARTITION BY snapnum, signed ORDER BY coalesce(central, 0) = 1 DESC, core_tag) AS k FROM mt) WHERE k = 1),
df AS (SELECT *, {_MI.format('(x - hx)')} AS dx, {_MI.format('(y - hy)')} AS dy, {_MI.format('(z - hz)')} AS dz FROM mt JOIN hs USING (snapnum, halo_signed)),
rep AS MATERIALIZED (SELECT o.* EXCLUDE (x, y, z, hx, hy, hz), step, h.replication, h.a, h.id, CAST(h.x AS DOUBLE) + dx AS px, CAST(h.y AS DOUBLE) + dy AS py, CAST(h.z AS DOUBLE) + dz AS pz, CAST(h.x AS DOUBLE) AS hx, CAST(h.y AS DOUBLE) AS hy, CAST(h.z AS DOUBLE) AS hz
  FROM df o JOIN hg h USING (snapnum, tag) JOIN stp USING (snapnum) WHERE abs(dx) <= 20 AND abs(dy) <= 20 AND abs(dz) <= 20)"""
_STEPS_TOP = _TOP.replace("z := CAST(z AS DOUBLE)", "z := CAST(z AS DOUBLE), " + ", ".join(f"{c} := CAST({c} AS DOUBLE)" for c in INFALL)).replace("r.z AS z", "r.z AS z, " + ", ".join(f"r.{c} AS {c}" for c in INFALL))

ORACLES = {
    "core_scan": f"{_CORES} SELECT core_tag, snapnum, round((x + {BOX}) % {BOX}, 6) AS x, round((y + {BOX}) % {BOX}, 6) AS y, round((z + {BOX}) % {BOX}, 6) AS z FROM c WHERE {_OK}",
    "core_host": f"{_LINK} SELECT core_tag, snapnum, coalesce(host, -1) AS host FROM ln",
    "core_top_host": f"{_TOP} SELECT c.core_tag, c.snapnum, coalesce(path[1], -1) AS top FROM c LEFT JOIN tr USING (core_tag, snapnum)",
    "core_secondary_host": f"{_TOP} SELECT c.core_tag, c.snapnum, CASE WHEN len(path) >= 3 THEN path[2] ELSE -1 END AS second FROM c LEFT JOIN tr USING (core_tag, snapnum)",
    "core_group_count": f"{_TOP} SELECT core_tag, snapnum, coalesce(n, 0) AS n_below FROM tr LEFT JOIN (SELECT snapnum, core_tag, count(*) AS n FROM (SELECT snapnum, unnest(path[1:-2]) AS core_tag FROM tr) GROUP BY 1, 2) USING (core_tag, snapnum)",
    "core_group_order": f"{_TOP} SELECT core_tag, snapnum, path[1] AS top, row_number() OVER (PARTITION BY snapnum, path[1] ORDER BY path) - 1 AS place FROM tr",
    "core_matrix_chunks": f"""{_LINK}, f AS (SELECT core_tag, row_number() OVER (ORDER BY core_tag) - 1 AS row, count(*) OVER () AS n FROM c WHERE snapnum = {LAST}),
g AS (SELECT *, least(row // greatest(1, n // 4), 3) AS chunk FROM f), s AS (SELECT core_tag, row, chunk, CAST(unnest(range({LAST + 1})) AS INT) AS snapnum FROM g)
SELECT s.chunk, s.row, s.core_tag, s.snapnum, coalesce(ln.host, c.host_core, -1) AS host_core, coalesce(c.central, -1) AS central, coalesce(c.merged, -1) AS merged, coalesce(c.fof_halo_tag, -1) AS fof_halo_tag,
  CAST(CASE WHEN c.merged = 1 THEN 2 WHEN c.central = 1 THEN 0 WHEN c.core_tag > 0 THEN 1 ELSE -1 END AS INT) AS state, coalesce(h.row, -1) AS host_row
FROM s LEFT JOIN c USING (core_tag, snapnum) LEFT JOIN ln USING (core_tag, snapnum) LEFT JOIN g h ON h.core_tag = ln.host AND h.chunk = s.chunk""",
    "core_host_tags": f"{_TOP} SELECT c.core_tag, c.snapnum, coalesce(h.fof_halo_tag, -1) AS top_fof FROM c LEFT JOIN tr USING (core_tag, snapnum) LEFT JOIN c h ON h.snapnum = c.snapnum AND h.core_tag = tr.path[1]",
    "core_state": f"{_CORES} SELECT core_tag, snapnum, CAST(CASE WHEN merged = 1 THEN 2 WHEN central = 1 THEN 0 WHEN core_tag > 0 THEN 1 ELSE -1 END AS INT) AS state FROM c",
    "core_matrix": f"{_CORES}, f AS (SELECT core_tag FROM c WHERE snapnum = {LAST}) SELECT f.core_tag, CAST(s AS INT) AS snapnum, CAST(CASE WHEN merged = 1 THEN 2 WHEN central = 1 THEN 0 WHEN c.core_tag > 0 THEN 1 ELSE -1 END AS INT) AS state, CAST(c.core_tag IS NOT NULL AS INT) AS present FROM (SELECT core_tag, unnest(range({LAST + 1})) AS s FROM f) f LEFT JOIN c ON c.core_tag = f.core_tag AND c.snapnum = s",
    "core_rows": f"{_CORES} SELECT core_tag, count(*) AS n_rows, min(snapnum) AS first_snap, max(snapnum) AS last_snap FROM c GROUP BY 1",
    "core_lengths": f"{_RUN} SELECT core_tag, count(*) AS length FROM run GROUP BY 1",
    "core_positions": f"{_RUN} SELECT core_tag, snapnum, CAST(place AS INT) AS place FROM run",
    "core_files": f"{_RUN} SELECT core_tag, snapnum, CAST(place AS INT) AS place FROM run",
    "core_forest": f"{_LINK.replace('WITH RECURSIVE', 'WITH RECURSIVE', 1)}, {_RUN.removeprefix(_CORES).lstrip(', ')} SELECT core_tag, snapnum, CAST(place AS INT) AS place, coalesce(host, -1) AS host, coalesce(central, 0) AS central FROM run JOIN ln USING (core_tag, snapnum)",
    "core_orphans": f"{_CORES} SELECT core_tag, count(*) AS n_rows, max(snapnum) AS last_seen FROM c GROUP BY 1 HAVING max(snapnum) < {LAST}",
    "core_root_order": f"{_CORES} SELECT fof_halo_tag, core_tag, row_number() OVER (PARTITION BY fof_halo_tag ORDER BY coalesce(central, 0) <> 1, core_tag) - 1 AS place FROM c WHERE snapnum = {LAST} AND fof_halo_tag IS NOT NULL",
    "satellite_to_central": f"{_CORES} SELECT a.snapnum, a.core_tag, b.t AS central_tag FROM c a JOIN (SELECT snapnum, fof_halo_tag, min(core_tag) AS t FROM c WHERE central = 1 GROUP BY 1, 2) b USING (snapnum, fof_halo_tag) WHERE coalesce(a.central, 0) <> 1",
    "core_union": f"{_CORES} SELECT snapnum, CASE WHEN central = 1 THEN 'central' ELSE 'satellite' END AS part, count(*) AS n FROM c GROUP BY 1, 2",
    "lc_halos": f"WITH {_HALOS} SELECT tag, fragment, count(*) AS n FROM hc GROUP BY 1, 2",
    "unique_id": f"WITH {_HALOS} SELECT replication, tag, (CAST(replication AS BIGINT) << 41) + tag AS unique_id FROM hd",
    "lc_dedupe": f"WITH {_HALOS} SELECT replication, tag, fragment, CAST(a AS DOUBLE) AS a, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) AS z FROM hd",
    "lc_fragment_consistency": f"WITH {_HALOS} SELECT replication, tag, fragment FROM hg",
    "lc_replications": f"WITH {_HALOS} SELECT tag, count(*) AS n_replications FROM hg GROUP BY 1",
    "lc_step_map": f"{_CORES} SELECT s.step, CAST(s.snapnum + 1 AS INT) AS target_snap, count(c.core_tag) AS n_cores FROM sim_snapshots s LEFT JOIN c ON c.snapnum = s.snapnum + 1 WHERE s.snapnum < (SELECT max(snapnum) FROM sim_snapshots) GROUP BY 1, 2",
    "lc_cores_at_step": f"{_LC} SELECT core_tag, tag FROM att",
    "lagrangian": f"{_LC} SELECT core_tag, round((tag // ({GRID}::BIGINT * {GRID})) / {GRID}, 9) AS qx, round(((tag // {GRID}) % {GRID}) / {GRID}, 9) AS qy, round((tag % {GRID}) / {GRID}, 9) AS qz FROM att",
    "lc_semi": f"{_LC} SELECT core_tag FROM att WHERE tag IN (SELECT tag FROM hg)",
    "lc_match": f"{_LC} SELECT core_tag, halo_signed FROM mt",
    "lc_host_core": f"{_LC} SELECT core_tag, halo_core FROM ho",
    "lc_offsets": f"{_OFF} SELECT core_tag, round(dx, 5) AS dx, round(dy, 5) AS dy, round(dz, 5) AS dz FROM ok",
    "lc_replicate": f"{_OFF} SELECT core_tag, replication, own_fragment, round(px, 4) AS px, round(py, 4) AS py, round(pz, 4) AS pz FROM rep",
    "lc_angles": f"{_OFF} SELECT core_tag, replication, {_ANG.format('px', 'py', 'pz', '')}, {_ANG.format('hx', 'hy', 'hz', 'host_')} FROM rep",
    "lc_output": f"{_OFF} SELECT core_tag, replication, {AT} AS snapnum, tag AS lc_halo_foftag, round(hx, 6) AS lc_halo_x, round(hy, 6) AS lc_halo_y, round(hz, 6) AS lc_halo_z, {_ANG.format('px', 'py', 'pz', '')}, {_ANG.format('hx', 'hy', 'hz', 'lc_halo_')} FROM rep",
    "lc_host_idx": f"{_TOP}, {_OFF.removeprefix(_CORES).lstrip(', ')} SELECT r.core_tag, r.replication, coalesce(b.core_tag, -1) AS top FROM rep r LEFT JOIN tr ON tr.snapnum = {AT} AND tr.core_tag = r.core_tag LEFT JOIN rep b ON b.replication = r.replication AND b.core_tag = tr.path[1]",
    "lc_pipeline": f"{_OFF} SELECT replication, count(*) AS n_cores, count(DISTINCT tag) AS n_halos, count(*) FILTER (own_fragment) AS n_own FROM rep GROUP BY 1",
    "lc_steps_output": f"{_STEPS_TOP}, {_STEPS} SELECT r.step, r.snapnum, r.core_tag, r.replication, r.central, {_ANG.format('px', 'py', 'pz', '')}, round(px, 4) AS x, round(py, 4) AS y, round(pz, 4) AS z, r.signed AS fof_halo_tag, round(CAST(a AS DOUBLE), 6) AS scale_factor, round(hx, 6) AS lc_halo_x, round(hy, 6) AS lc_halo_y, round(hz, 6) AS lc_halo_z, {_ANG.format('hx', 'hy', 'hz', 'lc_halo_')}, r.tag AS lc_halo_foftag, r.id AS lc_fof_halo_tag, r.signed <> r.id AS lc_fof_halo_flag, coalesce(t.top, -1) AS top_host_tag, coalesce(t.second, -1) AS secondary_top_host_tag, CASE WHEN b1.k IS NULL THEN -1 ELSE t.top END AS top_host_idx, CASE WHEN b2.k IS NULL THEN -1 ELSE t.second END AS secondary_top_host_idx, {', '.join(f'round({c}, 6) AS {c}' for c in INFALL)} FROM rep r LEFT JOIN (SELECT snapnum AS s, core_tag AS k, path[1] AS top, CASE WHEN len(path) >= 3 THEN path[2] END AS second FROM tr) t ON t.s = r.snapnum AND t.k = r.core_tag LEFT JOIN (SELECT snapnum AS s, replication AS p, core_tag AS k FROM rep) b1 ON b1.s = r.snapnum AND b1.p = r.replication AND b1.k = t.top LEFT JOIN (SELECT snapnum AS s, replication AS p, core_tag AS k FROM rep) b2 ON b2.s = r.snapnum AND b2.p = r.replication AND b2.k = t.second",
    "lc_extents": f"{_CORES}, {_STEPS}, an AS (SELECT step, acos(hz / sqrt(hx * hx + hy * hy + hz * hz)) AS t, (atan2(hy, hx) + pi()) % (2 * pi()) AS p FROM rep) SELECT step, CAST(floor(p * 64 / (2 * pi())) * 64 + floor(t * 64 / pi()) AS INT) AS cell, round(min(t), 6) AS min_host_theta, round(max(t), 6) AS max_host_theta, round(min(p), 6) AS min_host_phi, round(max(p), 6) AS max_host_phi, count(*) AS n_cores FROM an GROUP BY 1, 2",
    "lc_steps_pipeline": f"{_CORES}, {_STEPS} SELECT step, snapnum, core_tag, replication, tag, halo_core, signed = id AS own_fragment, round(px, 4) AS px, round(py, 4) AS py, round(pz, 4) AS pz, {_ANG.format('px', 'py', 'pz', '')}, {_ANG.format('hx', 'hy', 'hz', 'host_')} FROM rep",
}
