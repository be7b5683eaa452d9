"""Cores on a lightcone of halos. Halos: id (signed FoF tag), replication, x, y, z, a; cores as in `cores`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import lagrangian, min_image, phi, theta
from ..functions.tags import fragment_index, parent_tag
from ..plans.cut import cut
from .cores import top_hosts

#: Fixed value: farthest offset per axis, in Mpc/h, at which a core still belongs to its host halo.
FARTHEST = 20.0


#: The key that sets the shells of a lightcone apart, given as `by` where rows of several are handled at once; without
#: it all rows are of one shell.
SHELL = ("snapnum",)


def steps(snapshots: DataFrame) -> DataFrame:
    """A row per lightcone step: step, snapnum (the next snapshot, whose cores it takes), and the scale factors a_from
    and a_to between which its halos lie, the latter excluded. The last step has no next snapshot and gives no row.
    Snapshots: snapnum, step, scale_factor."""
    at = snapshots.select((F.col("snapnum").cast("int") + 1).alias("snapnum"), "step", F.col("scale_factor").alias("a_from"))
    return at.join(snapshots.select(F.col("snapnum").cast("int").alias("snapnum"), F.col("scale_factor").alias("a_to")), "snapnum")


def in_steps(halos: DataFrame, of: DataFrame) -> DataFrame:
    """Halos with the snapnum of the step in which their scale factor lies; those in none are dropped. There are as many
    steps as snapshots of the simulation, whatever the input's size."""
    a = F.col("a").cast("double")
    return halos.join(F.broadcast(of.drop("step")), (a >= F.col("a_from")) & (a < F.col("a_to"))).drop("a_from", "a_to")


def clean_halos(halos: DataFrame) -> DataFrame:
    """Halos with `tag` and `fragment`; rows with a null key or a position that is null, NaN or infinite are dropped."""
    fine = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in "xyz")
    rows = halos.where(f"id is not null and replication is not null and {fine}")
    return rows.withColumns({"tag": parent_tag(F.col("id")), "fragment": fragment_index(F.col("id"))})


def deduped(halos: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (replication, tag) of a shell: the least by a, x, y, z, fragment, with nulls first. The choice is an aggregate,
    so hot tags are combined before the shuffle."""
    first = F.min(F.struct("a", "x", "y", "z", "fragment", "id")).alias("r")
    return halos.groupBy(*by, "replication", "tag").agg(first).select(*by, "replication", "tag", "r.*")


def consistent(halos: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Of deduped halos, those whose fragment is that of their tag's first replication."""
    first = halos.groupBy(*by, "tag").agg(F.min(F.struct("replication", "fragment")).alias("f")).select(*by, "tag", F.col("f.fragment").alias("fragment"))
    return halos.join(first, [*by, "tag", "fragment"])


def replications(halos: DataFrame) -> DataFrame:
    """tag, n_replications."""
    return halos.groupBy("tag").agg(F.count("*").alias("n_replications"))


def cores_at(cores: DataFrame, snapnum: int, grid: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """`placeable` cores of one snapshot."""
    return placeable(cores.where(F.col("snapnum") == snapnum), grid, keep)


def placeable(cores: DataFrame, grid: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cores with tag > 0: snapnum, core_tag, tag (of the FoF halo), signed (with its fragment), central, x, y, z,
    the Lagrangian place qx, qy, qz of the FoF tag, and the columns of `keep`."""
    q = lagrangian(F.col("tag"), grid)
    rows = cores.where((F.col("core_tag") > 0) & F.col("fof_halo_tag").isNotNull())
    rows = rows.select("snapnum", "core_tag", parent_tag(F.col("fof_halo_tag")).alias("tag"), F.col("fof_halo_tag").alias("signed"), "central", "x", "y", "z", *keep)
    return rows.withColumns(dict(zip(("qx", "qy", "qz"), q)))


def matched(cores: DataFrame, halos: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """cores with halo_signed, the signed tag of the first replication of their halo; cores without one are dropped."""
    first = halos.groupBy(*by, "tag").agg(F.min(F.struct("replication", "id")).alias("h")).select(*by, "tag", F.col("h.id").alias("halo_signed"))
    return cores.join(first, [*by, "tag"])


def with_host_core(cores: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """matched cores with the host core of their halo: among the cores of its signed tag a central one, then the least
    tag; cores whose halo has none are dropped."""
    best = cores.groupBy(*by, "signed").agg(F.max(F.struct((F.coalesce("central", F.lit(0)) == 1).cast("int").alias("c"), F.bitwise_not("core_tag").alias("n"), "x", "y", "z")).alias("b"))
    hosts = best.select(*by, F.col("signed").alias("halo_signed"), F.bitwise_not("b.n").alias("halo_core"), F.col("b.x").alias("hx"), F.col("b.y").alias("hy"), F.col("b.z").alias("hz"))
    return cores.join(hosts, [*by, "halo_signed"])


def offsets(cores: DataFrame, box: float) -> DataFrame:
    """Cores with their offset dx, dy, dz from the host core in the periodic box, if none exceeds FARTHEST."""
    d = {f"d{c}": min_image(F.col(c) - F.col(f"h{c}"), box) for c in "xyz"}
    return cores.withColumns(d).where(" and ".join(f"abs(d{c}) <= {FARTHEST}" for c in "xyz"))


def replicated(cores: DataFrame, halos: DataFrame, by: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per core and replication of its halo: core_tag, replication, tag, halo_core, px, py, pz (the halo's
    position plus the core's offset), hx, hy, hz (the halo's), signed and id, the signed tags of both, own_fragment, whether
    these are the same, a (the halo's), central, and the columns of `keep`.
    A hot tag joins few halos, one per replication, to many cores; adaptive execution splits the cores' side."""
    h = halos.select(*by, "tag", "replication", "id", "a", *(F.col(c).cast("double").alias(f"l{c}") for c in "xyz"))
    rows = cores.drop("hx", "hy", "hz").join(h, [*by, "tag"])
    return rows.select(*by, "core_tag", "replication", "tag", "halo_core", *((F.col(f"l{c}") + F.col(f"d{c}")).alias(f"p{c}") for c in "xyz"), *(F.col(f"l{c}").alias(f"h{c}") for c in "xyz"), (F.col("signed") == F.col("id")).alias("own_fragment"), "signed", "id", "a", "central", *keep)


def angles(rows: DataFrame) -> DataFrame:
    """rows with theta, phi of the core and host_theta, host_phi of its halo."""
    return rows.withColumns({"theta": theta(F.col("px"), F.col("py"), F.col("pz")), "phi": phi(F.col("px"), F.col("py")), "host_theta": theta(F.col("hx"), F.col("hy"), F.col("hz")), "host_phi": phi(F.col("hx"), F.col("hy"))})


def host_rows(rows: DataFrame, tops: DataFrame, by: tuple[str, ...] = (), levels: tuple[str, ...] = ("top", "second")) -> DataFrame:
    """rows with top, the host of hosts of the core, and second, the one below it, and top_there and second_there, whether
    that core is in the same replication. tops: core_tag, top, second."""
    joined = rows.join(tops.select(*by, "core_tag", *levels), [*by, "core_tag"], "left")
    for level in levels:
        there = rows.select(*by, "replication", F.col("core_tag").alias(level), F.lit(True).alias("there"))
        joined = joined.join(there, [*by, "replication", level], "left").withColumn(f"{level}_there", F.coalesce("there", F.lit(False))).drop("there")
    return joined


def output(rows: DataFrame, cores: DataFrame, by: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a pipeline under the names that they are written with. Hosts are followed among `cores`; an index of a host
    is its tag if it has a row in the same shell and replication, else -1."""
    hosted = host_rows(cut(rows, "placed"), top_hosts(cores), by)
    halo = {"hx": "lc_halo_x", "hy": "lc_halo_y", "hz": "lc_halo_z", "host_theta": "lc_halo_theta", "host_phi": "lc_halo_phi", "tag": "lc_halo_foftag", "id": "lc_fof_halo_tag"}
    named = {"px": "x", "py": "y", "pz": "z", "signed": "fof_halo_tag", "a": "scale_factor", **halo}
    hosts = {"top": "top_host", "second": "secondary_top_host"}
    return hosted.select(
        *(c for c in ("step", *by) if c in rows.columns), "core_tag", "replication", "central", "theta", "phi", *(F.col(c).alias(n) for c, n in named.items()), (~F.col("own_fragment")).alias("lc_fof_halo_flag"),
        *(F.coalesce(c, F.lit(-1)).alias(f"{n}_tag") for c, n in hosts.items()), *(F.when(F.col(f"{c}_there"), F.col(c)).otherwise(F.lit(-1)).alias(f"{n}_idx") for c, n in hosts.items()), *keep,
    )


def pipeline(cores: DataFrame, halos: DataFrame, snapnum: int, box: float, grid: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """From raw halos and cores to cores on the lightcone at one snapshot, one plan of joins."""
    good = consistent(deduped(clean_halos(halos)))
    at = offsets(with_host_core(matched(cores_at(cores, snapnum, grid, keep), good)), box)
    return angles(replicated(at, good, keep=keep))


def pipeline_of_steps(cores: DataFrame, halos: DataFrame, snapshots: DataFrame, box: float, grid: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """From raw halos and cores to cores on the lightcone at all steps, one plan of joins: what `pipeline` gives for each
    step's halos and the cores of the snapshot after it, with step and snapnum."""
    of = steps(snapshots)
    good = consistent(deduped(in_steps(clean_halos(halos), of), SHELL), SHELL)
    at = offsets(with_host_core(matched(placeable(cores, grid, keep), good, SHELL), SHELL), box)
    return angles(replicated(at, good, SHELL, keep)).join(F.broadcast(of.select("snapnum", "step")), "snapnum")
