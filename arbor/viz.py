"""A tree as SVG: bounded by steps and mass, so small enough to draw, and only then brought to the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .operators.forest import Forest, extracted

#: Halos that a drawing may have; more are an error, as nobody could see them.
MOST = 5000


def tree_svg(spark: SparkSession, forest: Forest, target: int, max_steps: int = 20, threshold: float = 1e10, padding: float = 0.05, width: int = 800, height: int = 600, major: float = 0.3) -> str:
    """Progenitors of `target`, one column per step, heights by mass, siblings stacked by mass with padding; links to
    descendants, red where the second progenitor has more than `major` of the first's mass."""
    one = spark.createDataFrame([(target,)], "id long")
    near = extracted(forest, one, threshold, max_steps).join(forest.nodes.select("id", "desc"), "id")
    rows = near.select("id", "desc", "step", "mass").take(MOST + 1)
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} halos: raise the threshold or lower max_steps")
    kids: dict[int, list] = {}
    by = {r.id: r for r in rows}
    for r in sorted(rows, key=lambda r: (-r.mass, r.id)):
        kids.setdefault(r.desc if r.id != target else None, []).append(r)
    if target not in by:
        return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"></svg>'
    pad, room = padding * by[target].mass, {}
    for r in sorted(rows, key=lambda r: -r.step):
        mine = kids.get(r.id, [])
        room[r.id] = max(r.mass, sum(room[k.id] for k in mine) + pad * max(0, len(mine) - 1))
    at = {target: room[target] / 2}
    scale, across = height / room[target], width / (max_steps + 1)
    out = []
    for r in sorted(rows, key=lambda r: r.step):
        mine = kids.get(r.id, [])
        low = at[r.id] - (sum(room[k.id] for k in mine) + pad * max(0, len(mine) - 1)) / 2
        merger = len(mine) > 1 and mine[1].mass > major * mine[0].mass
        for i, k in enumerate(mine):
            at[k.id] = low + room[k.id] / 2
            low += room[k.id] + pad
            x1, x2 = (width - (s + 0.5) * across for s in (r.step, k.step))
            out.append(f'<path d="M{x1:.1f},{at[r.id] * scale:.1f}L{x2:.1f},{at[k.id] * scale:.1f}" stroke="{"red" if merger and i < 2 else "gray"}" fill="none"/>')
    for r in rows:
        h = max(1.0, r.mass * scale)
        out.append(f'<rect x="{width - (r.step + 0.8) * across:.1f}" y="{at[r.id] * scale - h / 2:.1f}" width="{across * 0.6:.1f}" height="{h:.1f}" fill="steelblue"><title>{r.id}: {r.mass:.4g}</title></rect>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" viewBox="0 0 {width} {height}">{"".join(out)}</svg>'
