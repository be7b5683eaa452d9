"""Positions in a periodic box and on the sky, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: stands for an offset without a spherical-overdensity mass.
NO_MASS = -101.0


def wrap(x: Column, box: float) -> Column:
    """x modulo the box, in [0, box), whatever its sign."""
    return F.pmod(x, F.lit(float(box)))


def wrap_once(x: Column, box: float) -> Column:
    """(x + box) % box, with the sign of x + box: like `wrap` for x >= -box."""
    return (x + F.lit(float(box))) % F.lit(float(box))


def min_image(dx: Column, box: float) -> Column:
    """dx moved by one box towards zero, if it's more than half a box away."""
    half = box / 2
    return dx + F.when(dx < -half, float(box)).when(dx > half, -float(box)).otherwise(0.0)


def distance(dx: Column, dy: Column, dz: Column, box: float) -> Column:
    a, b, c = (min_image(d, box) for d in (dx, dy, dz))
    return F.sqrt(a * a + b * b + c * c)


def offset(dx: Column, dy: Column, dz: Column, radius: Column, mass: Column, box: float) -> Column:
    """The distance of two centers in units of the radius; NO_MASS where the mass isn't positive."""
    return F.when(mass > 0, distance(dx, dy, dz, box) / radius).otherwise(NO_MASS)


def lagrangian(tag: Column, n: int) -> tuple[Column, Column, Column]:
    """The place (x, y, z) in [0, 1) of particle `tag` in a grid of n^3, z running fastest."""
    whole = F.lit(n).cast("long")
    z = tag % whole
    y = ((tag - z) / whole).cast("long") % whole
    x = F.floor(tag / (whole * whole)).cast("long")
    return x / n, y / n, z / n


def theta(x: Column, y: Column, z: Column) -> Column:
    """acos(z / r); null at the origin."""
    r = F.sqrt(x * x + y * y + z * z)
    return F.when(r > 0, F.acos(z / r))


def phi(x: Column, y: Column) -> Column:
    """atan2(y, x) + pi, in [0, 2 pi)."""
    return (F.atan2(y, x) + math.pi) % (2 * math.pi)
