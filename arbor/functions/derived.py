"""Derived columns by name, to which users add their own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import offset


@dataclass(frozen=True)
class DerivedField:
    name: str
    requires: tuple[str, ...]
    make: Callable[[float], Column]


DERIVED: dict[str, DerivedField] = {}


def derived_field(name: str, *requires: str) -> Callable:
    """Registers a function of the box length that gives a column from the columns it `requires`."""

    def add(make: Callable[[float], Column]) -> Callable[[float], Column]:
        DERIVED[name] = DerivedField(name, requires, make)
        return make

    return add


def with_derived(df: DataFrame, names: list[str], box: float) -> DataFrame:
    """df with the named columns, as floats. Columns that are missing make a ValueError."""
    for name in names:
        lacking = [c for c in DERIVED[name].requires if c not in df.columns]
        if lacking:
            raise ValueError(f"{name} needs {lacking}")
    return df.withColumns({n: DERIVED[n].make(box).cast("float") for n in names})


def _axes(center: str) -> list[str]:
    return [f"{center}_{c}" for c in "xyz"]


def _offset(a: str, b: str) -> Callable[[float], Column]:
    return lambda box: offset(*(F.col(p) - F.col(q) for p, q in zip(_axes(a), _axes(b))), F.col("sod_halo_radius"), F.col("sod_halo_mass"), box)


for _name, _a, _b in (("xoff_sod", "sod_halo_mean", "sod_halo_min_pot"), ("xoff_fof", "fof_halo_mean", "fof_halo_center"), ("xoff_com", "fof_halo_mean", "sod_halo_mean")):
    derived_field(_name, *_axes(_a), *_axes(_b), "sod_halo_radius", "sod_halo_mass")(_offset(_a, _b))
