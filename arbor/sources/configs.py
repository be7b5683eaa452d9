"""Configuration files: forest assembly (INI) and core assembly (TOML)."""

from __future__ import annotations

import configparser
import json
import tomllib
from dataclasses import dataclass
from pathlib import Path

from ..functions.simulation import SIMULATIONS, Simulation


@dataclass(frozen=True)
class ForestConfig:
    """columns maps names of columns to those in the catalogs; copy holds pairs of source and output
    columns, derived names derived columns, n_files (none: as many as the rows want), fail_on_missing makes a missing descendant an error."""

    simulation: Simulation
    catalogs: str
    output: str
    columns: dict[str, str]
    copy: tuple[tuple[str, str], ...] = ()
    derived: tuple[str, ...] = ()
    n_files: int | None = None
    fail_on_missing: bool = False


def _simulation(name: str, beside: Path) -> Simulation:
    return Simulation.from_ini(str((beside / name).resolve())) if name.endswith(".cfg") else SIMULATIONS[name]


def forest_config(path: str) -> ForestConfig:
    """Sections simulation (simulation: a known name or a .cfg file), input (treenodes_base_path), output (output_file,
    n_files), columns, and columns.forest (copy_fields, a JSON list of names or pairs, and derived_fields). Paths are
    relative to the file."""
    ini = configparser.ConfigParser()
    ini.optionxform = str
    with open(path, encoding="utf-8") as f:
        ini.read_file(f)
    beside = Path(path).resolve().parent
    fields = ini["columns.forest"] if "columns.forest" in ini else {}
    copy = tuple((e, e) if isinstance(e, str) else tuple(e) for e in json.loads(fields.get("copy_fields", "[]")))
    output = ini["output"]
    return ForestConfig(
        _simulation(ini["simulation"]["simulation"], beside), str((beside / ini["input"]["treenodes_base_path"]).resolve()), str((beside / output["output_file"]).resolve()),
        dict(ini["columns"]) if "columns" in ini else {}, copy, tuple(json.loads(fields.get("derived_fields", "[]"))), output.getint("n_files"), ini.getboolean("algorithm", "fail_on_desc_not_found", fallback=False),
    )


@dataclass(frozen=True)
class CoreConfig:
    simulation: Simulation
    cores: str
    output: str
    columns: tuple[str, ...]


def core_config(path: str) -> CoreConfig:
    """Keys simulation, coreproperties_base, output_base and include_fields. Paths are relative to the file."""
    with open(path, "rb") as f:
        given = tomllib.load(f)
    given = {**given, **{k: v for t in given.values() if isinstance(t, dict) for k, v in t.items()}}
    beside = Path(path).resolve().parent
    return CoreConfig(_simulation(given["simulation"], beside), str((beside / given["coreproperties_base"]).resolve()), str((beside / given["output_base"]).resolve()), tuple(given.get("include_fields", ())))
