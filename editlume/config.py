"""Job settings: defaults, then an INI file, then the command line; the later wins."""

from __future__ import annotations

import argparse
import configparser
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class JobConfig:
    lang: str = "scowiki"
    date: str = "latest"
    dumps_dir: str = "data"
    output: str = "tables"
    task: str = "history"
    compat_minor: bool = False
    max_rows_per_file: int = 5_000_000


def _typed(name: str, value: str) -> object:
    kind = type(getattr(JobConfig(), name))
    if kind is bool:
        return value.strip().lower() in ("1", "true", "yes", "on")
    return kind(value)


def from_ini(path: str | Path, base: JobConfig | None = None) -> JobConfig:
    """The section [job], with ${section:key} references; unknown keys are an error."""
    parser = configparser.ConfigParser(interpolation=configparser.ExtendedInterpolation())
    with open(path, encoding="utf-8") as f:
        parser.read_file(f)
    if "job" not in parser:
        raise ValueError(f"{path} has no section [job]")
    return replace(base or JobConfig(), **{k: _typed(k, v) for k, v in parser["job"].items()})


def from_args(args: Sequence[str]) -> JobConfig:
    cli = argparse.ArgumentParser(prog="editlume")
    cli.add_argument("--config")
    for f in fields(JobConfig):
        cli.add_argument("--" + f.name.replace("_", "-"), dest=f.name)
    given = vars(cli.parse_args(args))
    base = from_ini(given.pop("config")) if given.get("config") else JobConfig()
    given.pop("config", None)
    return replace(base, **{k: _typed(k, v) for k, v in given.items() if v is not None})
