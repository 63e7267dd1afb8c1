"""What a run does: flags from the command line or the environment."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Profile:
    """The settings of a run; each is a flag --name and a variable AMALGAM_NAME."""

    #: Process sources again that are up to date.
    force: bool = False
    #: Only fetch, process nothing.
    download_only: bool = False
    #: Write text sidecars beside the parquet files.
    csv: bool = False
    verbose: bool = False
    #: Rows that scans read at most in a trial run; 0 reads all.
    rows: int = 0
    #: Sources to process; none means all.
    sources: tuple[str, ...] = ()
    #: Steps after the sources.
    geo: bool = True
    diff: bool = True
    checks: bool = True

    def wants(self, source: str) -> bool:
        return not self.sources or source in self.sources

    def limit(self) -> int | None:
        """The row limit to hand to readers."""
        return self.rows or None


def _read(kind: type, text: str):
    if kind is bool:
        return text.strip().lower() in ("1", "true", "yes", "on")
    return int(text) if kind is int else tuple(x for x in text.replace(",", " ").split())


def profile(arguments: list[str] | None = None, environment: Mapping[str, str] = os.environ) -> Profile:
    """Defaults, then the environment, then ``arguments`` (--force, --no-geo, --rows 1000, --sources a b)."""
    out = Profile()
    kinds = {f.name: type(f.default) for f in fields(Profile)}
    parser = argparse.ArgumentParser(description="Build a release")
    for name, kind in kinds.items():
        flag = "--" + name.replace("_", "-")
        if kind is bool:
            parser.add_argument(flag, action=argparse.BooleanOptionalAction)
        else:
            parser.add_argument(flag, type=int if kind is int else str, nargs="*" if kind is tuple else None)
        if (held := environment.get(f"AMALGAM_{name.upper()}")) is not None:
            out = replace(out, **{name: _read(kind, held)})
    given = {k: tuple(v) if isinstance(v, list) else v for k, v in vars(parser.parse_args(arguments or [])).items() if v is not None}
    return replace(out, **given)
